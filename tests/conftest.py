from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import local_session

    s = local_session(4, shuffle_partitions=8, app="strata-tests")
    # tests set their own shared folder; a cluster names it in spark.checkpoint.dir
    if not s.conf.get("spark.checkpoint.dir", None):
        root = tempfile.mkdtemp(prefix="strata-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", root)
        s.sparkContext.setCheckpointDir(root)
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    """Sorted list of tuples for order-insensitive comparison."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))
