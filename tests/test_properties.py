"""Property checks against plain-Python references (random inputs)."""

from __future__ import annotations

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators.relational import latest_per_key

ROWS = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 1000)), min_size=1, max_size=40,
                unique_by=lambda r: r[2])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS)
def test_latest_per_key_matches_pandas(spark, data):
    # key 0 is frequent (a hot key), ts ties are common, id breaks them
    pdf = pd.DataFrame(data, columns=["k", "ts", "id"])
    got = sorted(tuple(r) for r in latest_per_key(spark.createDataFrame(pdf), ["k"], ["ts", "id"]).collect())
    exp = sorted(tuple(int(x) for x in r) for r in
                 pdf.sort_values(["k", "ts", "id"]).groupby("k").tail(1)[["k", "ts", "id"]].itertuples(index=False))
    assert got == exp
