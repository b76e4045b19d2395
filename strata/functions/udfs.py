"""Python UDFs (X02-X05). Kept free of import-time Spark calls: executors
import this module to unpickle the functions."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa


def classify_batch(v: pa.Array) -> pa.Array:
    """Vectorised twin of ``scalar.classify_order_value`` for the UDF path
    (X05). Arrow keeps NULL (UNKNOWN) apart from NaN (LOW)."""
    x = v.cast(pa.float64()).to_numpy(zero_copy_only=False)
    null = v.is_null().to_numpy(zero_copy_only=False)
    # Cut points and labels of the reference's segment rule.
    out = np.select([null, x >= 200, x >= 100, x >= 25], ["UNKNOWN", "WHALE", "HIGH", "MEDIUM"], default="LOW")
    return pa.array(out.tolist(), pa.string())


def register_classify_udf(spark, name: str = "classify_order_value"):
    """Register the vectorised classifier by name (replacing an older one)."""
    from pyspark.sql import functions as F

    udf = F.arrow_udf(classify_batch, "string")
    spark.udf.register(name, udf)
    return udf


def prompt_length_stub(prompts: pd.Series) -> pd.Series:
    """A deterministic stand-in for a hosted completion model (N17 tests):
    answers with the prompt's length in characters."""
    return prompts.str.len().astype("Int64").astype(str) + " chars"
