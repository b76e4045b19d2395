"""CSV loading with rejects, load history, documents, scalar functions and UDFs."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from strata.functions import scalar as S
from strata.functions.udfs import register_classify_udf
from strata.operators import documents as V
from strata.operators.relational import add_column_if_absent, append_with_defaults, delete_where, update_where
from strata.sources import csv_load as C

WEATHER = T.StructType([
    T.StructField("station_id", T.StringType()), T.StructField("date_recorded", T.DateType()),
    T.StructField("temp_max", T.DoubleType()), T.StructField("temp_min", T.DoubleType()),
    T.StructField("precipitation", T.DoubleType()), T.StructField("snow", T.DoubleType()),
    T.StructField("snow_depth", T.DoubleType()),
])

WEATHER_CSV = """station_id,date_recorded,temp_max,temp_min,precipitation,snow,snow_depth
  USW1 ,2024-01-01, 5.5,-1.0,0.2,0,0
USW2,2024-01-02,abc,-1.0,0.2,0,0
USW3,2024-01-03,4.0,-2.0,0.0,0,0,99
USW4,2024-01-04,4.0,-2.0
USW5,2024-01-05,NULL,null,,0,0
"US,W6",2024-01-06,1.0,0.0,0.0,0.0,0.0
"""


def _write(tmp, name, text):
    d = os.path.join(tmp, "landing")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write(text)
    return d


def test_copy_into_keeps_good_rows_and_rejects_bad(spark, tmp):
    d = _write(tmp, "weather.csv", WEATHER_CSV)
    good, rej = C.copy_into(spark, d, WEATHER)
    g = {r.station_id: r for r in good.collect()}
    assert sorted(g) == ["US,W6", "USW1", "USW5"]          # quoted comma kept
    assert g["USW1"].temp_max == 5.5                         # trimmed
    assert g["USW5"].temp_max is None and g["USW5"].temp_min is None and g["USW5"].precipitation is None
    errs = sorted(r.error for r in rej.collect())
    assert errs == ["cannot convert column temp_max to double", "number of columns does not match",
                    "number of columns does not match"]


def test_load_history_and_latest(spark, tmp):
    d = _write(tmp, "weather.csv", WEATHER_CSV)
    _write(tmp, "weather2.csv", "station_id,date_recorded,temp_max,temp_min,precipitation,snow,snow_depth\n"
                                "X,2024-02-01,1,1,1,1,1\n")
    h = C.load_history(spark, d, WEATHER, "weather_observations", load_time=F.lit("2024-03-01").cast("timestamp"))
    by = {os.path.basename(r.file_name): r for r in h.collect()}
    assert (by["weather.csv"].rows_parsed, by["weather.csv"].rows_loaded, by["weather.csv"].errors_seen) == (6, 3, 3)
    assert by["weather.csv"].status == "PARTIALLY_LOADED" and by["weather2.csv"].status == "LOADED"
    assert C.latest_loads(h, "weather_observations", 1).count() == 1
    assert C.list_files(spark, d, "*.csv").count() == 2


def test_seed_keeps_trailing_spaces(spark, tmp):
    d = _write(tmp, "products.csv", 'sku,name,type,price,description\nA1,"Widget, big  ",jaffle,1100,"x, y "\n')
    r = C.read_seed(spark, d, T.StructType([
        T.StructField("sku", T.StringType()), T.StructField("name", T.StringType()),
        T.StructField("type", T.StringType()), T.StructField("price", T.IntegerType()),
        T.StructField("description", T.StringType())])).first()
    assert r.name == "Widget, big  " and r.price == 1100 and r.description == "x, y "


def test_order_json_flatten(spark):
    doc = ('{"order_id": 1001, "customer": "Alice", "items": ['
           '{"product": "Widget A", "qty": 2, "price": 9.99}, {"product": "Widget B", "qty": 1, "price": 24.99}]}')
    df = spark.createDataFrame([(doc,), ('{"order_id": 1002}',), ("not json",)], "t string").select(
        V.parse("t").alias("data"))
    flat = V.flatten(df, "data", "$.items")
    out = rows(flat.select(V.path("data", "$.order_id", "int"), V.path("data", "$.customer", "string"),
                           V.path("item", "$.product", "string"), V.path("item", "$.qty", "int"),
                           V.path("item", "$.price", "double")))
    assert out == [(1001, "Alice", "Widget A", 2, 9.99), (1001, "Alice", "Widget B", 1, 24.99)]
    outer = V.flatten(df, "data", "$.items", outer=True)
    assert outer.count() == 4  # 2 items + order without items + unparsable text (NULL document)


def test_object_construct_drops_null_keys(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string").select(
        V.object_construct(a=F.col("a"), b=F.col("b"), n=V.object_struct(x=F.col("b"))).alias("v"))
    assert df.select(F.to_json("v")).first()[0] == '{"a":1,"n":{}}'
    assert df.select(V.path("v", "$.items[0].qty", "double")).first()[0] is None


def test_classify_order_value_thresholds(spark):
    vals = [None, float("nan"), 0.0, 24.99, 25.0, 99.99, 100.0, 199.99, 200.0]
    df = spark.createDataFrame([(v,) for v in vals], "order_value double")
    got = [r[0] for r in df.select(S.classify_order_value("order_value")).collect()]
    assert got == ["UNKNOWN", "LOW", "LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "WHALE"]
    register_classify_udf(spark)
    via_udf = [r[0] for r in df.select(F.call_udf("classify_order_value", F.col("order_value"))).collect()]
    # NULL and NaN stay apart, as in the reference's function
    assert via_udf == ["UNKNOWN", "LOW", "LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "WHALE"]


def test_string_functions(spark):
    df = spark.createDataFrame([("  Alice Chen ", "Al@b@c.com", None)], "name string, email string, tier string")
    r = df.select(S.clean_lower("name"), S.mask_local_part("email"), S.strict_concat("name", "tier"),
                  S.sql_quote(F.lit("it's"))).first()
    assert tuple(r) == ("alice chen", "****@c.com", None, "it''s")


def test_thresholds_are_strict(spark):
    df = spark.createDataFrame([(0.1,), (0.1000001,), (-0.1,), (-0.2,), (None,)], "s double")
    got = [r[0] for r in df.select(S.threshold_label("s", 0.1)).collect()]
    assert got == ["neutral", "positive", "neutral", "negative", "neutral"]


def test_date_helpers(spark):
    df = spark.createDataFrame([("2026-01-17",), (None,)], "d string").select(F.col("d").cast("date").alias("d"))
    r = df.select(S.month_start("d"), S.before_flag("d", "2026-01-18")).collect()
    assert str(r[0][0]) == "2026-01-01" and r[0][1] == 1 and r[1][1] == 0


def test_dml_helpers_and_defaults(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, None, None)], "id int, n string, e string")
    u = update_where(df, F.col("e").isNull(), e=F.concat(F.col("n"), F.lit("@example.com")))
    assert rows(u, "id", "e") == [(1, "a@example.com"), (2, "x"), (3, None)]
    assert rows(delete_where(df, F.col("n") == "a"), "id") == [(2,), (3,)]  # NULL predicate keeps row 3
    assert add_column_if_absent(df, "n", "int").schema == df.schema
    tgt = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("tier", T.StringType())])
    assert rows(append_with_defaults(tgt, df.select("id"), {"tier": F.lit("standard")})) == [
        (1, "standard"), (2, "standard"), (3, "standard")]
    assert df.limit(0).count() == 0 and df.limit(0).schema == df.schema  # empty structure copy


def test_copy_into_table_skips_loaded_files(spark, tmp):
    d = _write(tmp, "weather.csv", WEATHER_CSV)
    table, hist = os.path.join(tmp, "weather_tbl"), os.path.join(tmp, "load_history")
    first = C.copy_into_table(spark, d, WEATHER, table, hist, "weather_observations")
    assert [(r.rows_loaded, r.errors_seen, r.status) for r in first.collect()] == [(3, 3, "PARTIALLY_LOADED")]
    assert C.copy_into_table(spark, d, WEATHER, table, hist, "weather_observations").count() == 0  # replay
    assert spark.read.parquet(table).count() == 3
    _write(tmp, "weather2.csv", "station_id,date_recorded,temp_max,temp_min,precipitation,snow,snow_depth\n"
                                "X,2024-02-01,1,1,1,1,1\n")
    third = C.copy_into_table(spark, d, WEATHER, table, hist, "weather_observations")
    assert [os.path.basename(r.file_name) for r in third.collect()] == ["weather2.csv"]
    assert spark.read.parquet(table).count() == 4
    assert spark.read.parquet(hist).count() == 2
    assert spark.read.parquet(table + "_rejects").count() == 3


def test_copy_into_table_takes_up_a_load_that_broke_off(spark, tmp, monkeypatch):
    d = _write(tmp, "weather.csv", WEATHER_CSV)
    _write(tmp, "empty.csv", WEATHER_CSV.split("\n")[0] + "\n")
    table, hist = os.path.join(tmp, "weather_tbl"), os.path.join(tmp, "load_history")

    def crash(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(C, "_history", crash)  # rows and rejects are written, the history is not
    with pytest.raises(RuntimeError):
        C.copy_into_table(spark, d, WEATHER, table, hist, "weather_observations")
    monkeypatch.undo()
    _write(tmp, "weather2.csv", "station_id,date_recorded,temp_max,temp_min,precipitation,snow,snow_depth\n"
                                "X,2024-02-01,1,1,1,1,1\n")
    again = C.copy_into_table(spark, d, WEATHER, table, hist, "weather_observations")
    assert sorted((os.path.basename(r.file_name), r.rows_loaded, r.status) for r in again.collect()) == [
        ("empty.csv", 0, "LOADED"), ("weather.csv", 3, "PARTIALLY_LOADED")]
    assert spark.read.parquet(table).count() == 3
    later = C.copy_into_table(spark, d, WEATHER, table, hist, "weather_observations")
    assert [os.path.basename(r.file_name) for r in later.collect()] == ["weather2.csv"]
    assert C.copy_into_table(spark, d, WEATHER, table, hist, "weather_observations").count() == 0
    assert spark.read.parquet(table).count() == 4 and spark.read.parquet(table + "_rejects").count() == 3


def test_copy_into_rejects_an_unknown_error_mode(spark, tmp):
    with pytest.raises(ValueError):
        C.copy_into(spark, _write(tmp, "w.csv", WEATHER_CSV), WEATHER, on_error="SKIP_FILE")
