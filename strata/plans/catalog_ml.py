"""Churn model queries (X07-X13) over the customer metrics of A11."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.scalar import before_flag
from strata.operators import ml as ML
from strata.plans.catalog_models import _METRICS_SQL, customer_metrics
from strata.plans.registry import register
from strata.plans.sqlbase import with_
from strata.session import scratch_path

CUTOFF = "1998-01-01"          # churned: last order before this date
BASELINE_CUTOFF = "1997-06-01"  # the baseline predictor of the report query
FUTURE_CUTOFF = "2100-01-01"    # every customer churned: a single class

_BASE = with_("orders_raw", "customers", extra=_METRICS_SQL)


def _frame_sql(cutoff: str) -> str:
    return f"""SELECT customer_id, coalesce(CAST(total_orders AS DOUBLE), 0.0) AS total_orders,
       coalesce(CAST(total_spent AS DOUBLE), 0.0) AS total_spent,
       coalesce(CAST(avg_order_value AS DOUBLE), 0.0) AS avg_order_value,
       coalesce(CAST(last_order_date < DATE '{cutoff}' AS INTEGER), 0) AS churned
FROM customer_metrics"""


_SPLIT_SQL = "(('0x' || substr(md5(CAST(customer_id AS VARCHAR)), 1, 8))::BIGINT % 100) < 80"


@register("x07_x08_f15_f16_churn_features", _BASE + _frame_sql(CUTOFF))
def x07(spark, sf):
    return ML.churn_frame(customer_metrics(spark, sf), CUTOFF)


@register("x09_u01_a10_synthetic_rows", _BASE + _frame_sql(FUTURE_CUTOFF) + """
UNION ALL SELECT * FROM (VALUES (-1, 10.0, 500.0, 50.0, 0), (-2, 1.0, 15.0, 15.0, 1),
                                (-3, 8.0, 400.0, 50.0, 0), (-4, 2.0, 20.0, 20.0, 1))""")
def x09(spark, sf):
    return ML.with_synthetic_rows(spark, ML.churn_frame(customer_metrics(spark, sf), FUTURE_CUTOFF))


@register("x10_stable_split", _BASE + f"SELECT customer_id, {_SPLIT_SQL} AS is_train FROM customer_metrics")
def x10(spark, sf):
    return customer_metrics(spark, sf).select("customer_id", ML.split_flag("customer_id").alias("is_train"))


@register("x12_classification_report", _BASE + f"""
, labelled AS (SELECT churned AS y, coalesce(CAST(last_order_date < DATE '{BASELINE_CUTOFF}' AS INTEGER), 0) AS p
               FROM ({_frame_sql(CUTOFF)}) f JOIN customer_metrics USING (customer_id)
               WHERE NOT ({_SPLIT_SQL.replace('customer_id', 'f.customer_id')})),
classes AS (SELECT y AS c FROM labelled UNION SELECT p FROM labelled),
agg AS (SELECT c, COUNT(*) FILTER (WHERE y = c AND p = c) AS tp, COUNT(*) FILTER (WHERE p = c AND y <> c) AS fp,
               COUNT(*) FILTER (WHERE y = c AND p <> c) AS fn FROM classes, labelled GROUP BY c),
r AS (SELECT c AS class, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall, CAST(tp + fn AS BIGINT) AS support
      FROM agg)
SELECT class, precision, recall,
       CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1_score,
       support FROM r""")
def x12(spark, sf):
    m = customer_metrics(spark, sf)
    f = ML.churn_frame(m, CUTOFF).filter(~ML.split_flag("customer_id"))
    pred = f.join(m.select("customer_id", "last_order_date"), "customer_id").withColumn(
        "prediction", before_flag("last_order_date", BASELINE_CUTOFF))
    return ML.classification_report(pred)


def _trained(spark, sf):
    """The metrics table, the labelled frame and the model fitted on its training rows.

    The metrics table is written once and read by the guard, the training split and the scoring."""
    metrics_path = scratch_path(spark, "customer_metrics")
    customer_metrics(spark, sf).write.mode("overwrite").parquet(metrics_path)
    m = spark.read.parquet(metrics_path)
    frame = ML.with_synthetic_rows(spark, ML.churn_frame(m, CUTOFF))
    return m, frame, ML.train_gbt(frame.filter(ML.split_flag("customer_id")))


@register("x11_x13_gbt_train_and_score")
def x11(spark, sf):
    m, _, model = _trained(spark, sf)
    scored = ML.score(model, m, ["customer_id", "name", "tier", "total_orders", "total_spent", "avg_order_value"])
    path = scratch_path(spark, "customer_churn_scores")
    scored.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@register("x11_x12_trained_model_report")
def x12_trained(spark, sf):
    """The trained model's precision, recall, F1 and support on the held-out rows."""
    _, frame, model = _trained(spark, sf)
    return ML.classification_report(model.transform(frame.filter(~ML.split_flag("customer_id"))))
