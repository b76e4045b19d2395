"""Churn model on Spark MLlib (X07-X13): labels, features, a stable split,
gradient-boosted trees, a per-class report and scoring — all on the
cluster; nothing is pulled into driver memory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.scalar import before_flag

FEATURES = ("total_orders", "total_spent", "avg_order_value")
LABEL = "churned"

# The reference's four synthetic rows (added only when the
# label has a single class): total_orders, total_spent, avg_order_value, churned.
SYNTHETIC_ROWS = [(10, 500, 50, 0), (1, 15, 15, 1), (8, 400, 50, 0), (2, 20, 20, 1)]


def churn_frame(metrics: DataFrame, cutoff: str, key: str = "customer_id") -> DataFrame:
    """label = last order before ``cutoff`` (NULL -> 0); features as
    doubles with NULL -> 0."""
    feats = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES]
    return metrics.select(key, *feats, before_flag("last_order_date", cutoff).alias(LABEL))


def with_synthetic_rows(spark: SparkSession, df: DataFrame, key: str = "customer_id") -> DataFrame:
    """X09 (with A10/U01): add the four synthetic rows when only one class is present."""
    n_classes = df.agg(F.countDistinct(LABEL)).first()[0]
    if n_classes >= 2:
        return df
    syn = spark.createDataFrame(
        [(-(i + 1), float(a), float(b), float(c), int(d)) for i, (a, b, c, d) in enumerate(SYNTHETIC_ROWS)],
        f"{key} long, total_orders double, total_spent double, avg_order_value double, {LABEL} int")
    return df.unionByName(syn)


def split_flag(key: str, train_percent: int = 80) -> F.Column:
    """Stable train/test assignment from a hash of the key.

    Unlike ``randomSplit`` it does not depend on partitioning or task
    retries, and the same expression runs in plain SQL.
    """
    h = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long")
    return (h % 100) < train_percent


def train_gbt(train: DataFrame, max_iter: int = 100, max_depth: int = 3, step: float = 0.1,
              seed: int = 42) -> PipelineModel:
    """X11: gradient-boosted trees on the three features.

    The training frame is checkpointed first: boosting makes many passes and
    would otherwise re-run the metrics lineage (joins and aggregates).
    """
    train = train.checkpoint(eager=True)
    asm = VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(featuresCol="features", labelCol=LABEL, maxIter=max_iter, maxDepth=max_depth,
                        stepSize=step, seed=seed)
    return Pipeline(stages=[asm, gbt]).fit(train)


def score(model: PipelineModel, metrics: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``churn_prediction`` for every row (features NULL-filled as in training, Q21)."""
    feats = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES]
    base = metrics.select(*[c for c in keep if c not in FEATURES], *feats)
    out = model.transform(base).withColumn("churn_prediction", F.col("prediction").cast("int"))
    return out.select(*keep, "churn_prediction")


def classification_report(pred: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Per-class precision, recall, F1 and support; 0 when a ratio divides by 0.

    One grouped count of (label, prediction) pairs — a table of classes^2
    rows — then arithmetic per class.
    """
    conf = pred.groupBy(F.col(label).cast("int").alias("y"), F.col(prediction).cast("int").alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    hit = F.col("y") == F.col("p")
    n_hit = F.when(hit, F.col("n")).otherwise(F.lit(0))
    n_miss = F.when(hit, F.lit(0)).otherwise(F.col("n"))
    # each (label, prediction) cell adds tp/fn to its label's class and fp to its prediction's class
    contrib = conf.select(F.explode(F.array(
        F.struct(F.col("y").alias("c"), n_hit.alias("tp"), F.lit(0).cast("long").alias("fp"), n_miss.alias("fn")),
        F.struct(F.col("p").alias("c"), F.lit(0).cast("long").alias("tp"), n_miss.alias("fp"),
                 F.lit(0).cast("long").alias("fn")))).alias("x")).select("x.*")
    agg = contrib.groupBy("c").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    rec = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    r = agg.select(F.col("c").alias("class"), prec.alias("precision"), rec.alias("recall"),
                   (F.col("tp") + F.col("fn")).cast("long").alias("support"))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return r.select("class", "precision", "recall", f1.alias("f1_score"), "support")
