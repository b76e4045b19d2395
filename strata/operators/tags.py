"""Column tags found in the data.

* ``profile``: one pass per table counts, for every text column, the values
  that are or hold an email address, a phone number and so on.
* ``propose``: the tags those rates speak for.
* ``TagTable``: tags as a stored table; a tag takes its allowed values only.
* ``tagged``: a table whose columns carry their tags as metadata, which
  projections, filters and joins keep; ``tags_of`` reads them off any result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.governance import PII_VALUES, TagError
from strata.sources.store import BucketedTable

PII_TAG = "PII_TAG"
# what a value of each kind looks like; written so that Java and RE2 agree
PATTERNS = {
    "EMAIL": r"[A-Za-z0-9._%+#-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "SSN": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "PHONE": r"\+[0-9]{1,3} ?\(?[0-9]{3}\)? ?[0-9]{3}-[0-9]{4}",
    "NAME": r"(Customer|Supplier)#[0-9]{9}",
    "ADDRESS": r"[0-9]{1,5} [A-Z][a-z]+ (Street|Avenue|Road|Lane)",
}
# a character without which no value has the pattern: most texts are settled by it
NEEDS = {"EMAIL": "@", "SSN": "-", "PHONE": "+", "NAME": "#", "ADDRESS": " "}
WHOLE_RATE, PART_RATE = 0.8, 0.001  # a column of such values; a text column that holds some


def profile(df: DataFrame, object_name: str) -> DataFrame:
    """One row per text column and pattern: ``object_name, column_name,
    tag_value, n_values, whole, part`` (values that are one, values that hold one)."""
    columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not columns:
        return df.sparkSession.createDataFrame([], "object_name string, column_name string, tag_value string, n_values long, whole long, part long")
    counts = [F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(columns)]
    for i, c in enumerate(columns):
        for kind, pattern in PATTERNS.items():
            value = F.col(f"`{c}`")
            part = value.contains(NEEDS[kind]) & value.rlike(pattern)
            counts += [F.count_if(part & value.rlike(f"^({pattern})$")).alias(f"w{i}{kind}"), F.count_if(part).alias(f"p{i}{kind}")]
    cells = F.array(*(F.struct(F.lit(object_name).alias("object_name"), F.lit(c).alias("column_name"), F.lit(kind).alias("tag_value"),
                               F.col(f"n{i}").alias("n_values"), F.col(f"w{i}{kind}").alias("whole"), F.col(f"p{i}{kind}").alias("part"))
                      for i, c in enumerate(columns) for kind in PATTERNS))
    return df.agg(*counts).select(F.explode(cells).alias("c")).select("c.*")


def propose(profiles: DataFrame) -> DataFrame:
    """The tags for which a column's rates speak: ``object_name, column_name, tag_name, tag_value, certain``
    (whether the column's values are such values, or only hold some)."""
    whole = F.col("whole") >= WHOLE_RATE * F.col("n_values")
    return (profiles.filter((F.col("n_values") > 0) & (whole | (F.col("part") >= PART_RATE * F.col("n_values"))))
            .select("object_name", "column_name", F.lit(PII_TAG).alias("tag_name"), "tag_value", whole.alias("certain")))


class TagTable:
    """Tag references at ``path``; a column has a tag's value once."""

    SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("object_name", "column_name", "tag_name", "tag_value")])

    def __init__(self, spark: SparkSession, path: str, allowed: Mapping[str, Sequence[str]] = {PII_TAG: PII_VALUES}):
        self.spark, self.allowed = spark, spark.createDataFrame(
            [(t, v) for t, values in allowed.items() for v in values], "tag_name string, tag_value string")
        self.store = BucketedTable(spark, path, ["object_name", "column_name"], 4, self.SCHEMA)
        if not self.store.exists():
            self.store.write(spark.createDataFrame([], self.SCHEMA))

    def set(self, refs: DataFrame) -> None:
        """Add references; none is added if one names a tag or a value that isn't allowed."""
        # written once: the check, the buckets touched and the merge read it, and profiles are dear
        refs = refs.select(*self.SCHEMA.fieldNames()).distinct().checkpoint(eager=True)
        wrong = refs.join(self.allowed, ["tag_name", "tag_value"], "left_anti").first()
        if wrong is not None:
            raise TagError(f"value {wrong.tag_value!r} is not allowed for tag {wrong.tag_name}")
        self.store.merge(refs, lambda old, new: old.unionByName(new).distinct(), may_delete=False)

    def references(self) -> DataFrame:
        return self.store.read()

    def of(self, object_name: str) -> DataFrame:
        """The tagged columns of one table."""
        return self.references().filter(F.col("object_name") == object_name)


def tagged(df: DataFrame, refs: DataFrame) -> DataFrame:
    """``df`` with the tags of ``refs`` (its own columns' references; a row per
    column and tag) in its columns' metadata, beside what is there."""
    found: dict[str, dict[str, list[str]]] = {}
    for r in refs.select("column_name", "tag_name", "tag_value").distinct().collect():
        found.setdefault(r.column_name, {}).setdefault(r.tag_name, []).append(r.tag_value)
    for c, tags in found.items():
        if c in df.columns:
            known = df.schema[c].metadata
            df = df.withMetadata(c, known | {"tags": known.get("tags", {}) | {t: sorted(v) for t, v in tags.items()}})
    return df


def tags_of(df: DataFrame, object_name: str) -> DataFrame:
    """The tags that a result's columns carry."""
    rows = [(object_name, f.name, tag, value) for f in df.schema.fields
            for tag, values in f.metadata.get("tags", {}).items() for value in values]
    return df.sparkSession.createDataFrame(rows, TagTable.SCHEMA)
