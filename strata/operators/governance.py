"""Column masks, row access, tags, audits, budgets and grants.

The role is an explicit argument (there is no CURRENT_ROLE in Spark), so a
policy compiles to a constant-folded CASE: the masked column costs nothing
for privileged roles and one regexp for analysts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.operators.joins import semi_join_or_null
from strata.operators.relational import running_total  # noqa: F401  (re-exported)

# Role names and mask texts of the reference's policies.
FULL_ACCESS_ROLES = ("DATA_ENGINEER_FR", "SYSADMIN", "ACCOUNTADMIN")
ANALYST_ROLE = "ANALYST_FR"
ALL_ROWS_ROLES = ("ACCOUNTADMIN", "SYSADMIN")
REDACTED = "***REDACTED***"
PII_VALUES = ("EMAIL", "SSN", "PHONE", "NAME", "ADDRESS")


def email_mask(val: Column, role: str) -> Column:
    """Full for engineers/admins, ``****@domain`` for analysts, else redacted."""
    r = F.lit(role)
    return (F.when(r.isin(*FULL_ACCESS_ROLES), val)
            .when(r == ANALYST_ROLE, F.regexp_replace(val, ".*@", "****@"))
            .otherwise(F.lit(REDACTED)))


def tier_mask(val: Column, role: str) -> Column:
    """Full / ``***`` / NULL."""
    r = F.lit(role)
    return (F.when(r.isin(*FULL_ACCESS_ROLES), val)
            .when(r == ANALYST_ROLE, F.lit("***"))
            .otherwise(F.lit(None).cast("string")))


def secured(df: DataFrame, role: str, column_policies: dict[str, Callable[[Column, str], Column]] | None = None,
            row_policy: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """The table as ``role`` sees it — rows filtered, then columns masked.

    Policies apply below the user's query, so every later projection, filter
    or aggregate sees only masked values.
    """
    out = row_policy(df, role) if row_policy is not None else df
    for c, policy in (column_policies or {}).items():
        out = out.withColumn(c, policy(F.col(c), role))
    return out


def region_access(access_map: DataFrame, region_col: str = "region") -> Callable[[DataFrame, str], DataFrame]:
    """Admins see all rows; other roles see rows whose region is mapped to
    them, or every row when their mapping is NULL (wildcard).

    ``access_map`` (role_name, region) is filtered to the one role first, then
    the EXISTS becomes a wildcard test plus an outer hash join on the region.
    A NULL row region is visible only through the wildcard (Q23).
    """

    def policy(df: DataFrame, role: str) -> DataFrame:
        if role in ALL_ROWS_ROLES:
            return df
        m = access_map.filter(F.col("role_name") == role)
        return semi_join_or_null(df, m, region_col, "region")

    return policy


# ------------------------------------------------------------------- tags --

class TagError(ValueError):
    pass


@dataclass
class TagRegistry:
    """Tags with allowed values, one value per (object, column, tag)."""

    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    refs: dict[tuple[str, str, str, str, str], str] = field(default_factory=dict)

    def create_tag(self, name: str, allowed_values: Sequence[str]) -> None:
        self.allowed.setdefault(name.upper(), tuple(allowed_values))

    def set_tag(self, database: str, schema: str, obj: str, column: str, tag: str, value: str) -> None:
        t = tag.upper()
        if t not in self.allowed:
            raise TagError(f"tag {tag} does not exist")
        if value not in self.allowed[t]:
            raise TagError(f"value {value!r} is not allowed for tag {tag}")
        self.refs[(database.upper(), schema.upper(), obj.upper(), column.upper(), t)] = value

    def references(self, spark: SparkSession) -> DataFrame:
        rows = [(*k, v) for k, v in sorted(self.refs.items())]
        return spark.createDataFrame(
            rows, "object_database string, object_schema string, object_name string, column_name string, "
                  "tag_name string, tag_value string")


def tag_references_for_table(refs: DataFrame, database: str, schema: str, obj: str, tag: str) -> DataFrame:
    """Tagged columns of one table."""
    return refs.filter((F.col("object_database") == database.upper()) & (F.col("object_schema") == schema.upper())
                       & (F.col("object_name") == obj.upper()) & (F.col("tag_name") == tag.upper())).select(
        "object_database", "object_schema", "object_name", "column_name", F.col("tag_value").alias("pii_type"))


def tag_references_all(refs: DataFrame, tag: str) -> DataFrame:
    """Every column carrying ``tag``, ordered by object and column."""
    return (refs.filter(F.col("tag_name") == tag.upper())
            .select("object_database", "object_schema", "object_name", "column_name",
                    F.col("tag_value").alias("pii_classification"))
            .orderBy("object_name", "column_name"))


# ----------------------------------------------------------------- audits --

def access_audit(query_log: DataFrame, pattern: str, as_of: Column, hours: int = 24) -> DataFrame:
    """Queries whose text matches ``pattern`` (ILIKE) in the last ``hours``, newest first."""
    since = F.timestamp_add("HOUR", F.lit(-hours), as_of)
    return (query_log.filter(F.col("query_text").ilike(pattern) & (F.col("start_time") >= since))
            .orderBy(F.col("start_time").desc_nulls_first(), F.col("event_id").desc()))


def usage_by_warehouse(metering: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Credits per warehouse over the last ``days`` days, largest first.

    Credits are summed as DECIMAL so the total does not depend on the order
    in which partial sums meet.
    """
    since = F.timestamp_add("DAY", F.lit(-days), as_of)
    c = F.col("credits_used").cast("decimal(18,4)")
    return (metering.filter(F.col("start_time") >= since).groupBy("warehouse_name")
            .agg(F.sum(c).cast("double").alias("total_credits"),
                 F.sum(c).cast("double").alias("compute_credits"),
                 F.count(F.lit(1)).alias("query_count"))
            .orderBy(F.col("total_credits").desc_nulls_first()))


def budget_alerts(metering: DataFrame, daily_quota: float,
                  triggers: Sequence[tuple[int, str]] = ((80, "NOTIFY"), (100, "SUSPEND")),
                  partitions: int | None = None) -> DataFrame:
    """First metering row of each day at which the running credit total
    reaches each trigger percentage of ``daily_quota``.

    Credits are non-negative, so the running total is monotone and the first
    crossing is the minimum (time, id) among rows at or above the level — an
    aggregate with map-side partials.
    """
    m = metering.select(F.to_date("start_time").alias("usage_day"), "start_time", "event_id",
                        F.col("credits_used").cast("decimal(18,4)").alias("credits"))
    run = running_total(m, "usage_day", ["start_time", "event_id"], "credits", partitions)
    # one grouped pass for all levels: per level, the smallest (time, id) at or above it
    firsts = []
    for i, (pct, _) in enumerate(triggers):
        level = F.lit(daily_quota * pct / 100.0).cast("decimal(18,4)")
        hit = F.when(F.col("running_total") >= level, F.struct("start_time", "event_id", "running_total"))
        firsts.append(F.min(hit).alias(f"_f{i}"))
    per_day = run.groupBy("usage_day").agg(*firsts)
    cells = F.array(*[F.struct(F.lit(pct).alias("trigger_percent"), F.lit(action).alias("action"),
                               F.col(f"_f{i}").alias("f")) for i, (pct, action) in enumerate(triggers)])
    return (per_day.select("usage_day", F.explode(cells).alias("c")).filter(F.col("c.f").isNotNull())
            .select("usage_day", "c.trigger_percent", "c.action", F.col("c.f.start_time").alias("start_time"),
                    F.col("c.f.event_id").alias("event_id"),
                    F.col("c.f.running_total").cast("double").alias("running_credits")))


# ----------------------------------------------------------------- grants --

def role_closure(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """All (role, inherited role) pairs of ``GRANT ROLE child TO ROLE parent``.

    Semi-naive doubling: the pairs found in the last round are joined to all
    known ones, so a round reaches twice as far and a hierarchy of depth d
    takes about log2(d) rounds; it stops when no pair is new. Only new pairs
    are checkpointed (reliable storage) and the closure is the union of the
    rounds. Cycles end because known pairs are never re-added.
    """
    e = edges.select(F.col(child).alias("child"), F.col(parent).alias("parent")).distinct()
    closure = frontier = e.checkpoint(eager=True)
    while True:
        step = (frontier.alias("f").join(closure.alias("e"), F.col("f.parent") == F.col("e.child"))
                .select(F.col("f.child").alias("child"), F.col("e.parent").alias("parent")).distinct())
        new = step.join(closure, ["child", "parent"], "left_anti").checkpoint(eager=True)
        if new.isEmpty():
            return closure
        closure = closure.unionByName(new)
        frontier = new


def effective_privileges(closure: DataFrame, grants: DataFrame, tables: DataFrame) -> DataFrame:
    """(role, privilege, schema, table) a role holds directly or by inheritance.

    ``grants``: role, privilege, schema_name, scope ('ALL' | 'FUTURE'),
    granted_at. ``tables``: schema_name, table_name, created_at. ALL covers
    tables existing at grant time, FUTURE the ones created later.
    """
    # GRANT ROLE child TO ROLE parent: the parent holds what the child was granted
    holders = closure.select(F.col("parent").alias("role"), F.col("child").alias("via")).unionByName(
        grants.select(F.col("role"), F.col("role").alias("via")).distinct())
    g = holders.join(grants.withColumnRenamed("role", "via"), "via")
    covered = ((F.col("scope") == "ALL") & (F.col("created_at") <= F.col("granted_at"))) | \
              ((F.col("scope") == "FUTURE") & (F.col("created_at") > F.col("granted_at")))
    return (g.join(tables, "schema_name").filter(covered)
            .select("role", "privilege", "schema_name", "table_name").distinct())
