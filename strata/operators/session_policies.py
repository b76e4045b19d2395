"""Policies that ask for the session's current role.

The role is a session variable, the masks are SQL functions that read it, and
a secured table is a temporary view that applies them. One view serves all
roles: ``use_role`` changes what the next query on it sees. Spark resolves the
variable when a query is analysed and folds it, so a mask costs a role only
what its own branch does, and filters on other columns still reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.operators.governance import ALL_ROWS_ROLES, ANALYST_ROLE, FULL_ACCESS_ROLES, REDACTED

ROLE = "current_role_name"


def _listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def install(spark: SparkSession, role: str = "PUBLIC") -> None:
    """Declare the role variable and the mask functions in this session."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {ROLE} STRING DEFAULT 'PUBLIC'")
    use_role(spark, role)
    for name, analyst, other in (("email_mask", "regexp_replace(val, '.*@', '****@')", f"'{REDACTED}'"),
                                 ("tier_mask", "'***'", "CAST(NULL AS STRING)")):
        spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(val STRING) RETURNS STRING RETURN
            CASE WHEN session.{ROLE} IN ({_listed(FULL_ACCESS_ROLES)}) THEN val
                 WHEN session.{ROLE} = '{ANALYST_ROLE}' THEN {analyst} ELSE {other} END""")


def use_role(spark: SparkSession, role: str) -> None:
    """The current role from now on; queries analysed before keep theirs."""
    spark.sql(f"SET VARIABLE {ROLE} = :role", {"role": role})


def current_role(spark: SparkSession) -> str:
    return spark.sql(f"SELECT session.{ROLE}").first()[0]


def secure(spark: SparkSession, view: str, source: DataFrame, masks: dict[str, str] | None = None,
           region_col: str | None = None, access_map: str | None = None) -> None:
    """Create the temporary view ``view`` of ``source`` as the current role may see it.

    ``masks``: column to mask function. ``region_col`` and the view
    ``access_map`` (role_name, region): rows of the role's regions, all rows if
    one of them is NULL or the role sees everything. The test is a semi-join on
    the region beside a wildcard test, never a loop over pairs.
    """
    raw, masks = f"{view}_unsecured", masks or {}
    source.createOrReplaceTempView(raw)
    columns = ", ".join(f"{masks[c]}(`{c}`) AS `{c}`" if c in masks else f"`{c}`" for c in source.columns)
    where = "" if region_col is None else f"""
        WHERE session.{ROLE} IN ({_listed(ALL_ROWS_ROLES)})
           OR (SELECT count(*) > 0 FROM {access_map} WHERE role_name = session.{ROLE} AND region IS NULL)
           OR `{region_col}` IN (SELECT region FROM {access_map} WHERE role_name = session.{ROLE} AND region IS NOT NULL)"""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {view} AS SELECT {columns} FROM {raw}{where}")
