"""SQL access to the warehouse: views, catalog tables and partitioned exports."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from hublytics.plans.warehouse import Warehouse
from hublytics.sources.sinks import TableError, newest_path, parent_path, plain_path, write_table


def register_views(wh: Warehouse, models: list[str] | None = None) -> list[str]:
    """Expose models as session temp views under their model names, so SQL
    text (dashboard cards, ad-hoc queries) runs through Catalyst on the same
    lazy plans (or written tables) the DataFrame API uses."""
    names = models or Warehouse.MODELS
    for n in names:
        wh[n].createOrReplaceTempView(n)
    return names


def publish_to_catalog(spark: SparkSession, paths: dict[str, str], schema: str) -> list[str]:
    """Make published tables known to SQL as tables of ``schema``, or point
    those made earlier by this function at the newest versions. A table of that
    name whose files lie elsewhere is somebody else's: it raises, and nothing
    is ever dropped."""
    spark.sql(f"create schema if not exists {_name(schema)}")
    out = []
    for name, path in paths.items():
        table = f"{_name(schema)}.{_name(name)}"
        current = newest_path(spark, path)
        if spark.catalog.tableExists(table):
            rows = spark.sql(f"describe table extended {table}").filter("col_name = 'Location'").collect()
            at = rows[0]["data_type"] if rows else ""
            if parent_path(spark, at) != plain_path(spark, path):
                raise TableError(f"{schema}.{name} exists at {at or 'no path'}, not under {path}")
            spark.sql(f"alter table {table} set location '{current}'")
            spark.catalog.refreshTable(table)
        else:
            spark.sql(f"create table {table} using parquet location '{current}'")
        out.append(f"{schema}.{name}")
    return out


def _name(part: str) -> str:
    return "`" + part.replace("`", "``") + "`"


def run_sql(spark: SparkSession, tables: dict[str, DataFrame], sql: str, schema: str = "main_mart") -> DataFrame:
    """Run SQL written against schema-qualified names (for example
    ``main_mart.mart_daily_kpi``) on the given ``tables``, without touching the
    catalog: each qualified name of a given table outside quotes becomes a
    session view of its own, so a real ``main_mart`` is neither read nor
    changed."""
    tag = uuid.uuid4().hex
    named = re.compile(r"'(?:[^'\\]|\\.|'')*'|\b" + re.escape(schema) + r"\s*\.\s*`?(\w+)`?", re.IGNORECASE)
    lower = {n.lower(): n for n in tables}

    def view(m: re.Match) -> str:
        name = lower.get((m[1] or "").lower())
        return f"`{name}_{tag}`" if name else m[0]

    for name, df in tables.items():
        df.createOrReplaceTempView(f"{name}_{tag}")
    try:
        return spark.sql(named.sub(view, sql))
    finally:  # the plan holds the tables themselves
        for name in tables:
            spark.catalog.dropTempView(f"{name}_{tag}")


def export_marts(wh: Warehouse, root: str, partition_by_week: bool = True) -> dict[str, str]:
    """Write every mart as snappy parquet under ``root``; marts with a
    ``week_start`` column are partitioned by it (directory pruning for
    week-range reads)."""
    out = {}
    for m in Warehouse.MARTS:
        df = wh[m]
        part = ["week_start"] if partition_by_week and "week_start" in df.columns else None
        path = os.path.join(root, m)
        write_table(df, path, partition_by=part)
        out[m] = path
    return out
