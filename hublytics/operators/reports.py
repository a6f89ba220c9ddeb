"""Dashboard report queries over the marts.

Each card of the reference dashboards, using the columns the marts really
emit. Weekly cards re-aggregate the daily mart (sums of counts, ratios of
sums). Top-k cards are ``orderBy(...).limit(k)`` with full tie-breakers, so
the k rows are deterministic; Spark plans them as TakeOrderedAndProject
(per-partition top-k, then a merge of at most k rows per partition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hublytics.functions.semantics import pct, round_like


def _weekly(kpi: DataFrame) -> DataFrame:
    return kpi.groupBy("week_start").agg(
        F.sum("total_orders").alias("total_orders"),
        F.sum("delivered_orders").alias("delivered_orders"),
        F.sum("sla_breach_orders").alias("sla_breach_orders"),
        F.sum("cod_amount_vnd").alias("cod_amount_vnd"))


def rpt_kpi_weekly_summary(kpi: DataFrame, weeks: int = 52) -> DataFrame:
    """Latest ``weeks`` weeks: volume, success and SLA-breach rate, COD."""
    w = _weekly(kpi)
    return (w.select("week_start", "total_orders",
                     pct("delivered_orders", "total_orders").alias("success_rate_pct"),
                     pct("sla_breach_orders", "total_orders").alias("sla_breach_rate_pct"),
                     "cod_amount_vnd")
            .orderBy(F.col("week_start").desc()).limit(weeks))


def rpt_weekly_volume(kpi: DataFrame) -> DataFrame:
    return _weekly(kpi).select("week_start", "total_orders").orderBy("week_start")


def rpt_success_trend(kpi: DataFrame) -> DataFrame:
    return (_weekly(kpi).select("week_start", pct("delivered_orders", "total_orders").alias("success_rate_pct"))
            .orderBy("week_start"))


def rpt_hub_throughput(hub: DataFrame, k: int = 20) -> DataFrame:
    return (hub.select("warehouse_id", "total_orders", "success_rate_pct", "avg_delivery_hours")
            .orderBy(F.col("total_orders").desc(), F.col("warehouse_id").asc()).limit(k))


def rpt_top_hubs(hub: DataFrame, k: int = 10) -> DataFrame:
    return (hub.select("warehouse_id", "total_orders")
            .orderBy(F.col("total_orders").desc(), F.col("warehouse_id").asc()).limit(k))


def rpt_sla_week_region(sla: DataFrame, k: int = 100) -> DataFrame:
    return (sla.select("week_start", "year", "quarter", "region", "service_code", "sla_breach_rate_pct",
                       "delivered_orders")
            .orderBy(F.col("week_start").desc(), F.col("sla_breach_rate_pct").desc_nulls_last(),
                     "year", "quarter", "region", "service_code")
            .limit(k))


def rpt_sla_by_region(sla: DataFrame) -> DataFrame:
    """Unweighted mean of the per-group breach rates (as the card computes
    it), shown to 6 decimals, and delivered volume per region."""
    return (sla.groupBy("region")
            .agg(round_like(F.avg("sla_breach_rate_pct"), 6).alias("avg_breach_rate"),
                 F.sum("delivered_orders").alias("total"))
            .orderBy(F.col("avg_breach_rate").desc_nulls_last(), "region"))


def rpt_failure_distribution(fail: DataFrame, k: int = 10) -> DataFrame:
    return (fail.select("region", "failure_reason", "failed_attempts")
            .orderBy(F.col("failed_attempts").desc(), "region", "failure_reason").limit(k))


def rpt_cod_by_region(cod: DataFrame) -> DataFrame:
    return (cod.select("week_start", "region", "year", "discrepancy_records", "gross_discrepancy_vnd",
                       "net_discrepancy_vnd")
            .orderBy(F.col("year").desc(), F.abs(F.col("net_discrepancy_vnd")).desc(), "week_start", "region"))


def rpt_hub_rank(hub: DataFrame) -> DataFrame:
    """Hubs ranked by volume inside their region (ties share a rank). The
    window is partitioned by region over the small hub mart."""
    w = Window.partitionBy("region").orderBy(F.col("total_orders").desc())
    return hub.select("warehouse_id", "region", "total_orders", F.rank().over(w).cast("long").alias("hub_rank"))


REPORTS = {
    "rpt_kpi_weekly_summary": ("mart_daily_kpi", rpt_kpi_weekly_summary),
    "rpt_weekly_volume": ("mart_daily_kpi", rpt_weekly_volume),
    "rpt_success_trend": ("mart_daily_kpi", rpt_success_trend),
    "rpt_hub_throughput": ("mart_hub_performance", rpt_hub_throughput),
    "rpt_top_hubs": ("mart_hub_performance", rpt_top_hubs),
    "rpt_sla_week_region": ("mart_sla_breakdown", rpt_sla_week_region),
    "rpt_sla_by_region": ("mart_sla_breakdown", rpt_sla_by_region),
    "rpt_failure_distribution": ("mart_failure_reasons", rpt_failure_distribution),
    "rpt_cod_by_region": ("mart_cod_reconciliation", rpt_cod_by_region),
    "rpt_hub_rank": ("mart_hub_performance", rpt_hub_rank),
}
