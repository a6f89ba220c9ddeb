"""Aggregate marts over the core facts.

Each mart aggregates the fact first (partial aggregation before the
shuffle, so a hot region/day is pre-reduced on the map side) and joins the
small calendar/warehouse dimension afterwards, except where the grain comes
from the dimension itself (week/year/quarter of the SLA and COD marts),
where the broadcast calendar is joined before the aggregate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hublytics.functions.semantics import pct, ratio, round_like
from hublytics.operators.joins import BroadcastPolicy
from hublytics.operators.percentiles import quantile_aggs, rank_histogram

Hint = Callable[[str, DataFrame], DataFrame]


def _hint(hint: Hint | None) -> Hint:
    return hint if hint is not None else BroadcastPolicy()


def _count_if(cond) -> F.Column:
    return F.count_if(cond)


def mart_daily_kpi(fct_order: DataFrame, dim_date: DataFrame, hint: Hint | None = None) -> DataFrame:
    """Daily KPI per delivery region (date_id x region)."""
    o = fct_order
    agg = o.groupBy(F.col("date_id"), F.coalesce(F.col("deliver_region"), F.lit("unknown")).alias("region")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        _count_if(F.col("is_delivered")).alias("delivered_orders"),
        _count_if(F.col("is_returned")).alias("returned_orders"),
        _count_if(F.col("outcome_group") == "cancelled").alias("cancelled_orders"),
        _count_if(F.col("outcome_group") == "in_progress").alias("in_progress_orders"),
        _count_if(F.col("is_sla_breach")).alias("sla_breach_orders"),
        _count_if(F.col("is_cod")).alias("cod_orders"),
        F.sum(F.when(F.col("is_cod"), F.col("cod_amount_vnd"))).alias("cod_amount_vnd"),
        F.sum("weight_gram").alias("total_weight_gram"),
        F.avg(F.when(F.col("is_delivered"), F.col("delivery_hours"))).alias("avg_delivery_hours"))
    d = _hint(hint)("dim_date", dim_date.select(
        "date_id", "date_day", "week_start", "year", "quarter", "month", "day_of_week_vn",
        "is_weekend", "is_holiday_vn"))
    return (agg.join(d, "date_id", "inner").select(
        "date_id", "date_day", "week_start", "year", "quarter", "month", "day_of_week_vn",
        "is_weekend", "is_holiday_vn", "region", "total_orders", "delivered_orders", "returned_orders",
        "cancelled_orders", "in_progress_orders", "sla_breach_orders", "cod_orders",
        F.coalesce(F.col("cod_amount_vnd"), F.lit(0)).cast("long").alias("cod_amount_vnd"),
        "total_weight_gram",
        pct("delivered_orders", "total_orders").alias("success_rate_pct"),
        pct("returned_orders", "total_orders").alias("return_rate_pct"),
        pct("sla_breach_orders", "total_orders").alias("sla_breach_rate_pct"),
        round_like("avg_delivery_hours", 2).alias("avg_delivery_hours")))


def _distinct(col: str, approx_rsd: float | None):
    """Exact distinct count, or HyperLogLog++ with relative error
    ``approx_rsd`` (one small sketch per group instead of a second
    aggregation level keyed by the counted column)."""
    return F.approx_count_distinct(col, approx_rsd) if approx_rsd else F.count_distinct(col)


def hub_sums() -> dict[str, F.Column]:
    """Measures of a hub that add up over its orders."""
    leadtime = F.when(F.col("is_delivered"), F.col("delivery_hours"))
    return {"total_orders": F.count(F.lit(1)), "delivered_orders": _count_if(F.col("is_delivered")),
            "returned_orders": _count_if(F.col("is_returned")), "sla_breach_orders": _count_if(F.col("is_sla_breach")),
            "cod_amount_vnd": F.sum(F.when(F.col("is_cod"), F.col("cod_amount_vnd"))),
            "hours_sum": F.sum(leadtime), "hours_count": F.count(leadtime)}


def hub_from_sums(agg: DataFrame, dim_wh: DataFrame, hint: Hint | None = None) -> DataFrame:
    """The mart from a row a hub: :func:`hub_sums` and active_shippers."""
    w = _hint(hint)("dim_warehouse", dim_wh.select(
        "warehouse_id", "warehouse_name", "warehouse_type", "region", "region_shortname", "province_name"))
    return agg.join(w, "warehouse_id", "inner").select(
        "warehouse_id", "warehouse_name", "warehouse_type", "region", "region_shortname", "province_name",
        "total_orders", "delivered_orders", "returned_orders", "sla_breach_orders", "active_shippers",
        F.coalesce(F.col("cod_amount_vnd"), F.lit(0)).cast("long").alias("cod_amount_vnd"),
        pct("delivered_orders", "total_orders").alias("success_rate_pct"),
        pct("returned_orders", "total_orders").alias("return_rate_pct"),
        pct("sla_breach_orders", "total_orders").alias("sla_breach_rate_pct"),
        round_like(F.col("hours_sum") / F.nullif(F.col("hours_count"), F.lit(0)), 2).alias("avg_delivery_hours"),
        ratio("total_orders", "active_shippers", 1).alias("orders_per_shipper"))


def mart_hub_performance(fct_order: DataFrame, dim_wh: DataFrame, hint: Hint | None = None,
                         approx_rsd: float | None = None) -> DataFrame:
    """Per delivering warehouse: volume, rates, active shippers, leadtime."""
    o = fct_order.filter(F.col("deliver_warehouse_id").isNotNull())
    agg = o.groupBy(F.col("deliver_warehouse_id").alias("warehouse_id")).agg(
        *[f.alias(n) for n, f in hub_sums().items()], _distinct("deliver_user_id", approx_rsd).alias("active_shippers"))
    return hub_from_sums(agg, dim_wh, hint)


SLA_KEYS = ["week_start", "year", "quarter", "region", "service_code"]


def calendar(dim_date: DataFrame, hint: Hint | None = None) -> DataFrame:
    return _hint(hint)("dim_date", dim_date.select("date_id", "week_start", "year", "quarter"))


def delivered_leadtimes(fct_order: DataFrame) -> DataFrame:
    """date_id, region, service_code, is_sla_breach, delivery_hours of delivered orders."""
    return fct_order.filter(F.col("is_delivered")).select(
        "date_id", F.coalesce(F.col("deliver_region"), F.lit("unknown")).alias("region"),
        F.coalesce(F.col("type_order_code"), F.lit("unknown")).alias("service_code"), "is_sla_breach", "delivery_hours")


def sla_from_histogram(hist: DataFrame) -> DataFrame:
    """The mart from leadtime histograms: SLA_KEYS, __x, __c, __cb."""
    q_aggs, q_finals = quantile_aggs({"_p50": 0.5, "_p90": 0.9})
    agg = (rank_histogram(hist, SLA_KEYS).groupBy(*SLA_KEYS)
           .agg(F.sum("__c").alias("delivered_orders"), F.sum("__cb").alias("sla_breach_orders"),
                (F.sum(F.col("__x") * F.col("__c")) / F.nullif(F.max("__n"), F.lit(0))).alias("_avg"),
                *q_aggs)
           .select(*SLA_KEYS, "delivered_orders", "sla_breach_orders", "_avg", *q_finals))
    return _sla_columns(agg)


def _sla_columns(agg: DataFrame) -> DataFrame:
    return agg.select(*SLA_KEYS, "delivered_orders", "sla_breach_orders",
                      pct("sla_breach_orders", "delivered_orders").alias("sla_breach_rate_pct"),
                      round_like("_avg", 2).alias("avg_delivery_hours"),
                      round_like("_p50", 2).alias("p50_delivery_hours"),
                      round_like("_p90", 2).alias("p90_delivery_hours"))


def mart_sla_breakdown(fct_order: DataFrame, dim_date: DataFrame, hint: Hint | None = None,
                       approx_accuracy: int | None = None, builtin_percentile: bool = False) -> DataFrame:
    """SLA by week x year x quarter x region x service, with exact p50/p90
    leadtime (linear interpolation).

    Default: every measure comes from one histogram of leadtimes per group
    (:mod:`hublytics.operators.percentiles`): counts and sums are sums over
    the histogram and the quantiles are read off its cumulative counts, so
    the work per group is bounded by its distinct leadtimes. Options: the
    built-in exact ``percentile`` (value map per group in the aggregation
    buffer) or ``percentile_approx`` with ``approx_accuracy``.
    """
    rows = delivered_leadtimes(fct_order).join(calendar(dim_date, hint), "date_id", "inner")
    h = F.col("delivery_hours")
    if not (approx_accuracy or builtin_percentile):
        return sla_from_histogram(rows.groupBy(*SLA_KEYS, h.alias("__x")).agg(
            F.count(F.lit(1)).alias("__c"), _count_if(F.col("is_sla_breach")).alias("__cb")))
    if approx_accuracy:
        p50, p90 = F.percentile_approx(h, 0.5, approx_accuracy), F.percentile_approx(h, 0.9, approx_accuracy)
    else:
        p50, p90 = F.median(h), F.percentile(h, F.lit(0.9))
    return _sla_columns(rows.groupBy(*SLA_KEYS).agg(
        F.count(F.lit(1)).alias("delivered_orders"), _count_if(F.col("is_sla_breach")).alias("sla_breach_orders"),
        F.avg(h).alias("_avg"), p50.alias("_p50"), p90.alias("_p90")))


def mart_failure_reasons(fct_attempt: DataFrame, approx_rsd: float | None = None,
                         ordered: bool = True) -> DataFrame:
    """Failed attempts per region x reason and the share of the region's
    failures. The share is taken against the region's own total with plain
    equality, so the 'unknown' (NULL) region gets a NULL share. ``ordered``
    sorts by region, then attempts descending; a table write does not keep
    row order, so writers pass ``ordered=False`` and skip the sort."""
    s = fct_attempt.filter(F.col("is_failed") & F.col("failure_reason").isNotNull())
    per = s.groupBy("deliver_region", "failure_reason").agg(
        F.count(F.lit(1)).alias("failed_attempts"),
        _distinct("order_code", approx_rsd).alias("affected_orders"))
    # region totals from the small aggregate (regions x reasons rows)
    region_total = F.sum("failed_attempts").over(Window.partitionBy("deliver_region"))
    out = per.select(
        F.coalesce(F.col("deliver_region"), F.lit("unknown")).alias("region"),
        "failure_reason", "failed_attempts", "affected_orders",
        F.when(F.col("deliver_region").isNotNull(), pct(F.col("failed_attempts"), region_total))
         .alias("pct_of_region_failures"))
    return out.orderBy(F.col("region").asc_nulls_last(), F.col("failed_attempts").desc_nulls_last()) if ordered \
        else out


def mart_cod_reconciliation(fct_cod: DataFrame, dim_date: DataFrame, hint: Hint | None = None) -> DataFrame:
    """COD due vs collected per week x year x quarter x collecting region."""
    d = _hint(hint)("dim_date", dim_date.select("date_id", "week_start", "year", "quarter"))
    c = fct_cod
    return (c.join(d, "date_id", "inner")
            .groupBy("week_start", "year", "quarter",
                     F.coalesce(F.col("warehouse_region"), F.lit("unknown")).alias("region"))
            .agg(F.count(F.lit(1)).alias("cod_records"),
                 _count_if(F.col("has_discrepancy")).alias("discrepancy_records"),
                 F.sum("cod_amount_vnd").alias("total_cod_amount_vnd"),
                 F.sum("collected_amount_vnd").alias("total_collected_vnd"),
                 F.sum("discrepancy_amount_vnd").alias("net_discrepancy_vnd"),
                 F.sum("abs_discrepancy_vnd").alias("gross_discrepancy_vnd"))
            .select("week_start", "year", "quarter", "region", "cod_records", "discrepancy_records",
                    "total_cod_amount_vnd", "total_collected_vnd", "net_discrepancy_vnd", "gross_discrepancy_vnd",
                    pct("discrepancy_records", "cod_records").alias("discrepancy_rate_pct"),
                    pct("total_collected_vnd", "total_cod_amount_vnd").alias("collection_rate_pct")))
