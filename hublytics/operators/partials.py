"""Partial states of marts by day, so that a new day costs its own rows.

A mart over weeks or over all time is not a sum of daily marts where it holds
distinct counts or quantiles. Their states are, if kept in a form that merges
exactly:

* leadtimes: a histogram (value -> orders, breaches) for each day, region and
  service; histograms add up, and quantiles are read off the sum as the full
  build reads them (:mod:`hublytics.operators.percentiles`);
* active shippers: bitmaps of whole-number ids for each day and hub, 64 ids a
  bitmap of one LONG; bitmaps merge by OR, and their bits are counted. No row
  of the counted column is kept or shuffled again. A day and hub has few of all
  shippers: wide bitmaps (4 KB for 32,768 ids) would be nearly all zeros, one of
  them for almost every order, and as variable-width buffers they would be sorted.

:func:`replace_days` puts the states of some days in place of those of the same days;
a table of states grows with days and groups, not with orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hublytics.operators import marts

#: log2 of the ids in a bitmap: one LONG's bits
WORD_BITS = 6
LEADTIME_KEYS = ["date_id", "region", "service_code", "__x"]
HUB_KEYS = ["date_id", "warehouse_id"]


def leadtime_states(fct_order: DataFrame) -> DataFrame:
    """date_id, region, service_code, __x (leadtime), __c (orders), __cb
    (breaches) of the delivered orders."""
    o = marts.delivered_leadtimes(fct_order)
    return o.groupBy("date_id", "region", "service_code", F.col("delivery_hours").alias("__x")).agg(
        F.count(F.lit(1)).alias("__c"), F.count_if("is_sla_breach").alias("__cb"))


def sla_breakdown(states: DataFrame, dim_date: DataFrame, hint=None) -> DataFrame:
    """``mart_sla_breakdown`` from :func:`leadtime_states`."""
    d = marts.calendar(dim_date, hint)
    hist = (states.join(d, "date_id").groupBy(*marts.SLA_KEYS, "__x")
            .agg(F.sum("__c").alias("__c"), F.sum("__cb").alias("__cb")))
    return marts.sla_from_histogram(hist)


def hub_states(fct_order: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(measures by date_id and warehouse_id, bitmaps of the shippers by
    date_id, warehouse_id and bucket of 64 ids)."""
    o = fct_order.filter(F.col("deliver_warehouse_id").isNotNull()).withColumn("warehouse_id", F.col("deliver_warehouse_id"))
    measures = o.groupBy(*HUB_KEYS).agg(*[f.alias(n) for n, f in marts.hub_sums().items()])
    who = F.col("deliver_user_id")
    ids = o.filter(who.isNotNull())
    bit = F.expr(f"shiftleft(1L, cast(deliver_user_id & {2 ** WORD_BITS - 1} as int))")
    bitmaps = ids.groupBy(*HUB_KEYS, F.shiftright(who, WORD_BITS).alias("bucket")).agg(F.bit_or(bit).alias("shippers"))
    return measures, bitmaps


def hub_performance(measures: DataFrame, bitmaps: DataFrame, dim_wh: DataFrame, hint=None) -> DataFrame:
    """``mart_hub_performance`` from :func:`hub_states`."""
    sums = measures.groupBy("warehouse_id").agg(*[F.sum(n).alias(n) for n in marts.hub_sums()])
    merged = bitmaps.groupBy("warehouse_id", "bucket").agg(F.bit_count(F.bit_or("shippers")).alias("n"))
    active = merged.groupBy("warehouse_id").agg(F.sum("n").alias("active_shippers"))
    joined = sums.join(active, "warehouse_id", "left").withColumn("active_shippers", F.coalesce("active_shippers", F.lit(0)))
    return marts.hub_from_sums(joined, dim_wh, hint)


def replace_days(states: DataFrame | None, fresh: DataFrame, days: DataFrame) -> DataFrame:
    """``states`` with the rows of ``days`` (date_id) replaced by ``fresh``,
    which holds states of these days only. A day that lost all its orders goes.
    NULL days are a day of their own."""
    if states is None:
        return fresh
    d = days.select(F.col("date_id").alias("__day")).distinct()
    return states.join(d, F.col("date_id").eqNullSafe(F.col("__day")), "left_anti").unionByName(fresh)
