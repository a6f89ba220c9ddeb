"""Derivations over the parcel data: calendar, trips, COD adjustments, ...

These are data operations the warehouse's generator performs one machine
at a time; here each is a Spark job over whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hublytics.functions.semantics import add_hours, date_key
from hublytics.operators.windows import running_total

# Vietnamese day-of-week labels, Monday (1) .. Sunday (7).
DOW_LABELS_VN = ["Thứ 2", "Thứ 3", "Thứ 4", "Thứ 5", "Thứ 6", "Thứ 7", "CN"]


def build_calendar(bounds: DataFrame, holidays_mmdd: list[str] | None = None,
                   holiday_dates: list[str] | None = None) -> DataFrame:
    """One row per day from ``bounds.start`` to ``bounds.end`` (DATE columns).

    Columns: date_id (yyyymmdd), date, year, quarter, month, ISO week,
    day_of_week (1=Monday), its label, weekend and holiday flags. Holidays
    are fixed month-days and/or explicit dates.
    """
    d = F.col("date")
    dow = (F.weekday(d) + 1).cast("int")
    label = None
    for i, name in enumerate(DOW_LABELS_VN, start=1):
        label = F.when(dow == i, name) if label is None else label.when(dow == i, name)
    hol = F.lit(False)
    if holidays_mmdd:
        hol = hol | F.date_format(d, "MM-dd").isin(*holidays_mmdd)
    if holiday_dates:
        hol = hol | F.date_format(d, "yyyy-MM-dd").isin(*holiday_dates)
    days = bounds.select(F.explode(F.sequence(F.col("start"), F.col("end"))).alias("date"))
    return days.select(
        date_key(d).alias("date_id"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.weekofyear(d).alias("week_of_year"),
        dow.alias("day_of_week"),
        label.alias("day_of_week_vn"),
        dow.isin(6, 7).alias("is_weekend"),
        hol.alias("is_holiday_vn"))


def collected_amount(status: Column, cod: Column, pending_amount: Column) -> Column:
    """Amount actually collected for a COD record of a given status:
    collected/transferred -> full COD, failed -> 0, pending -> partial."""
    return (F.when(status.isin("collected", "transferred"), cod)
            .when(status == "failed", F.lit(0.0))
            .when(status == "pending", pending_amount))


def cod_adjustments(cod: DataFrame, threshold: float = 1000.0) -> DataFrame:
    """Append one adjustment record per large unreconciled discrepancy.

    For ``reconcile_status='discrepancy' and abs(discrepancy)>threshold``:
    a new record, status ``adjustment``, reconcile ``pending``, collected =
    the discrepancy, discrepancy 0, collected one day later. New ids follow
    the largest id without gaps, in the order of the records they adjust;
    the numbering is a running count over ranges of ids, so it is not one
    task.
    """
    max_id = cod.select(F.max("cod_id")).scalar()
    large = (cod.filter((F.col("reconcile_status") == "discrepancy")
                        & (F.abs(F.col("discrepancy_amount")) > F.lit(threshold))).withColumn("__all", F.lit(0)))
    numbered = running_total(large, ["__all"], bucket=F.col("cod_id"),
                             order_cols=[F.col("cod_id")], out="__n").drop("__all")
    adj = numbered.withColumns({
        "cod_id": (F.col("__n") + max_id).cast("long"),
        "cod_status": F.lit("adjustment"),
        "reconcile_status": F.lit("pending"),
        "collected_amount": F.col("discrepancy_amount"),
        "discrepancy_amount": F.lit(0.0),
        "collect_time": add_hours(F.col("collect_time"), 24),
        "_data_quality": F.lit("clean"),
    }).drop("__n")
    return cod.unionByName(adj)


def trip_rollup(history: DataFrame, prefix: str = "T") -> DataFrame:
    """Truck trips from package export events: one row per trip code with
    departure = first export time, origin and destination, and the number of
    packages. Origin and destination are those of the first export that knows
    both (neither NULL nor NaN); where none does, the first known one of each.
    First is by time, then package code, then the hubs themselves, so the
    result does not depend on the order of the rows. Partial aggregation keeps
    a hot trip code from landing whole in one task."""
    ex = history.filter((F.col("action_category") == "export") & F.col("trip_code").isNotNull()
                        & F.col("trip_code").startswith(prefix))
    known = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    a, b = "from_warehouse_id", "to_warehouse_id"
    first = lambda of, *cols: F.min(F.when(of, F.struct("action_time", "package_code", *cols)))
    trips = ex.groupBy("trip_code").agg(
        F.min("action_time").alias("departure_time"), first(known(a) & known(b), a, b).alias("both"),
        first(known(a), a).alias("start"), first(known(b), b).alias("goal"), F.count(F.lit(1)).alias("n_packages"))
    return trips.select("trip_code", "departure_time", F.coalesce(f"both.{a}", f"start.{a}").alias(a),
                        F.coalesce(f"both.{b}", f"goal.{b}").alias(b), "n_packages")


def trip_batches(history: DataFrame, orders: DataFrame, capacity: int = 20) -> DataFrame:
    """Consolidate exports into truck loads: per (origin, destination, day
    on which the package's order was created) route, packages in time order
    fill trips of ``capacity``.

    ``orders``: order_code and created_date; of repeated codes the earliest
    date counts, and exports of unknown orders share the route of day NULL.
    Returns one row per trip: route, batch number (0-based), packages,
    first and last export time. The position inside a route is a running
    count (:func:`running_total`), so a hot route is not one task.
    """
    created = orders.groupBy(F.col("order_code").alias("__oc")).agg(F.min("created_date").alias("__created"))
    ex = history.filter(F.col("action_category") == "export")
    ex = (ex.join(created, ex["order_code"] == created["__oc"], "left")
          .select("package_code", "action_time", "from_warehouse_id", "to_warehouse_id",
                  F.to_date("__created").alias("route_day")))
    ranked = running_total(
        ex, ["from_warehouse_id", "to_warehouse_id", "route_day"],
        bucket=F.unix_micros(F.col("action_time").cast("timestamp")),
        order_cols=[F.col("action_time"), F.col("package_code")], out="pos")
    batched = ranked.withColumn("batch_no", F.floor((F.col("pos") - 1) / F.lit(capacity)).cast("long"))
    return batched.groupBy("from_warehouse_id", "to_warehouse_id", "route_day", "batch_no").agg(
        F.count(F.lit(1)).alias("n_packages"),
        F.min("action_time").alias("first_export_at"),
        F.max("action_time").alias("last_export_at"))


def running_minutes(history: DataFrame) -> DataFrame:
    """Per package, events in time order with the running sum of handling
    minutes (minute of the event's hour) and the event's sequence number."""
    ev = history.select("package_code", "action_time", "action_category",
                        F.minute("action_time").cast("long").alias("handling_min"))
    bucket = F.unix_micros(F.col("action_time").cast("timestamp"))
    order = [F.col("action_time"), F.col("action_category").asc_nulls_first()]
    return running_total(ev, ["package_code"], bucket, order,
                         values={"seq_no": None, "cum_minutes": F.col("handling_min")})


def backfill_from_lookup(df: DataFrame, lookup: DataFrame, key: str,
                         fills: dict[str, str]) -> DataFrame:
    """Fill NULL attributes of ``df`` from ``lookup`` by ``key``:
    ``fills`` maps df column -> lookup column. Left join keeps every row."""
    lk = lookup.select(F.col(key).alias("__k"), *[F.col(v).alias(f"__{c}") for c, v in fills.items()])
    j = df.join(lk, df[key] == lk["__k"], "left")
    return j.select(*[F.coalesce(df[c], F.col(f"__{c}")).alias(c) if c in fills else df[c]
                      for c in df.columns])
