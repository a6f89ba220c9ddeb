"""Staging: typed, cleaned views of the 11 raw tables.

Facts drop quarantined rows (``_data_quality = 'heavy_issue'``) before any
other step; dimensions keep every key and only clean attributes, so facts
never lose their parents. Orders are deduplicated on the raw order code,
keeping the newest row. Everything is a projection/filter (narrow, no
shuffle); the order dedup moves keys only (:mod:`hublytics.operators.dedup`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hublytics.functions.semantics import (
    clean_text, hours_between, lower_trim, money, normalize_order_status, normalize_plate,
    order_outcome_group, parse_date, parse_timestamp, to_bigint,
)
from hublytics.operators.dedup import dedup_latest, first_places, keep_first  # noqa: F401

QUARANTINE_FLAG = "heavy_issue"


# ---------------------------------------------------------------- routing

def keep_non_quarantine(df: DataFrame, flag: str = QUARANTINE_FLAG,
                        col: str = "_data_quality") -> DataFrame:
    """Main flow: rows whose quality flag is NULL or not ``flag``."""
    q = F.col(col)
    return df.filter(q.isNull() | (q != F.lit(flag)))


def only_quarantine(df: DataFrame, flag: str = QUARANTINE_FLAG,
                    col: str = "_data_quality") -> DataFrame:
    """Audit flow: exactly the rows :func:`keep_non_quarantine` drops."""
    return df.filter(F.col(col) == F.lit(flag))


# ---------------------------------------------------------------- casts

def _typ(df: DataFrame, name: str) -> str:
    return dict(df.dtypes)[name]


def as_long(df: DataFrame, name: str) -> Column:
    """``cast(x as bigint)`` with the warehouse's rounding: a DOUBLE source is
    rounded half to even first (Spark's cast would truncate)."""
    if _typ(df, name) in ("double", "float"):
        return F.rint(F.col(name)).cast("long")
    return F.col(name).cast("long")


def as_ts(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz")


# ---------------------------------------------------------------- dimensions

def stg_province(raw: DataFrame) -> DataFrame:
    return raw.select(
        as_long(raw, "province_id").alias("province_id"),
        clean_text("province_name").alias("province_name"),
        clean_text("region").alias("region"),
        F.col("region_idx").cast("int").alias("region_idx"))


def stg_district(raw: DataFrame) -> DataFrame:
    return raw.select(
        as_long(raw, "district_id").alias("district_id"),
        clean_text("district_name").alias("district_name"),
        as_long(raw, "province_id").alias("province_id"))


def stg_date(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("date_id").cast("int").alias("date_id"),
        F.col("date").cast("date").alias("date_day"),
        F.col("year").cast("int").alias("year"),
        F.col("quarter").cast("int").alias("quarter"),
        F.col("month").cast("int").alias("month"),
        F.col("week_of_year").cast("int").alias("week_of_year"),
        F.col("day_of_week").cast("int").alias("day_of_week"),
        clean_text("day_of_week_vn").alias("day_of_week_vn"),
        F.col("is_weekend").cast("boolean").alias("is_weekend"),
        F.col("is_holiday_vn").cast("boolean").alias("is_holiday_vn"))


def stg_warehouse(raw: DataFrame) -> DataFrame:
    return raw.select(
        as_long(raw, "warehouse_id").alias("warehouse_id"),
        clean_text("warehouse_name").alias("warehouse_name"),
        clean_text("warehouse_type").alias("warehouse_type"),
        to_bigint("district_id").alias("district_id"),
        as_long(raw, "province_id").alias("province_id"),
        clean_text("region_shortname").alias("region_shortname"),
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        F.col("is_enabled").cast("boolean").alias("is_enabled"),
        F.col("is_virtual").cast("boolean").alias("is_virtual"),
        as_ts("created_time").alias("created_time"))


def stg_client(raw: DataFrame) -> DataFrame:
    return raw.select(
        as_long(raw, "client_id").alias("client_id"),
        as_long(raw, "shop_id").alias("shop_id"),
        clean_text("client_type").alias("client_type"),
        as_long(raw, "province_id").alias("province_id"),
        as_long(raw, "district_id").alias("district_id"),
        F.col("is_b2b").cast("boolean").alias("is_b2b"),
        F.col("created_date").cast("date").alias("created_date"),
        clean_text("tier").alias("tier"),
        F.col("_data_quality"))


def stg_shipper(raw: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Future hire dates (relative to ``as_of``, default today) become NULL
    and are flagged; plates are normalised."""
    today = F.current_date() if as_of is None else as_of
    hire = F.col("hire_date").cast("date")
    return raw.select(
        as_long(raw, "shipper_id").alias("shipper_id"),
        clean_text("user_id").alias("user_id"),
        as_long(raw, "warehouse_id").alias("warehouse_id"),
        as_long(raw, "province_id").alias("province_id"),
        F.when(hire > today, F.lit(None).cast("date")).otherwise(hire).alias("hire_date"),
        (hire > today).alias("has_future_hire_date"),
        F.col("is_active").cast("boolean").alias("is_active"),
        clean_text("performance_tier").alias("performance_tier"),
        normalize_plate("truck_plate_number").alias("truck_plate_number"),
        F.col("vehicle_weight_kg").cast("double").alias("vehicle_weight_kg"),
        F.col("_data_quality"))


# ---------------------------------------------------------------- facts

# Dedup order: newest created_date first (NULL last); the remaining keys only
# make ties deterministic.
def dedup_order() -> list[Column]:
    return [
        F.col("created_date").desc_nulls_last(),
        F.col("status").asc_nulls_last(),
        F.col("deliver_warehouse_id").asc_nulls_last(),
        F.col("cod_amount").asc_nulls_last(),
    ]


#: the columns that :func:`dedup_order` reads
DEDUP_COLUMNS = ["created_date", "status", "deliver_warehouse_id", "cod_amount"]


def newest_orders(raw: DataFrame, flag: str = QUARANTINE_FLAG) -> DataFrame | None:
    """Where the newest row of every repeated order code lies."""
    return first_places(keep_non_quarantine(raw, flag), "order_code", dedup_order(), DEDUP_COLUMNS)


def stg_shippingorder(raw: DataFrame, flag: str = QUARANTINE_FLAG, newest: DataFrame | None = None) -> DataFrame:
    """``newest``: :func:`newest_orders` of the same ``raw``; without it the
    rows are deduplicated by a window."""
    src = keep_first(keep_non_quarantine(raw, flag), "order_code", dedup_order(), newest)
    status = normalize_order_status("status")
    created, first_del = as_ts("created_date"), as_ts("first_delivered_time")
    return src.select(
        clean_text("order_code").alias("order_code"),
        as_long(src, "shop_id").alias("shop_id"),
        as_long(src, "client_id").alias("client_id"),
        as_long(src, "from_district_id").alias("from_district_id"),
        as_long(src, "to_district_id").alias("to_district_id"),
        clean_text("from_ward_code").alias("from_ward_code"),
        clean_text("to_ward_code").alias("to_ward_code"),
        as_long(src, "weight").alias("weight_gram"),
        as_long(src, "length").alias("length_cm"),
        as_long(src, "width").alias("width_cm"),
        as_long(src, "height").alias("height_cm"),
        as_long(src, "converted_weight").alias("converted_weight_gram"),
        as_long(src, "service_type_id").alias("service_type_id"),
        as_long(src, "service_id").alias("service_id"),
        as_long(src, "cod_amount").alias("cod_amount_vnd"),
        parse_timestamp("cod_collect_date").alias("cod_collect_at"),
        as_long(src, "insurance_value").alias("insurance_value_vnd"),
        as_long(src, "pick_station_id").alias("pick_station_id"),
        clean_text("content").alias("content"),
        clean_text("created_source").alias("created_source"),
        created.alias("created_at"),
        F.col("dt").cast("date").alias("dt"),
        F.col("date_id").cast("int").alias("date_id"),
        status.alias("status"),
        order_outcome_group(status).alias("outcome_group"),
        as_long(src, "pick_warehouse_id").alias("pick_warehouse_id"),
        as_long(src, "deliver_warehouse_id").alias("deliver_warehouse_id"),
        as_long(src, "current_warehouse_id").alias("current_warehouse_id"),
        to_bigint("return_warehouse_id").alias("return_warehouse_id"),
        clean_text("deliver_shift").alias("deliver_shift"),
        as_long(src, "pick_user").alias("pick_user_id"),
        as_long(src, "deliver_user").alias("deliver_user_id"),
        to_bigint("return_user").alias("return_user_id"),
        as_ts("end_pick_time").alias("end_pick_at"),
        first_del.alias("first_delivered_at"),
        as_ts("end_delivery_time").alias("end_delivery_at"),
        as_long(src, "cod_failed_amount").alias("cod_failed_amount_vnd"),
        F.col("is_b2b").cast("boolean").alias("is_b2b"),
        clean_text("type_order").alias("type_order"),
        clean_text("type_order_code").alias("type_order_code"),
        F.col("is_sla_breach").cast("boolean").alias("is_sla_breach"),
        clean_text("failure_reason").alias("failure_reason"),
        F.col("_data_quality"),
        hours_between(created, first_del).alias("delivery_hours"))


def stg_inside_history(raw: DataFrame, flag: str = QUARANTINE_FLAG) -> DataFrame:
    """Event log: no dedup (repeated package+action events are legitimate)."""
    src = keep_non_quarantine(raw, flag)
    return src.select(
        parse_date("dt").alias("dt"),
        as_ts("action_time").alias("action_at"),
        clean_text("action_category").alias("action_category"),
        clean_text("action_name").alias("action_name"),
        clean_text("package_code").alias("package_code"),
        clean_text("order_code").alias("order_code"),
        to_bigint("warehouse_id").alias("warehouse_id"),
        to_bigint("from_warehouse_id").alias("from_warehouse_id"),
        to_bigint("to_warehouse_id").alias("to_warehouse_id"),
        clean_text("trip_code").alias("trip_code"),
        F.col("trip_partner").cast("int").alias("trip_partner"),
        F.col("stop_code").cast("int").alias("stop_code"),
        clean_text("session_code").alias("session_code"),
        clean_text("user_id").alias("user_id"),
        clean_text("user_name").alias("user_name"),
        F.col("_data_quality"))


def stg_transportation(raw: DataFrame, flag: str = QUARANTINE_FLAG) -> DataFrame:
    src = keep_non_quarantine(raw, flag)
    dep, arr = as_ts("departure_time"), as_ts("arrival_time")
    return src.select(
        clean_text("trip_code").alias("trip_code"),
        to_bigint("from_warehouse_id").alias("from_warehouse_id"),
        to_bigint("to_warehouse_id").alias("to_warehouse_id"),
        dep.alias("departure_at"),
        arr.alias("arrival_at"),
        as_long(src, "driver_id").alias("driver_shipper_id"),
        normalize_plate("truck_plate_number").alias("truck_plate_number"),
        F.col("vehicle_weight_kg").cast("double").alias("vehicle_weight_kg"),
        as_long(src, "n_packages").alias("n_packages"),
        parse_date("dt").alias("dt"),
        F.col("_data_quality"),
        hours_between(dep, arr).alias("transit_hours"))


def stg_shipment(raw: DataFrame, flag: str = QUARANTINE_FLAG) -> DataFrame:
    src = keep_non_quarantine(raw, flag)
    return src.select(
        clean_text("trip_code").alias("trip_code"),
        clean_text("order_code").alias("order_code"),
        F.col("attempt_no").cast("int").alias("attempt_no"),
        as_long(src, "shipper_id").alias("shipper_id"),
        clean_text("shipper_user_id").alias("shipper_user_id"),
        to_bigint("deliver_warehouse_id").alias("deliver_warehouse_id"),
        clean_text("deliver_shift").alias("deliver_shift"),
        lower_trim("attempt_status").alias("attempt_status"),
        clean_text("attempt_result").alias("attempt_result"),
        clean_text("failure_reason").alias("failure_reason"),
        as_ts("deliver_time").alias("deliver_at"),
        parse_date("dt").alias("dt"),
        F.col("_data_quality"))


def stg_cod(raw: DataFrame, flag: str = QUARANTINE_FLAG) -> DataFrame:
    """Amounts rounded to whole VND; discrepancy = cod - collected (positive
    means a shortfall), as carried by the raw records."""
    src = keep_non_quarantine(raw, flag)
    disc = money("discrepancy_amount")
    return src.select(
        as_long(src, "cod_id").alias("cod_id"),
        clean_text("order_code").alias("order_code"),
        as_long(src, "warehouse_id").alias("warehouse_id"),
        money("cod_amount").alias("cod_amount_vnd"),
        money("collected_amount").alias("collected_amount_vnd"),
        disc.alias("discrepancy_amount_vnd"),
        lower_trim("cod_status").alias("cod_status"),
        lower_trim("reconcile_status").alias("reconcile_status"),
        as_ts("collect_time").alias("collect_at"),
        parse_date("dt").alias("dt"),
        F.col("_data_quality"),
        (disc != 0).alias("has_discrepancy"))


STAGING = {
    "stg_province": ("dim_province", stg_province),
    "stg_district": ("dim_district", stg_district),
    "stg_date": ("dim_date", stg_date),
    "stg_warehouse": ("dim_warehouse", stg_warehouse),
    "stg_client": ("dim_client", stg_client),
    "stg_shipper": ("dim_shipper", stg_shipper),
    "stg_shippingorder": ("data_shippingorder_now", stg_shippingorder),
    "stg_inside_history": ("data_inside_history", stg_inside_history),
    "stg_transportation": ("data_transportation", stg_transportation),
    "stg_shipment": ("data_shipment", stg_shipment),
    "stg_cod": ("data_cod", stg_cod),
}
