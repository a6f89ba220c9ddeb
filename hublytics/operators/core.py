"""Core star schema: 6 dimensions and 5 facts.

Every join here is fact (or small dim) LEFT JOIN dimension on a single
key. Dimensions are bounded by the size of the network (provinces,
warehouses, days), so they are broadcast after a row-count check
(:mod:`hublytics.operators.joins`); the fact side is never shuffled for
them. Only the columns a join needs are projected before broadcasting.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hublytics.functions.semantics import client_channel, date_key, tenure_days, week_start
from hublytics.operators.joins import BroadcastPolicy

Hint = Callable[[str, DataFrame], DataFrame]


def _hint(hint: Hint | None) -> Hint:
    return hint if hint is not None else BroadcastPolicy()


# ---------------------------------------------------------------- dimensions

def dim_province(stg_province: DataFrame) -> DataFrame:
    return stg_province.select("province_id", "province_name", "region", "region_idx")


def dim_district(stg_district: DataFrame, stg_province: DataFrame, hint: Hint | None = None) -> DataFrame:
    p = _hint(hint)("stg_province", stg_province.select("province_id", "province_name", "region"))
    d = stg_district
    return (d.join(p, d.province_id == p.province_id, "left")
            .select(d.district_id, d.district_name, d.province_id, p.province_name, p.region))


def dim_date(stg_date: DataFrame) -> DataFrame:
    return stg_date.select(
        "date_id", "date_day", week_start("date_day").alias("week_start"), "year", "quarter",
        "month", "week_of_year", "day_of_week", "day_of_week_vn", "is_weekend", "is_holiday_vn")


def dim_warehouse(stg_warehouse: DataFrame, stg_province: DataFrame, hint: Hint | None = None) -> DataFrame:
    p = _hint(hint)("stg_province", stg_province.select("province_id", "province_name", "region"))
    w = stg_warehouse
    return (w.join(p, w.province_id == p.province_id, "left")
            .select(w.warehouse_id, w.warehouse_name, w.warehouse_type, w.district_id, w.province_id,
                    p.province_name, p.region, w.region_shortname, w.latitude, w.longitude,
                    w.is_enabled, w.is_virtual, w.created_time))


def dim_client(stg_client: DataFrame, stg_province: DataFrame, hint: Hint | None = None) -> DataFrame:
    p = _hint(hint)("stg_province", stg_province.select("province_id", "province_name", "region"))
    c = stg_client
    return (c.join(p, c.province_id == p.province_id, "left")
            .select(c.client_id, c.shop_id, c.client_type, client_channel(c.client_type).alias("client_channel"),
                    c.province_id, p.province_name, p.region, c.district_id, c.is_b2b, c.created_date, c.tier))


def dim_shipper(stg_shipper: DataFrame, dim_wh: DataFrame, stg_province: DataFrame,
                as_of: Column | None = None, hint: Hint | None = None) -> DataFrame:
    """Shipper with its warehouse's name and region (region comes from the
    warehouse, province name from the shipper's own province)."""
    h = _hint(hint)
    w = h("dim_warehouse", dim_wh.select(F.col("warehouse_id").alias("w_id"), "warehouse_name", "region"))
    p = h("stg_province", stg_province.select(F.col("province_id").alias("p_id"),
                                                F.col("province_name").alias("p_name")))
    s = stg_shipper
    return (s.join(w, F.col("warehouse_id") == F.col("w_id"), "left")
            .join(p, F.col("province_id") == F.col("p_id"), "left")
            .select("shipper_id", "user_id", "warehouse_id", "warehouse_name", "region", "province_id",
                    F.col("p_name").alias("province_name"), "hire_date", "has_future_hire_date",
                    tenure_days(F.col("hire_date"), as_of).alias("tenure_days"),
                    "is_active", "performance_tier", "truck_plate_number", "vehicle_weight_kg"))


# ---------------------------------------------------------------- facts

def _wh_region(dim_wh: DataFrame, hint: Hint | None, *extra: str) -> DataFrame:
    return _hint(hint)("dim_warehouse", dim_wh.select("warehouse_id", "region", *extra))


def fct_shipping_order(stg_order: DataFrame, dim_wh: DataFrame, hint: Hint | None = None) -> DataFrame:
    wh = _wh_region(dim_wh, hint, "warehouse_type")
    o = stg_order
    return (o.join(wh, o.deliver_warehouse_id == wh.warehouse_id, "left")
            .select(
                o.order_code, o.client_id, o.shop_id, o.date_id, o.dt, o.created_at,
                o.deliver_warehouse_id, wh.region.alias("deliver_region"),
                wh.warehouse_type.alias("deliver_warehouse_type"),
                o.pick_warehouse_id, o.return_warehouse_id, o.from_district_id, o.to_district_id,
                o.pick_user_id, o.deliver_user_id, o.return_user_id, o.deliver_shift,
                o.service_type_id, o.service_id, o.type_order_code, o.weight_gram, o.converted_weight_gram,
                o.cod_amount_vnd, o.cod_failed_amount_vnd, o.insurance_value_vnd,
                (o.cod_amount_vnd > 0).alias("is_cod"),
                o.status, o.outcome_group,
                (o.outcome_group == "success").alias("is_delivered"),
                (o.outcome_group == "return").alias("is_returned"),
                o.is_sla_breach, o.failure_reason, o.is_b2b,
                o.end_pick_at, o.first_delivered_at, o.end_delivery_at, o.delivery_hours,
                o._data_quality))


def fct_inside_history(stg_history: DataFrame) -> DataFrame:
    """Largest fact: a narrow projection, no join, no shuffle."""
    h = stg_history
    return h.select("package_code", "order_code", "dt", date_key("dt").alias("date_id"), "action_at",
                    "action_category", "action_name", "warehouse_id", "from_warehouse_id",
                    "to_warehouse_id", "trip_code", "session_code", "user_id", "_data_quality")


def fct_transportation(stg_trip: DataFrame, dim_wh: DataFrame, hint: Hint | None = None) -> DataFrame:
    """Trip with the region of both ends. The same broadcast lookup serves
    both joins (two aliases of one plan, so the exchange is reused)."""
    wh = _wh_region(dim_wh, hint)
    wf, wt = wh.alias("wf"), wh.alias("wt")
    t = stg_trip.alias("t")
    return (t.join(wf, F.col("t.from_warehouse_id") == F.col("wf.warehouse_id"), "left")
            .join(wt, F.col("t.to_warehouse_id") == F.col("wt.warehouse_id"), "left")
            .select("t.trip_code", "t.dt", date_key(F.col("t.dt")).alias("date_id"), "t.from_warehouse_id",
                    F.col("wf.region").alias("from_region"), "t.to_warehouse_id", F.col("wt.region").alias("to_region"),
                    (F.col("wf.region") == F.col("wt.region")).alias("is_intra_region"),
                    "t.driver_shipper_id", "t.truck_plate_number", "t.vehicle_weight_kg", "t.n_packages",
                    "t.departure_at", "t.arrival_at", "t.transit_hours", "t._data_quality"))


def fct_shipment(stg_attempt: DataFrame, dim_wh: DataFrame, hint: Hint | None = None) -> DataFrame:
    wh = _wh_region(dim_wh, hint)
    s = stg_attempt
    return (s.join(wh, s.deliver_warehouse_id == wh.warehouse_id, "left")
            .select(s.trip_code, s.order_code, s.attempt_no, s.dt, date_key(s.dt).alias("date_id"),
                    s.shipper_id, s.shipper_user_id, s.deliver_warehouse_id, wh.region.alias("deliver_region"),
                    s.deliver_shift, s.attempt_status, s.attempt_result,
                    (s.attempt_status == "success").alias("is_success"),
                    (s.attempt_status == "failed").alias("is_failed"),
                    s.failure_reason, s.deliver_at, s._data_quality))


def fct_cod(stg_cod: DataFrame, dim_wh: DataFrame, hint: Hint | None = None) -> DataFrame:
    wh = _wh_region(dim_wh, hint)
    c = stg_cod
    return (c.join(wh, c.warehouse_id == wh.warehouse_id, "left")
            .select(c.cod_id, c.order_code, c.warehouse_id, wh.region.alias("warehouse_region"), c.dt,
                    date_key(c.dt).alias("date_id"), c.cod_amount_vnd, c.collected_amount_vnd,
                    c.discrepancy_amount_vnd, F.abs(c.discrepancy_amount_vnd).alias("abs_discrepancy_vnd"),
                    c.has_discrepancy, c.cod_status, c.reconcile_status, c.collect_at, c._data_quality))
