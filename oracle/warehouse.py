"""Staging, core and mart tables as SQL, stated from the warehouse's rules.

Staging tables are column lists with a cleaning rule per column; the SQL is
made from them. Core tables look attributes up by key (a key is unique, so a
scalar subquery gives the value or NULL). Marts are grouped straight from a
fact joined to its calendar day, with indicators summed as 0/1; percentiles
interpolate between elements of the sorted values, and shares are windows over
grouped counts. Column names are the tables' contract and fixed.
"""

from __future__ import annotations

AS_OF = "date '2001-06-30'"

#: cleaning rules: source expression -> SQL
RULES = {
    "long": lambda x: f"{x}::bigint",
    "int": lambda x: f"{x}::integer",
    "double": lambda x: f"{x}::double",
    "bool": lambda x: f"{x}::boolean",
    "date": lambda x: f"{x}::date",
    "time": lambda x: f"{x}::timestamp",
    "same": lambda x: x,
    # a number that may be missing, NaN or infinite
    "whole": lambda x: f"if(isfinite({x}), {x}, null)::bigint",
    "text": lambda x: f"nullif(trim({x}), '')",
    "word": lambda x: f"lower(trim({x}))",
    "money": lambda x: f"round({x})::bigint",
    "plate": lambda x: f"upper(regexp_replace(coalesce({x}, ''), '\\s', '', 'g'))",
    "maybe_date": lambda x: f"try_cast({x} as date)",
    "maybe_time": lambda x: f"try_cast({x} as timestamp)",
}

#: fixed values: spellings of an order's status, and the outcome of each status
STATUSES = {
    "delivered": "delivered done finish finished success",
    "return_to_sender": "return_to_sender returned return",
    "cancelled": "cancelled canceled cancel",
    "ready_to_pick": "ready_to_pick ready waiting_pickup",
    "picking": "picking picked pickup",
    "in_transit": "in_transit transit transporting",
    "delivering": "delivering delivery shipping",
}
OUTCOMES = {"delivered": "success", "return_to_sender": "return", "cancelled": "cancelled"}
#: fixed values: channels of client types
CHANNELS = {"SHOPEE": "marketplace", "LAZADA": "marketplace", "TIKI": "marketplace", "SENDO": "marketplace",
            "SME": "sme", "TTS": "tts"}


def columns(spec: str) -> str:
    """``out:rule`` or ``out=source:rule``, separated by white space -> select list."""
    out = []
    for item in spec.split():
        names, rule = item.split(":")
        name, _, source = names.partition("=")
        out.append(f'{RULES[rule](chr(34) + (source or name) + chr(34))} as {name}')
    return ",\n  ".join(out)


def _values(pairs: dict[str, str]) -> str:
    return ", ".join(f"('{a}', '{b}')" for a, b in pairs.items())


def _hours(start: str, end: str) -> str:
    return f"(epoch({end}) - epoch({start})) / 3600"


def _day_key(day: str) -> str:
    return f"(year({day}) * 10000 + month({day}) * 100 + day({day}))::integer"


SOUND = "_data_quality is distinct from 'heavy_issue'"

STAGING = {
    "stg_province": ("raw_dim_province", "province_id:long province_name:text region:text region_idx:int"),
    "stg_district": ("raw_dim_district", "district_id:long district_name:text province_id:long"),
    "stg_date": ("raw_dim_date", "date_id:int date_day=date:date year:int quarter:int month:int week_of_year:int "
                 "day_of_week:int day_of_week_vn:text is_weekend:bool is_holiday_vn:bool"),
    "stg_warehouse": ("raw_dim_warehouse", "warehouse_id:long warehouse_name:text warehouse_type:text district_id:whole "
                      "province_id:long region_shortname:text latitude:double longitude:double is_enabled:bool "
                      "is_virtual:bool created_time:time"),
    "stg_client": ("raw_dim_client", "client_id:long shop_id:long client_type:text province_id:long district_id:long "
                   "is_b2b:bool created_date:date tier:text _data_quality:same"),
    "stg_inside_history": (
        f"raw_data_inside_history where {SOUND}",
        "dt:maybe_date action_at=action_time:time action_category:text action_name:text package_code:text "
        "order_code:text warehouse_id:whole from_warehouse_id:whole to_warehouse_id:whole trip_code:text "
        "trip_partner:int stop_code:int session_code:text user_id:text user_name:text _data_quality:same"),
    "stg_shipment": (
        f"raw_data_shipment where {SOUND}",
        "trip_code:text order_code:text attempt_no:int shipper_id:long shipper_user_id:text deliver_warehouse_id:whole "
        "deliver_shift:text attempt_status:word attempt_result:text failure_reason:text deliver_at=deliver_time:time "
        "dt:maybe_date _data_quality:same"),
}

MODELS: dict[str, str] = {name: f"\nselect\n  {columns(spec)}\nfrom {source}" for name, (source, spec) in STAGING.items()}

_SHIPPER = columns("shipper_id:long user_id:text warehouse_id:long province_id:long is_active:bool performance_tier:text "
                   "truck_plate_number:plate vehicle_weight_kg:double _data_quality:same")
MODELS["stg_shipper"] = f"""
select {_SHIPPER},
  if(hire_date <= {AS_OF}, hire_date::date, null) as hire_date,
  hire_date > {AS_OF} as has_future_hire_date
from raw_dim_shipper"""

_ORDER = columns(
    "order_code:text shop_id:long client_id:long from_district_id:long to_district_id:long from_ward_code:text "
    "to_ward_code:text weight_gram=weight:long length_cm=length:long width_cm=width:long height_cm=height:long "
    "converted_weight_gram=converted_weight:long service_type_id:long service_id:long cod_amount_vnd=cod_amount:long "
    "cod_collect_at=cod_collect_date:maybe_time insurance_value_vnd=insurance_value:long pick_station_id:long "
    "content:text created_source:text created_at=created_date:time dt:date date_id:int pick_warehouse_id:long "
    "deliver_warehouse_id:long current_warehouse_id:long return_warehouse_id:whole deliver_shift:text "
    "pick_user_id=pick_user:long deliver_user_id=deliver_user:long return_user_id=return_user:whole "
    "end_pick_at=end_pick_time:time first_delivered_at=first_delivered_time:time end_delivery_at=end_delivery_time:time "
    "cod_failed_amount_vnd=cod_failed_amount:long is_b2b:bool type_order:text type_order_code:text is_sla_breach:bool "
    "failure_reason:text _data_quality:same")
_SPELLINGS = {word: status for status, words in STATUSES.items() for word in words.split()}
MODELS["stg_shippingorder"] = f"""
with newest as (
  select distinct on (order_code) * from raw_data_shippingorder_now where {SOUND}
  order by order_code, created_date desc nulls last, status nulls last, deliver_warehouse_id nulls last, cod_amount nulls last),
spelling(word, known) as (values {_values(_SPELLINGS)}),
ended(known, outcome) as (values {_values(OUTCOMES)}),
named as (
  select newest.* exclude (status), coalesce(known, lower(trim(status))) as status
  from newest left join spelling on word = lower(trim(status)))
select {_ORDER}, status, coalesce(outcome, 'in_progress') as outcome_group,
  {_hours('created_date', 'first_delivered_time')} as delivery_hours
from named left join ended on known = status"""

_TRIP = columns("trip_code:text from_warehouse_id:whole to_warehouse_id:whole departure_at=departure_time:time "
                "arrival_at=arrival_time:time driver_shipper_id=driver_id:long truck_plate_number:plate "
                "vehicle_weight_kg:double n_packages:long dt:maybe_date _data_quality:same")
MODELS["stg_transportation"] = f"""
select {_TRIP}, {_hours('departure_time', 'arrival_time')} as transit_hours
from raw_data_transportation where {SOUND}"""

_COD = columns("cod_id:long order_code:text warehouse_id:long cod_amount_vnd=cod_amount:money "
               "collected_amount_vnd=collected_amount:money discrepancy_amount_vnd=discrepancy_amount:money cod_status:word "
               "reconcile_status:word collect_at=collect_time:time dt:maybe_date _data_quality:same")
MODELS["stg_cod"] = f"""
select *, discrepancy_amount_vnd != 0 as has_discrepancy
from (select {_COD} from raw_data_cod where {SOUND})"""


# -- core: attributes by key --------------------------------------------------

def lookup(table: str, key: str, value: str, attribute: str) -> str:
    return f"(select any_value(l.{attribute}) from {table} l where l.{key} = {value})"


def _of_province(attribute: str) -> str:
    return f"{lookup('stg_province', 'province_id', 's.province_id', attribute)} as {attribute}"


def _of_hub(attribute: str, value: str, name: str) -> str:
    return f"{lookup('dim_warehouse', 'warehouse_id', value, attribute)} as {name}"


MODELS["dim_province"] = "select province_id, province_name, region, region_idx from stg_province"
MODELS["dim_district"] = f"select s.*, {_of_province('province_name')}, {_of_province('region')} from stg_district s"
MODELS["dim_date"] = "select *, (date_day - (isodow(date_day) - 1)::integer)::date as week_start from stg_date"
MODELS["dim_warehouse"] = f"select s.*, {_of_province('province_name')}, {_of_province('region')} from stg_warehouse s"
MODELS["dim_client"] = f"""
with channels(kind, channel) as (values {_values(CHANNELS)})
select s.* exclude (_data_quality), coalesce({lookup('channels', 'kind', 'upper(s.client_type)', 'channel')}, 'other') as client_channel,
  {_of_province('province_name')}, {_of_province('region')}
from stg_client s"""
MODELS["dim_shipper"] = f"""
select s.* exclude (_data_quality), {_of_hub('warehouse_name', 's.warehouse_id', 'warehouse_name')},
  {_of_hub('region', 's.warehouse_id', 'region')}, {_of_province('province_name')},
  ({AS_OF} - s.hire_date)::bigint as tenure_days
from stg_shipper s"""

MODELS["fct_shipping_order"] = f"""
select s.* exclude (from_ward_code, to_ward_code, length_cm, width_cm, height_cm, cod_collect_at, pick_station_id, content,
                    created_source, current_warehouse_id, type_order),
  {_of_hub('region', 's.deliver_warehouse_id', 'deliver_region')},
  {_of_hub('warehouse_type', 's.deliver_warehouse_id', 'deliver_warehouse_type')},
  s.cod_amount_vnd > 0 as is_cod, s.outcome_group = 'success' as is_delivered, s.outcome_group = 'return' as is_returned
from stg_shippingorder s"""
MODELS["fct_inside_history"] = f"""
select * exclude (trip_partner, stop_code, user_name), {_day_key('dt')} as date_id from stg_inside_history"""
MODELS["fct_transportation"] = f"""
select *, from_region = to_region as is_intra_region
from (select s.*, {_day_key('s.dt')} as date_id, {_of_hub('region', 's.from_warehouse_id', 'from_region')},
        {_of_hub('region', 's.to_warehouse_id', 'to_region')} from stg_transportation s)"""
MODELS["fct_shipment"] = f"""
select s.*, {_day_key('s.dt')} as date_id, {_of_hub('region', 's.deliver_warehouse_id', 'deliver_region')},
  s.attempt_status = 'success' as is_success, s.attempt_status = 'failed' as is_failed
from stg_shipment s"""
MODELS["fct_cod"] = f"""
select s.*, {_day_key('s.dt')} as date_id, {_of_hub('region', 's.warehouse_id', 'warehouse_region')},
  greatest(s.discrepancy_amount_vnd, -s.discrepancy_amount_vnd) as abs_discrepancy_vnd
from stg_cod s"""


# -- marts --------------------------------------------------------------------

def times(condition: str) -> str:
    """How often a condition holds."""
    return f"sum(if({condition}, 1, 0))::bigint"


def percent(part: str, whole: str) -> str:
    return f"round({part} * 100.0 / nullif({whole}, 0), 2)"


def between(sorted_values: str, q: float) -> str:
    """The q-quantile of a sorted list, linear between neighbours."""
    at = f"({q} * (len({sorted_values}) - 1))"
    low, high = f"{sorted_values}[floor({at})::bigint + 1]", f"{sorted_values}[ceil({at})::bigint + 1]"
    return f"{low} + ({high} - {low}) * ({at} - floor({at}))"


_ORDER_COUNTS = f"""count(*) as total_orders, {times('is_delivered')} as delivered_orders, {times('is_returned')} as returned_orders,
    {times('is_sla_breach')} as sla_breach_orders, sum(if(is_cod, cod_amount_vnd, 0))::bigint as cod_amount_vnd,
    round(avg(if(is_delivered, delivery_hours, null)), 2) as avg_delivery_hours"""
_ORDER_RATES = f"""{percent('delivered_orders', 'total_orders')} as success_rate_pct,
  {percent('returned_orders', 'total_orders')} as return_rate_pct, {percent('sla_breach_orders', 'total_orders')} as sla_breach_rate_pct"""

MODELS["mart_daily_kpi"] = f"""
with days as (
  select date_id, date_day, week_start, d.year, d.quarter, d.month, day_of_week_vn, is_weekend, is_holiday_vn,
    ifnull(deliver_region, 'unknown') as region, {_ORDER_COUNTS},
    {times("outcome_group = 'cancelled'")} as cancelled_orders, {times("outcome_group = 'in_progress'")} as in_progress_orders,
    {times('is_cod')} as cod_orders, sum(weight_gram)::bigint as total_weight_gram
  from fct_shipping_order join dim_date d using (date_id)
  group by all)
select *, {_ORDER_RATES} from days"""
MODELS["mart_hub_performance"] = f"""
with hubs as (
  select deliver_warehouse_id as warehouse_id, {_ORDER_COUNTS}, count(distinct deliver_user_id) as active_shippers
  from fct_shipping_order group by 1)
select hubs.*, w.warehouse_name, w.warehouse_type, w.region, w.region_shortname, w.province_name, {_ORDER_RATES},
  round(total_orders / nullif(active_shippers, 0), 1) as orders_per_shipper
from hubs natural join (select warehouse_id, warehouse_name, warehouse_type, region, region_shortname, province_name
                        from dim_warehouse) w"""
MODELS["mart_sla_breakdown"] = f"""
with groups as (
  select week_start, d.year, d.quarter, ifnull(deliver_region, 'unknown') as region, ifnull(type_order_code, 'unknown') as service_code,
    count(*) as delivered_orders, {times('is_sla_breach')} as sla_breach_orders, round(avg(delivery_hours), 2) as avg_delivery_hours,
    list(delivery_hours order by delivery_hours) filter (delivery_hours is not null) as hours
  from fct_shipping_order join dim_date d using (date_id)
  where outcome_group = 'success'
  group by all)
select * exclude (hours), {percent('sla_breach_orders', 'delivered_orders')} as sla_breach_rate_pct,
  round({between('hours', 0.5)}, 2) as p50_delivery_hours, round({between('hours', 0.9)}, 2) as p90_delivery_hours
from groups"""
MODELS["mart_failure_reasons"] = f"""
with reasons as (
  select deliver_region, failure_reason, count(*) as failed_attempts, count(distinct order_code) as affected_orders
  from fct_shipment where attempt_status = 'failed' and failure_reason is not null
  group by all)
select ifnull(deliver_region, 'unknown') as region, failure_reason, failed_attempts, affected_orders,
  if(deliver_region is null, null, {percent('failed_attempts', 'sum(failed_attempts) over (partition by deliver_region)')})
    as pct_of_region_failures
from reasons"""
MODELS["mart_cod_reconciliation"] = f"""
with weeks as (
  select week_start, d.year, d.quarter, ifnull(warehouse_region, 'unknown') as region, count(*) as cod_records,
    {times('has_discrepancy')} as discrepancy_records, sum(cod_amount_vnd)::bigint as total_cod_amount_vnd,
    sum(collected_amount_vnd)::bigint as total_collected_vnd, sum(discrepancy_amount_vnd)::bigint as net_discrepancy_vnd,
    sum(abs_discrepancy_vnd)::bigint as gross_discrepancy_vnd
  from fct_cod join dim_date d using (date_id)
  group by all)
select *, {percent('discrepancy_records', 'cod_records')} as discrepancy_rate_pct,
  {percent('total_collected_vnd', 'total_cod_amount_vnd')} as collection_rate_pct
from weeks"""
