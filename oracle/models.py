"""The warehouse written a second time, as DuckDB SQL over the test tables.

Each entry of :data:`CTES` is one named subquery; :func:`with_ctes` puts
the ones a query needs (transitively) in front of it. The fixture rules
(test tables -> raw parcel tables) and the staging/core/mart models are
restated here independently of the Spark code, so the two engines only
agree when both implement the same semantics.
"""

from __future__ import annotations

import re

from oracle.warehouse import MODELS

N_WH = "(select count(*) from supplier)"
N_SH = "(select count(*) from customer)"
N_ORD = "(select count(*) from orders)"

REASONS = ["wrong_address", "not_home", "refused", "damaged", "other"]


def _pick(idx: str, values: list[str]) -> str:
    parts = " ".join(f"when {idx} = {i} then '{v}'" for i, v in enumerate(values))
    return f"(case {parts} end)"


def _code(key: str) -> str:
    return f"(' ORD' || lpad(cast({key} as varchar), 8, '0'))"


DAY_TEXTS = ["1999/1/2 3:04", "1999-01-02 03:04:05 ", " 1999 01 02", "1999-01/02", "1999-01-02Tjunk", "1999-01-02T03:04:05.25Z",
             "1999-01-02 abc", "1999-01-02 24:00:00"]


def _drifted(day: str, index: str) -> str:
    return f"""(case {index} when 1 then strftime({day}, '%Y/%m/%d') when 2 then strftime({day}, '%Y %m %d')
  when 3 then strftime({day}, '%Y\\%m\\%d') when 4 then strftime({day}, '%Y-%-m-%-d') || ' '
  when 5 then strftime({day}, '%Y-%m-%d') || ' abc' when 6 then strftime({day}, '%Y-%m/%d')
  when 7 then strftime({day}, '%Y-%m-%d %H:%M') else strftime({day}, '%Y-%m-%d') end)"""


CTES: dict[str, str] = {}

# ------------------------------------------------------------------ fixture

CTES["raw_dim_province"] = """
select cast(n_nationkey + 1 as bigint) as province_id,
       case when n_nationkey % 7 = 0 then '  ' || n_name || ' ' else n_name end as province_name,
       r_name as region, cast(n_regionkey as integer) as region_idx
from nation left join region on n_regionkey = r_regionkey"""

CTES["raw_dim_district"] = """
select cast(10001 + 4 * n_nationkey + i as bigint) as district_id,
       'District ' || cast(n_nationkey as varchar) || '-' || cast(i as varchar)
         || case when i = 3 then ' ' else '' end as district_name,
       cast(n_nationkey + 1 as bigint) as province_id, n_name as province_name
from (select n_nationkey, n_name, unnest(range(0, 4)) as i from nation)"""

CTES["raw_dim_date"] = """
select cast(strftime(d, '%Y%m%d') as integer) as date_id, d as date,
       cast(year(d) as integer) as year, cast(quarter(d) as integer) as quarter,
       cast(month(d) as integer) as month, cast(weekofyear(d) as integer) as week_of_year,
       cast(isodow(d) as integer) as day_of_week,
       case isodow(d) when 1 then 'Thứ 2' when 2 then 'Thứ 3' when 3 then 'Thứ 4' when 4 then 'Thứ 5'
                      when 5 then 'Thứ 6' when 6 then 'Thứ 7' else 'CN' end as day_of_week_vn,
       isodow(d) in (6, 7) as is_weekend,
       strftime(d, '%m-%d') in ('01-01', '04-30', '05-01', '09-02') as is_holiday_vn
from (select cast(unnest(generate_series(cast(lo as timestamp), cast(hi as timestamp), interval 1 day)) as date) as d
      from (select min(cast(o_orderdate as date)) as lo, max(cast(o_orderdate as date)) as hi from orders))"""

CTES["raw_dim_warehouse"] = """
select cast(s_suppkey + 2001 as bigint) as warehouse_id,
       case when s_suppkey % 20 = 0 then s_name || ' ' else s_name end as warehouse_name,
       case when s_suppkey < 8 then 'KTC' else 'BC' end as warehouse_type,
       case when s_suppkey % 25 = 0 then cast('nan' as double) else cast(10001 + 4 * s_nationkey as double) end
         as district_id,
       cast(s_nationkey + 1 as bigint) as province_id,
       case when s_suppkey % 3 = 0 then null else n_name end as province_name,
       substr(r_name, 1, 3) as region_shortname,
       case when s_suppkey % 4 = 0 then null else r_name end as region_fullname,
       case when s_suppkey % 33 = 0 then cast(0 as double) else 8.0::double + cast(s_suppkey % 15 as double) * 0.5::double end as latitude,
       case when s_suppkey % 33 = 0 then cast(0 as double) else 102.0::double + cast(s_suppkey % 13 as double) * 0.5::double end as longitude,
       s_suppkey % 17 <> 0 as is_enabled, s_suppkey % 23 = 0 as is_virtual,
       timestamp '2020-01-01 00:00:00' + to_hours(cast(s_suppkey as bigint)) as created_time
from supplier left join (select n_nationkey, n_name, r_name from nation left join region on n_regionkey = r_regionkey)
  on s_nationkey = n_nationkey"""

_TIER = ("case when c_acctbal < 0 then 'Bronze' when c_acctbal < 3000 then 'Silver' "
         "when c_acctbal < 7000 then 'Gold' else 'Diamond' end")

CTES["raw_client_base"] = f"""
select cast(c_custkey + 1 as bigint) as client_id, cast(c_custkey + 100001 as bigint) as shop_id,
       case c_mktsegment when 'AUTOMOBILE' then 'SHOPEE' when 'BUILDING' then 'SME' when 'FURNITURE' then ' TTS '
                         when 'HOUSEHOLD' then 'lazada' else null end as client_type,
       cast(c_nationkey + 1 as bigint) as province_id,
       cast(10001 + 4 * c_nationkey + c_custkey % 4 as bigint) as district_id,
       c_custkey % 20 < 3 as is_b2b,
       date '1994-01-01' + cast(c_custkey % 365 as integer) as created_date,
       case when c_custkey % 13 = 0 then {_TIER} || ' ' else {_TIER} end as tier,
       case when c_mktsegment = 'MACHINERY' then 'light_issue' else 'clean' end as _data_quality,
       c_custkey as _k
from customer"""

CTES["raw_dim_client"] = """
select * exclude (_k) from raw_client_base"""

CTES["raw_dim_client_changed"] = """
select * exclude (_k) from (
  select * replace (case when _k % 10 = 0 then 'Diamond' else tier end as tier) from raw_client_base where _k % 50 <> 1
  union all
  select * replace (client_id + 1000000 as client_id) from raw_client_base where _k % 100 = 2)"""

CTES["raw_dim_shipper"] = f"""
select cast(c_custkey + 1 as bigint) as shipper_id,
       'U' || lpad(cast(c_custkey + 1 as varchar), 6, '0') as user_id,
       cast(2001 + c_custkey % {N_WH} as bigint) as warehouse_id,
       cast(c_nationkey + 1 as bigint) as province_id,
       case when c_custkey % 500 = 0 then date '2999-01-01'
            else date '1994-01-01' + cast(c_custkey % 400 as integer) end as hire_date,
       c_custkey % 30 <> 0 as is_active,
       {_pick('c_custkey % 3', ['A', 'B', 'C'])} as performance_tier,
       case when c_custkey % 70 = 0 then null else ' 29h - ' || lpad(cast(c_custkey % 100000 as varchar), 5, '0') end
         as truck_plate_number,
       case when c_custkey % 90 = 0 then null else 500.0::double + cast(c_custkey % 4 as double) * 250.0::double end
         as vehicle_weight_kg,
       case when c_custkey % 500 = 0 then 'heavy_issue'
            when c_custkey % 70 = 0 or c_custkey % 90 = 0 then 'light_issue' else 'clean' end as _data_quality
from customer"""

_CREATED = "(o_orderdate + to_hours(cast(6 + k % 16 as bigint)) + to_minutes(cast(k % 60 as bigint)))"
_DELIVER_WH = f"(case when k % 151 = 0 then null else cast(2001 + (k * 13) % {N_WH} as bigint) end)"

CTES["raw_orders_base"] = f"""
select *,
  case when k % 1000 = 3 then cast(-50000 as bigint) when k % 5 < 3 then cast(floor(o_totalprice) as bigint)
       else cast(0 as bigint) end as _cod,
  case when k % 125 = 0 then cast(0 as bigint) when k % 2000 = 1 then cast(250000 as bigint)
       else cast(10 + (k * 37) % 30000 as bigint) end as _weight,
  cast(5 + k % 75 as bigint) as _len, cast(5 + k % 55 as bigint) as _wid, cast(2 + k % 48 as bigint) as _hei,
  {_CREATED} as _created
from (select *, o_orderkey as k from orders)"""

CTES["raw_orders_rows"] = f"""
select
  {_code('k')} as order_code,
  'Shop ' || cast(o_custkey as varchar) as from_name,
  '09' || lpad(cast((k * 7919) % 100000000 as varchar), 8, '0') as from_phone,
  'No. ' || cast(k % 300 as varchar) || ' Street' as from_address,
  case when k % 9 = 0 then '  ' else 'W' || cast(k % 50 as varchar) end as from_ward_code,
  '09' || lpad(cast((k * 104729) % 100000000 as varchar), 8, '0') as to_phone,
  'W' || cast((k * 3) % 50 as varchar) || ' ' as to_ward_code,
  {_pick('k % 4', ['clothes', ' shoes ', '', 'books'])} as content,
  case when k % 10 = 0 then 'call first' end as note,
  {_pick('k % 3', ['app', 'web ', 'api'])} as created_source,
  case when k % 300 = 1 then 'DONE' when k % 300 = 2 then ' Finish ' when k % 997 = 5 then ' LOST '
       when k % 25 < 18 then (case when k % 7 = 0 then 'Delivered' else 'delivered' end)
       when k % 25 = 18 then 'return_to_sender' when k % 25 = 19 then 'Returned'
       when k % 25 = 20 then 'canceled' when k % 25 = 21 then 'ready_to_pick'
       when k % 25 = 22 then 'picking' when k % 25 = 23 then 'in_transit' else 'delivering' end as status,
  {_pick('k % 3', [' morning', 'afternoon', 'evening '])} as deliver_shift,
  case when k % 2 = 0 then 'normal' else ' express' end as type_order,
  case when k % 71 = 0 then null else 'TC' || cast(1 + k % 9 as varchar) end as type_order_code,
  case when k % 25 in (18, 19) then (case when k % 13 = 0 then null else {_pick('k % 5', REASONS)} end)
       when k % 600 = 4 then ' not_home ' end as failure_reason,
  case when k % 7 = 0 then 'bad' when k % 70 < 8 then {_pick('k % 70', DAY_TEXTS)}
       when k % 5 < 3 then '1999-01-02 03:04:05' end as cod_collect_date,
  cast(o_custkey + 100001 as bigint) as shop_id,
  cast(o_custkey + 1 as bigint) as client_id,
  cast(10001 + k % 100 as bigint) as from_district_id,
  cast(10001 + (k * 7) % 100 as bigint) as to_district_id,
  _weight as weight, _len as length, _wid as width, _hei as height,
  greatest(_weight, (_len * _wid * _hei) // 6) as converted_weight,
  cast(case when k % 5 < 3 then 2 else 5 end as bigint) as service_type_id,
  cast(53320 + k % 3 as bigint) as service_id,
  _cod as cod_amount,
  case when k % 3 = 0 then cast(floor(o_totalprice) as bigint) else cast(0 as bigint) end as insurance_value,
  cast(100 + k % 20 as bigint) as pick_station_id,
  cast(2001 + (k * 7) % {N_WH} as bigint) as pick_warehouse_id,
  {_DELIVER_WH} as deliver_warehouse_id,
  cast(2001 + (k * 17) % {N_WH} as bigint) as current_warehouse_id,
  case when k % 211 = 0 then cast('nan' as double) else cast(2001 + (k * 19) % {N_WH} as double) end
    as return_warehouse_id,
  case when k % 83 = 0 then null else cast(1 + (k * 3) % {N_SH} as bigint) end as pick_user,
  case when k % 33 = 0 then null else cast(1 + k % {N_SH} as bigint) end as deliver_user,
  case when k % 25 in (18, 19) then cast(1 + (k * 5) % {N_SH} as double)
       when k % 301 = 0 then cast('nan' as double) end as return_user,
  case when k % 25 = 18 then _cod else cast(0 as bigint) end as cod_failed_amount,
  _created as created_date,
  _created + to_hours(cast(2 + k % 5 as bigint)) as end_pick_time,
  _created + to_hours(cast(13 + k % 77 as bigint)) as first_delivered_time,
  case when k % 333 = 0 then _created - to_hours(5)
       else _created + to_hours(cast(13 + k % 77 as bigint)) + to_hours(cast(k % 24 as bigint)) end
    as end_delivery_time,
  cast(_created as date) as dt,
  cast(strftime(cast(_created as date), '%Y%m%d') as integer) as date_id,
  k % 20 < 3 as is_b2b,
  case when k % 50 = 5 then null else k % 12 = 0 end as is_sla_breach,
  case when k % 97 = 0 then null when k % 40 = 0 then 'heavy_issue' when k % 11 = 0 then 'light_issue'
       else 'clean' end as _data_quality,
  k as _k
from raw_orders_base"""

CTES["raw_data_shippingorder_now"] = """
select * exclude (_k) from raw_orders_rows
union all
select * exclude (_k) replace (created_date + interval 1 hour as created_date, 'cancel' as status)
from raw_orders_rows where _k % 400 = 7
union all
select * exclude (_k) from raw_orders_rows where _k % 400 = 11"""

CTES["raw_data_inside_history"] = f"""
select
  case when e % 500 = 0 then 'bad-date' else {_drifted('ts', 'e % 100')} end as dt,
  ts as action_time,
  cat as action_category,
  case cat when 'receive' then 'receive_package' when 'pack' then 'pack_to_bag' when 'unpack' then 'unpack_bag'
           when 'export' then 'export_to_truck' when 'return_receive' then 'return_receive'
           when 'return_export' then 'return_export' end as action_name,
  'P' || lpad(cast(ok as varchar), 8, '0') as package_code,
  {_code('ok')} as order_code,
  wh as warehouse_id,
  from_w as from_warehouse_id,
  to_w as to_warehouse_id,
  case when cat = 'export' then 'T' || strftime(ts, '%Y%m') || '-' || cast(route_from as varchar)
       || '-' || cast(route_to as varchar) end as trip_code,
  cast(null as varchar) as trip_partner, cast(null as varchar) as stop_code,
  'S' || cast(user_id as varchar) as session_code,
  'U' || cast(user_id as varchar) as user_id,
  ' user ' || cast(user_id as varchar) as user_name,
  case when cat is null then 'heavy_issue' when wh is null or isnan(wh) then 'light_issue' else 'clean' end
    as _data_quality
from (
  select *,
    case when e % 20 = 0 then cast('nan' as double) when e % 19 = 0 then null
         when cat = 'receive' then to_w else from_w end as wh
  from (
    select event_id as e, case when event_id % 3 = 0 then date_trunc('hour', ts) else ts end as ts, user_id,
      (event_id * 3) % {N_ORD} as ok,
      2001 + event_id % {N_WH} as route_from,
      case when event_id % 89 = 0 then 999999 else 2001 + (event_id + 1 + (event_id // 7) % 3) % {N_WH} end as route_to,
      case when event_id % 97 = 0 then null when event_id % 37 = 0 then cast('nan' as double)
           else cast(2001 + event_id % {N_WH} as double) end as from_w,
      case when event_id % 41 = 0 then cast('nan' as double) when event_id % 43 = 0 then null
           when event_id % 13 = 0 then cast(2001 + event_id % 5 as double) when event_id % 89 = 0 then 999999.0::double
           else cast(2001 + (event_id + 1 + (event_id // 7) % 3) % {N_WH} as double) end as to_w,
      case event_type when 'view' then 'receive' when 'click' then 'pack' when 'purchase' then 'export'
                      when 'signup' then 'unpack' else null end as cat
    from events))"""

CTES["trip_exports"] = """
select *, from_warehouse_id is not null and not isnan(from_warehouse_id) as has_from,
  to_warehouse_id is not null and not isnan(to_warehouse_id) as has_to
from raw_data_inside_history
where action_category = 'export' and trip_code is not null and starts_with(trip_code, 'T')"""

_BY_TIME = "order by action_time, package_code"
CTES["raw_trips"] = f"""
select trip_code, min(action_time) as departure_time,
  coalesce(first(from_warehouse_id {_BY_TIME}, from_warehouse_id, to_warehouse_id) filter (where has_from and has_to),
           first(from_warehouse_id {_BY_TIME}, from_warehouse_id) filter (where has_from)) as from_warehouse_id,
  coalesce(first(to_warehouse_id {_BY_TIME}, from_warehouse_id, to_warehouse_id) filter (where has_from and has_to),
           first(to_warehouse_id {_BY_TIME}, to_warehouse_id) filter (where has_to)) as to_warehouse_id,
  count(*) as n_packages
from trip_exports group by trip_code"""

CTES["raw_data_transportation"] = f"""
select trip_code, from_warehouse_id, to_warehouse_id, departure_time, arr as arrival_time,
  cast(1 + n_packages % {N_SH} as bigint) as driver_id,
  ' 51c ' || lpad(cast(cast(from_warehouse_id as bigint) as varchar), 5, '0') as truck_plate_number,
  case when n_packages % 7 = 0 then null else 1500.0::double + cast(n_packages % 3 as double) * 500.0::double end
    as vehicle_weight_kg,
  n_packages,
  strftime(departure_time, '%Y-%m-%d') as dt,
  case when arr < departure_time then 'heavy_issue'
       when n_packages % 7 = 0 or from_warehouse_id = to_warehouse_id then 'light_issue' else 'clean' end
    as _data_quality
from (select *, case when day(departure_time) = 13 then departure_time - to_hours(1)
                     else departure_time + to_hours(cast(2 + n_packages % 18 as bigint)) end as arr
      from raw_trips)"""

CTES["raw_data_shipment"] = f"""
select
  'L' || cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as trip_code,
  {_code('l_orderkey')} as order_code,
  cast(l_linenumber as integer) as attempt_no,
  sid as shipper_id,
  'U' || lpad(cast(sid as varchar), 6, '0') as shipper_user_id,
  case when l_partkey % 130 = 0 then cast('nan' as double) else cast(2001 + l_suppkey % {N_WH} as double) end
    as deliver_warehouse_id,
  {_pick('l_linenumber % 3', [' morning', 'afternoon', 'evening '])} as deliver_shift,
  case when l_returnflag = 'R' then ' FAILED ' when l_returnflag = 'A' then 'success'
       when l_linestatus = 'O' then 'pending' else 'In_Progress' end as attempt_status,
  case when l_returnflag = 'R' then 'fail' when l_returnflag = 'A' then 'ok' end as attempt_result,
  reason as failure_reason,
  dtime as deliver_time,
  strftime(dtime, '%Y-%m-%d') as dt,
  case when l_returnflag = 'R' and reason is null then 'heavy_issue'
       when l_partkey % 130 = 0 then 'light_issue' else 'clean' end as _data_quality
from (select *, cast(1 + (l_orderkey + l_linenumber) % {N_SH} as bigint) as sid,
        case when l_returnflag = 'R' and l_partkey % 200 <> 0 then {_pick('l_partkey % 5', REASONS)} end as reason,
        l_shipdate + to_hours(cast(8 + l_partkey % 12 as bigint)) as dtime
      from lineitem)"""

CTES["raw_cod_clean"] = f"""
select cast(k + 1 as bigint) as cod_id, {_code('k')} as order_code, {_DELIVER_WH} as warehouse_id,
  cod as cod_amount, collected as collected_amount, st as cod_status,
  case when k % 400 = 10 then 'manual_review' when k % 20 in (15, 17) then 'discrepancy'
       when k % 20 = 16 then ' Pending ' else 'RECONCILED' end as reconcile_status,
  ct as collect_time,
  case when st = 'transferred' then ct + to_hours(cast(24 + k % 48 as bigint)) end as transfer_time,
  {_drifted('ct', 'k % 50')} as dt, 'clean' as _data_quality, k as _k,
  cod - collected + if(k % 500 = 10, 7.0::double, 0.0::double) as discrepancy_amount
from (select *, case when st in ('collected', 'transferred') then cod when st = 'failed' then 0.0::double
                     when st = 'pending' then 0.5::double * cod + 0.25::double end as collected
      from (select *, cast(floor(o_totalprice) as double) as cod,
              case when k % 20 in (15, 16) then 'failed' when k % 20 in (12, 17) then 'pending'
                   when k % 20 = 11 then 'transferred' else 'collected' end as st,
              {_CREATED} + to_hours(cast(k % 72 as bigint)) as ct
            from (select *, o_orderkey as k from orders where o_orderkey % 5 < 3)))"""

CTES["raw_cod_with_adj"] = """
select * from raw_cod_clean
union all
select * replace ((select max(cod_id) from raw_cod_clean) + row_number() over (order by cod_id) as cod_id, 'adjustment' as cod_status,
                  'pending' as reconcile_status, discrepancy_amount as collected_amount,
                  0.0::double as discrepancy_amount, collect_time + to_hours(24) as collect_time,
                  'clean' as _data_quality)
from raw_cod_clean where reconcile_status = 'discrepancy' and abs(discrepancy_amount) > 1000.0"""

CTES["raw_data_cod"] = """
select cod_id, order_code, warehouse_id,
  case when o and _k % 211 = 3 then null else cod_amount end as cod_amount,
  case when o and _k % 300 = 5 then -collected_amount else collected_amount end as collected_amount,
  discrepancy_amount,
  case when o and _k % 9 = 0 then ' ' || upper(cod_status) || ' ' else cod_status end as cod_status,
  reconcile_status,
  case when o and _k % 67 = 0 then null else collect_time end as collect_time,
  transfer_time,
  case when o and _k % 67 = 0 then null else dt end as dt,
  case when (o and _k % 211 = 3) or (o and _k % 300 = 5) then 'heavy_issue'
       when (o and _k % 67 = 0) or reconcile_status = 'manual_review' then 'light_issue'
       else _data_quality end as _data_quality
from (select *, cod_status <> 'adjustment' as o from raw_cod_with_adj)"""

CTES.update(MODELS)

_NAME = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


def _deps(sql: str) -> list[str]:
    return [n for n in dict.fromkeys(_NAME.findall(sql)) if n in CTES]


def with_ctes(body: str) -> str:
    """``WITH`` every CTE that ``body`` references, in dependency order."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str) -> None:
        if name in seen:
            return
        seen.add(name)
        for d in _deps(CTES[name]):
            if d != name:
                visit(d)
        order.append(name)

    for d in _deps(body):
        visit(d)
    if not order:
        return body
    ctes = ",\n".join(f"{n} as ({CTES[n]}\n)" for n in order)
    return f"with {ctes}\n{body}"


def model(name: str) -> str:
    return with_ctes(f"select * from {name}")

# ------------------------------------------------------------------ reports

_WEEKLY = """(select week_start, sum(total_orders) as total_orders, sum(delivered_orders) as delivered_orders,
  sum(sla_breach_orders) as sla_breach_orders, sum(cod_amount_vnd) as cod_amount_vnd
  from mart_daily_kpi group by week_start)"""

REPORT_SQL = {
    "rpt_kpi_weekly_summary": f"""
select week_start, cast(total_orders as bigint) as total_orders,
  round(delivered_orders * 100.0 / nullif(total_orders, 0), 2) as success_rate_pct,
  round(sla_breach_orders * 100.0 / nullif(total_orders, 0), 2) as sla_breach_rate_pct,
  cast(cod_amount_vnd as bigint) as cod_amount_vnd
from {_WEEKLY} order by week_start desc limit 52""",
    "rpt_weekly_volume": f"""
select week_start, cast(total_orders as bigint) as total_orders from {_WEEKLY} order by week_start""",
    "rpt_success_trend": f"""
select week_start, round(delivered_orders * 100.0 / nullif(total_orders, 0), 2) as success_rate_pct
from {_WEEKLY} order by week_start""",
    "rpt_hub_throughput": """
select warehouse_id, total_orders, success_rate_pct, avg_delivery_hours from mart_hub_performance
order by total_orders desc, warehouse_id limit 20""",
    "rpt_top_hubs": """
select warehouse_id, total_orders from mart_hub_performance order by total_orders desc, warehouse_id limit 10""",
    "rpt_sla_week_region": """
select week_start, year, quarter, region, service_code, sla_breach_rate_pct, delivered_orders
from mart_sla_breakdown
order by week_start desc, sla_breach_rate_pct desc nulls last, year, quarter, region, service_code limit 100""",
    "rpt_sla_by_region": """
select region, round(avg(sla_breach_rate_pct), 6) as avg_breach_rate, cast(sum(delivered_orders) as bigint) as total
from mart_sla_breakdown group by region order by avg_breach_rate desc nulls last, region""",
    "rpt_failure_distribution": """
select region, failure_reason, failed_attempts from mart_failure_reasons
order by failed_attempts desc, region, failure_reason limit 10""",
    "rpt_cod_by_region": """
select week_start, region, year, discrepancy_records, gross_discrepancy_vnd, net_discrepancy_vnd
from mart_cod_reconciliation order by year desc, abs(net_discrepancy_vnd) desc, week_start, region""",
    "rpt_hub_rank": """
select warehouse_id, region, total_orders, rank() over (partition by region order by total_orders desc) as hub_rank
from mart_hub_performance""",
    "card_sql_cod": """
select year, region, sum(discrepancy_records)::bigint as records_off, sum(net_discrepancy_vnd)::bigint as net_vnd,
  sum(gross_discrepancy_vnd)::bigint as gross_vnd,
  sum(gross_discrepancy_vnd)::double / nullif(sum(total_cod_amount_vnd), 0)::double as gross_share
from mart_cod_reconciliation group by year, region""",
}

# ------------------------------------------------------------------ operators

CTES["stg_client_changed"] = CTES["stg_client"].replace("raw_dim_client", "raw_dim_client_changed")
CTES["dim_client_changed"] = CTES["dim_client"].replace("stg_client", "stg_client_changed")

_PAY = "client_id, shop_id, client_type, client_channel, tier, is_b2b, region, province_name"
_T1, _T2 = "2000-01-01 06:00:00", "2000-07-01 06:00:00"
_SAME = ("(o.tier is not distinct from s.tier and o.client_channel is not distinct from s.client_channel "
         "and o.is_b2b is not distinct from s.is_b2b)")


def _open(src: str, ts: str) -> str:
    return (f"select {_PAY}, sha256(cast(client_id as varchar) || '|' || '{ts}') as scd_id, "
            f"timestamp '{ts}' as updated_at, timestamp '{ts}' as valid_from, "
            f"cast(null as timestamp) as valid_to from {src}")


CTES["scd_snap1"] = _open("dim_client", _T1)
CTES["scd_new2"] = f"""
select s.* from (select {_PAY} from dim_client_changed) s
left join (select * from scd_snap1 where valid_to is null) o on o.client_id = s.client_id
where o.client_id is null or not {_SAME}"""
CTES["scd_snap2"] = f"""
select * from scd_snap1 where valid_to is not null
union all
select o.* replace (case when s.client_id is not null and not {_SAME} then timestamp '{_T2}'
                         else o.valid_to end as valid_to)
from (select * from scd_snap1 where valid_to is null) o
left join (select {_PAY} from dim_client_changed) s on o.client_id = s.client_id
union all
{_open('scd_new2', _T2)}"""

CTES["cod_records"] = "select * from raw_data_cod where cod_status <> 'adjustment'"
CTES["trip_batch_rows"] = """
select from_warehouse_id, to_warehouse_id, route_day, action_time,
  (row_number() over (partition by from_warehouse_id, to_warehouse_id, route_day order by action_time, package_code) - 1) // 20
    as batch_no
from raw_data_inside_history
left join (select order_code, min(created_date)::date as route_day from raw_data_shippingorder_now group by 1) using (order_code)
where action_category = 'export'"""

OPS_SQL = {
    "export_week_range": """
select week_start, date_id, region, total_orders from mart_daily_kpi
where week_start between date '1997-01-06' and date '1997-03-31'""",
    "sla_by_states": "select * from mart_sla_breakdown",
    "hub_by_states": "select * from mart_hub_performance",
    "declared_read": """
select client_id, case when client_id % 5 <> 0 then shop_id end as shop_id, null::varchar as tier, 1 as note,
  'tier missing; shop_id type; note extra' as findings
from raw_dim_client""",
    "view_sql": """
select outcome_group, warehouse_type, count(*) as orders,
  count(*) filter (where end_delivery_at > first_delivered_at) as late
from stg_shippingorder left join stg_warehouse on deliver_warehouse_id = warehouse_id group by 1, 2""",
    "scd2_two_runs": "select * from scd_snap2",
    "asof_tier": """
select f.order_code, f.client_id, f.created_at, h.tier, h.client_channel
from (select order_code, client_id, created_at from fct_shipping_order) f
left join scd_snap2 h on f.client_id = h.client_id and h.valid_from <= f.created_at
  and (h.valid_to is null or f.created_at < h.valid_to)""",
    "asof_stream": """
select f.order_code, f.client_id, f.created_at, h.tier, h.client_channel
from (select order_code, client_id, created_at from fct_shipping_order) f
left join scd_snap2 h on f.client_id = h.client_id and h.valid_from <= f.created_at
  and (h.valid_to is null or f.created_at < h.valid_to)""",
    "quarantine_only": """
select order_code, status, _data_quality from raw_data_shippingorder_now where _data_quality = 'heavy_issue'""",
    "order_dedup": """
select order_code, created_date, status from (
  select *, row_number() over (partition by order_code order by created_date desc nulls last, status asc nulls last,
                               deliver_warehouse_id asc nulls last, cod_amount asc nulls last) as _rn
  from raw_data_shippingorder_now where _data_quality is null or _data_quality <> 'heavy_issue')
where _rn = 1""",
    "trip_rollup": "select * from raw_trips",
    "trip_batches": """
select from_warehouse_id, to_warehouse_id, route_day, cast(batch_no as bigint) as batch_no,
  count(*) as n_packages, min(action_time) as first_export_at, max(action_time) as last_export_at
from trip_batch_rows group by 1, 2, 3, 4""",
    "cod_adjustments": """

select (select max(cod_id) from cod_records) + row_number() over (order by cod_id) as cod_id, order_code,
  discrepancy_amount as collected_amount, 0.0::double as discrepancy_amount, 'pending' as reconcile_status,
  collect_time + interval 24 hour as collect_time
from cod_records where reconcile_status = 'discrepancy' and abs(discrepancy_amount) > 1000""",
    "running_minutes": """
select package_code, action_time, action_category, cast(minute(action_time) as bigint) as handling_min,
  count(*) over w as seq_no, cast(sum(cast(minute(action_time) as bigint)) over w as bigint) as cum_minutes
from raw_data_inside_history
window w as (partition by package_code order by action_time, action_category asc nulls first
             rows between unbounded preceding and current row)""",
    "volumetric_weight": """
select order_code, weight_gram, length_cm, width_cm, height_cm,
  greatest(weight_gram, (length_cm * width_cm * height_cm) // 6) as chargeable_weight_gram
from stg_shippingorder""",
    "action_name": """
select action_category, action_name, count(*) as n,
  case action_category when 'receive' then 'receive_package' when 'pack' then 'pack_to_bag'
       when 'unpack' then 'unpack_bag' when 'export' then 'export_to_truck' when 'return_receive' then 'return_receive'
       when 'return_export' then 'return_export' end as derived_name
from stg_inside_history group by 1, 2""",
    "backfill_region": """
select w.warehouse_id, w.province_id, coalesce(w.province_name, p.province_name) as province_name,
  coalesce(w.region_fullname, p.region) as region_fullname
from raw_dim_warehouse w left join stg_province p on w.province_id = p.province_id""",
    "collected_amount": """
select st as cod_status, count(*) as records,
  count(*) filter (where case st when 'pending' then collected_amount between 0 and cod_amount
                                 when 'failed' then collected_amount = 0 else collected_amount = cod_amount end) as rule_holds,
  count(*) filter (where collected_amount < 0) as negative_collected
from (select *, lower(trim(cod_status)) as st from raw_data_cod) where st <> 'adjustment' group by st""",
    "category_share": """
select table_name, _data_quality, n, round(n * 100.0 / sum(n) over (partition by table_name), 4) as pct
from (select table_name, _data_quality, count(*) as n from (
        select 'data_shippingorder_now' as table_name, _data_quality from raw_data_shippingorder_now
        union all select 'data_inside_history', _data_quality from raw_data_inside_history
        union all select 'data_transportation', _data_quality from raw_data_transportation
        union all select 'data_shipment', _data_quality from raw_data_shipment
        union all select 'data_cod', _data_quality from raw_data_cod) group by 1, 2)""",
    "status_share": """
select status, n, round(n * 100.0 / sum(n) over (), 4) as pct
from (select status, count(*) as n from raw_data_shippingorder_now group by 1)""",
    "shipper_pool": """
select warehouse_id, count(*) as n_shippers, array_to_string(list_sort(list(shipper_id)), ',') as shipper_ids
from dim_shipper where warehouse_id is not null group by 1""",
    "seed_lookup": """
select c.status, c.outcome_group, c.n_orders, s.status_label_vn, s.is_terminal,
  (s.seed_outcome = c.outcome_group) as outcome_agrees
from (select status, outcome_group, count(*) as n_orders from fct_shipping_order group by 1, 2) c
left join (select * from (values ('delivered', 'Giao thành công', 'success', true),
                                 ('return_to_sender', 'Hoàn người gửi', 'return', true),
                                 ('cancelled', 'Đã huỷ', 'cancelled', true),
                                 ('picking', 'Đang lấy hàng', 'in_progress', false),
                                 ('delivering', 'Đang giao', 'in_progress', false))
           as t(status, status_label_vn, seed_outcome, is_terminal)) s on c.status = s.status""",
    "roundtrip_parquet": "select * from mart_daily_kpi",
    "snapshot_on_disk": "select * from scd_snap2",
    "pruned_scan": "select cod_id, cod_amount, collect_time from raw_data_cod",
    "export_by_week": """
select week_start, count(*) as n_rows, sum(total_orders)::bigint as total_orders from mart_daily_kpi group by 1""",
    "event_nanos": """
select event_id, make_timestamp(epoch_us(ts) + (event_id * 7919) % 1000000) as at from events""",
    "large_ids": """
select o_orderkey, 9007199254740993 + o_orderkey as big_id, 9007199254740993 + o_orderkey as big_amount,
  o_totalprice::double::bigint as rounded
from orders""",
    "sample_k": "select * from dim_client order by md5(client_id::varchar || ':42'), client_id limit 100",
}
