"""Oracle SQL for the data-quality queries.

The list of checks (which column of which model gets which test) is the
shared specification; each check is restated here as its own SQL count.
"""

from __future__ import annotations

from oracle.models import CTES, with_ctes

CTES["seed_status_mapping"] = """
select * from (values ('delivered', 'Giao thành công', 'success', true),
                      ('return_to_sender', 'Hoàn người gửi', 'return', true),
                      ('cancelled', 'Đã huỷ', 'cancelled', true),
                      ('picking', 'Đang lấy hàng', 'in_progress', false),
                      ('delivering', 'Đang giao', 'in_progress', false))
  as t(status, status_label_vn, outcome_group, is_terminal)"""
CTES["seed_sla_threshold"] = """
select * from (values ('TC1', 'Tiêu chuẩn nội vùng', 48, 'intra_region'),
                      ('TC2', 'Tiêu chuẩn liên vùng', 72, 'inter_region'),
                      ('EXP', 'Hỏa tốc', 24, 'intra_region'),
                      ('ECO', 'Tiết kiệm', 96, 'inter_region'))
  as t(service_code, service_label_vn, sla_target_hours, region_scope)"""


def _rel(layer: str, model: str) -> str:
    return f"raw_{model}" if layer == "source" else model


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def check_count_sql(ch) -> str:
    m, c = _rel(ch.layer, ch.model), ch.column
    if ch.test == "not_null":
        return f"(select count(*) from {m} where {c} is null)"
    if ch.test == "unique":
        return f"(select count(*) from (select {c} from {m} where {c} is not null group by {c} having count(*) > 1))"
    if ch.test == "accepted_values":
        vals = ", ".join(_q(v) for v in ch.values)
        return f"(select count(*) from {m} where {c} is not null and {c} not in ({vals}))"
    if ch.test == "relationships":
        p = _rel(ch.layer, ch.to)
        return (f"(select count(*) from {m} where {c} is not null and {c} not in "
                f"(select {ch.field} from {p} where {ch.field} is not null))")
    raise ValueError(ch.test)


def checks_sql(checks, with_singular: bool, delivered_error_after: int) -> str:
    rows = []
    for i, ch in enumerate(checks):
        rows.append(f"select {i} as check_id, {_q(ch.layer)} as layer, {_q(ch.model)} as model, "
                    f"{_q(ch.column)} as column_name, {_q(ch.test)} as test, {_q(ch.severity)} as severity, "
                    f"{check_count_sql(ch)} as failures")
    body = "\nunion all\n".join(rows)
    sql = (f"select check_id, layer, model, column_name, test, cast(failures as bigint) as failures, "
           f"case when failures = 0 then 'PASS' when severity = 'warn' then 'WARN' else 'ERROR' end as status "
           f"from ({body})")
    if with_singular:
        n = len(checks)
        limit = delivered_error_after
        if isinstance(limit, float):
            limit = f"{limit}::double * (select count(*) from fct_shipping_order)"
        sql += f"""
union all
select {n}, 'singular', 'fct_cod', cast(null as varchar), 'assert_cod_discrepancy_math', f,
  case when f = 0 then 'PASS' else 'ERROR' end
from (select count(*) as f from fct_cod where cod_status <> 'adjustment'
      and abs(discrepancy_amount_vnd - (cod_amount_vnd - collected_amount_vnd)) > 1)
union all
select {n + 1}, 'singular', 'fct_shipping_order', cast(null as varchar), 'assert_delivered_no_failure_reason', f,
  case when f <= 0 then 'PASS' when f <= {limit} then 'WARN' else 'ERROR' end
from (select count(*) as f from fct_shipping_order where outcome_group = 'success' and failure_reason is not null)"""
    return with_ctes(sql)


def gate_sql(rules) -> str:
    least = lambda r: str(r.min_rows) if r.share is None else f"ceil({r.share}::double * (select count(*) from {r.of}))"
    parts = [f"select {_q(r.mart)} as mart, {_q(r.key)} as key_column, count(*) as rows, "
             f"count(*) filter (where {r.key} is null) as null_keys, cast({least(r)} as bigint) as min_rows "
             f"from {r.mart}" for r in rules]
    body = "\nunion all\n".join(parts)
    return with_ctes(f"select *, rows >= min_rows and null_keys = 0 as passed from ({body})")


RAW_NAMES = ["data_cod", "data_inside_history", "data_shipment", "data_shippingorder_now", "data_transportation",
             "dim_client", "dim_date", "dim_district", "dim_province", "dim_shipper", "dim_warehouse"]


def profile_sql(years: list[int]) -> str:
    yl = ", ".join(str(y) for y in years)
    p = []
    for t in sorted(RAW_NAMES):
        p.append(f"select 'row_count' as section, {_q(t)} as item, cast(count(*) as double) as value, "
                 f"cast(null as varchar) as verdict from raw_{t}")
    for t, k in [("data_shippingorder_now", "order_code"), ("dim_warehouse", "warehouse_id"),
                 ("dim_client", "client_id"), ("dim_shipper", "shipper_id")]:
        p.append(f"select 'key_unique', {_q(t + '.' + k)}, cast(count(*) - count(distinct {k}) as double), "
                 f"case when count(*) = count(distinct {k}) then 'PASS' else 'FAIL' end from raw_{t}")
    tr = "raw_data_transportation"
    p += [f"select 'trip_packages', 'avg', round(avg(n_packages), 6), "
          f"case when avg(n_packages) >= 5 then 'PASS' else 'FAIL' end from {tr}",
          f"select 'trip_packages', 'min', cast(min(n_packages) as double), null from {tr}",
          f"select 'trip_packages', 'max', cast(max(n_packages) as double), null from {tr}",
          f"select 'trip_packages', 'pct_single', round(count(*) filter (where n_packages = 1) * 100.0 / count(*), 6),"
          f" null from {tr}"]
    for t, prefix in [("data_transportation", "T"), ("data_shipment", "L")]:
        p.append(f"select 'trip_namespace', {_q(t + ' not ' + prefix + '%')}, "
                 f"cast(count(*) filter (where trip_code not like '{prefix}%') as double), "
                 f"case when count(*) filter (where trip_code not like '{prefix}%') = 0 then 'PASS' else 'FAIL' end "
                 f"from raw_{t}")
    p.append("select 'fk_orphans', 'orders.deliver_warehouse_id', cast(count(*) as double), "
             "case when count(*) = 0 then 'PASS' else 'FAIL' end from raw_data_shippingorder_now "
             "where deliver_warehouse_id is not null and deliver_warehouse_id not in "
             "(select warehouse_id from raw_dim_warehouse where warehouse_id is not null)")
    ok = f"case when year(min(created_date)) in ({yl}) and year(max(created_date)) in ({yl}) then 'PASS' else 'FAIL' end"
    p += [f"select 'date_range', 'min_year', cast(year(min(created_date)) as double), {ok} from raw_data_shippingorder_now",
          f"select 'date_range', 'max_year', cast(year(max(created_date)) as double), {ok} from raw_data_shippingorder_now"]
    for t, c in [("data_inside_history", "warehouse_id"), ("data_transportation", "vehicle_weight_kg")]:
        p.append(f"select 'null_rate', {_q(t + '.' + c)}, "
                 f"round(count(*) filter (where {c} is null) * 100.0 / count(*), 6), null from raw_{t}")
    return with_ctes("\nunion all\n".join(p))


def classify_sql(as_of: str) -> str:
    cls = lambda heavy, light: (f"case when coalesce({heavy}, false) then 'heavy_issue' "  # noqa: E731
                                f"when coalesce({light}, false) then 'light_issue' else 'clean' end")
    st = "lower(trim(o.status))"
    parts = {
        "data_shippingorder_now": (
            "(select *, order_code is not null and row_number() over (partition by order_code order by created_date nulls last, "
            "status nulls first, deliver_warehouse_id nulls first, cod_amount nulls first) > 1 as again "
            "from raw_data_shippingorder_now) o",
            cls(f"(o.failure_reason is null and {st} = 'return_to_sender') or o.end_delivery_time < o.created_date "
                f"or o.weight = 0 or o.cod_amount < 0 or o.again "
                f"or (o.deliver_warehouse_id is null and {st} = 'delivered')",
                f"o.pick_user is null or (o.deliver_user is null and {st} = 'in_transit') or o.weight > 30000 "
                f"or o.is_sla_breach is null or upper(trim(o.status)) in ('DONE', 'FINISH')"),
            "o._data_quality"),
        "data_inside_history": ("raw_data_inside_history",
                                cls("action_category is null", "warehouse_id is null or isnan(warehouse_id)"),
                                "_data_quality"),
        "data_transportation": ("raw_data_transportation",
                                cls("arrival_time < departure_time",
                                    "vehicle_weight_kg is null or from_warehouse_id = to_warehouse_id"),
                                "_data_quality"),
        "data_shipment": (
            "raw_data_shipment s left join (select trim(order_code) as oc, min(created_date) as created_at "
            "from raw_data_shippingorder_now group by 1) c on trim(s.order_code) = c.oc",
            cls("(lower(trim(s.attempt_status)) = 'failed' and s.failure_reason is null) "
                "or s.deliver_time < c.created_at",
                "s.deliver_warehouse_id is null or isnan(s.deliver_warehouse_id)"),
            "s._data_quality"),
        "data_cod": ("raw_data_cod", cls("cod_amount is null or collected_amount < 0",
                                         "collect_time is null or reconcile_status = 'manual_review'"),
                     "_data_quality"),
        "dim_client": ("raw_dim_client", cls("false", "client_type is null"), "_data_quality"),
        "dim_shipper": ("raw_dim_shipper",
                        cls(f"hire_date > date '{as_of}'",
                            "not coalesce(regexp_full_match(truck_plate_number, '[0-9]{2}[A-Z]-[0-9]{5}'), false) "
                            "or vehicle_weight_kg is null"),
                        "_data_quality"),
        "dim_warehouse": ("raw_dim_warehouse",
                          cls("false", "(latitude = 0 and longitude = 0) or warehouse_name <> trim(warehouse_name)"),
                          "cast(null as varchar)"),
    }
    sqls = [f"select {_q(t)} as table_name, carried, derived, count(*) as n from "
            f"(select {carried} as carried, {expr} as derived from {src}) group by all"
            for t, (src, expr, carried) in parts.items()]
    return with_ctes("\nunion all\n".join(sqls))


def build(fixture_checks, regions_gate, years, as_of: str, delivered_error_after: int) -> dict[str, str]:
    out = {
        "dq_checks": checks_sql(fixture_checks(None), True, delivered_error_after),
        "dq_not_null": checks_sql(fixture_checks("not_null"), False, 0),
        "dq_unique": checks_sql(fixture_checks("unique"), False, 0),
        "dq_accepted": checks_sql(fixture_checks("accepted_values"), False, 0),
        "dq_relationships": checks_sql(fixture_checks("relationships"), False, 0),
        "dq_cod_math": with_ctes(
            "select cod_id, cod_status, cod_amount_vnd, collected_amount_vnd, discrepancy_amount_vnd, "
            "(cod_amount_vnd - collected_amount_vnd) as expected_discrepancy from fct_cod "
            "where cod_status <> 'adjustment' and abs(discrepancy_amount_vnd - (cod_amount_vnd - collected_amount_vnd)) > 1"),
        "dq_delivered_reason": with_ctes(
            "select order_code, status, outcome_group, failure_reason, _data_quality from fct_shipping_order "
            "where outcome_group = 'success' and failure_reason is not null"),
        "dq_gate": gate_sql(regions_gate),
        "dq_profile": profile_sql(years),
        "quality_classify": classify_sql(as_of),
    }
    return out
