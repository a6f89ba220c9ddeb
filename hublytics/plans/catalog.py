"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query starts from the test tables in ``sf_dir``, derives the raw
parcel tables with Spark (:mod:`hublytics.sources.fixtures`) and runs the
warehouse models and operators on top, so its work grows with the inputs.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hublytics.functions.semantics import action_name, lower_trim, money, round_like, to_bigint, volumetric_weight
from hublytics.operators import core, derive, history, partials, quality, reports, staging
from hublytics.operators.joins import bounded_broadcast
from hublytics.plans import pipeline, views
from hublytics.plans.warehouse import Warehouse
from hublytics.session import checkpoint_dir, wide_rows
from hublytics.sources.fixtures import Fixture
from hublytics.sources.raw import drift, nanos_to_timestamp, read_raw, read_seed
from hublytics.sources.sinks import publish_table, read_history, read_open, read_table, write_table, write_version

# Fixed "today" for models that depend on the run date (tenure, future
# hire dates), so results are repeatable: the last calendar day.
AS_OF = "2001-06-30"

_CACHE: dict[tuple[str, str], tuple[Fixture, Warehouse]] = {}


class MaterializedRaw(dict):
    """Raw tables derived from the test tables, each written once (on first
    use) to the shared checkpoint folder and read back: later plans start at
    parquet scans (with pushdown and pruning) instead of re-deriving the
    fixture, and a lost executor only recomputes from the written files.
    Only the tables a query touches are ever derived."""

    def __init__(self, spark: SparkSession, fx: Fixture):
        super().__init__()
        self.spark, self.fx = spark, fx
        self.root = os.path.join(checkpoint_dir(spark), f"raw-{uuid.uuid4().hex}")
        self.builders = {
            "dim_province": fx.dim_province, "dim_district": fx.dim_district, "dim_date": fx.dim_date,
            "dim_warehouse": fx.dim_warehouse, "dim_client": fx.dim_client, "dim_shipper": fx.dim_shipper,
            "data_shippingorder_now": fx.data_shippingorder_now, "data_inside_history": fx.data_inside_history,
            "data_transportation": fx.data_transportation, "data_shipment": fx.data_shipment,
            "data_cod": fx.data_cod,
        }

    def __missing__(self, name: str) -> DataFrame:
        if name not in self.builders:
            raise KeyError(name)
        with wide_rows(self.spark):
            write_table(self.builders[name](), f"{self.root}/{name}.parquet")
        df = read_raw(self.spark, self.root, name)
        self[name] = df
        return df

    def __contains__(self, name) -> bool:
        return name in self.builders

    def keys(self):
        return self.builders.keys()

    def __iter__(self):
        return iter(self.builders)

    def __len__(self) -> int:
        return len(self.builders)

    def items(self):
        return [(n, self[n]) for n in self.builders]


def warehouse_for(spark: SparkSession, sf_dir: str) -> tuple[Fixture, Warehouse]:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CACHE:
        fx = Fixture(spark, sf_dir)
        _CACHE[key] = (fx, Warehouse(MaterializedRaw(spark, fx), as_of=AS_OF))
    return _CACHE[key]


_BUILT: dict[tuple[str, str], Warehouse] = {}


def built_for(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse as a daily run leaves it: the deduplicated orders, every
    core table and mart written once (to the checkpoint folder) and read
    back, so that checks scan tables and never repeat the work behind them."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        wh = Warehouse(warehouse_for(spark, sf_dir)[1].raw, as_of=AS_OF, ordered_marts=False)
        out = f"{checkpoint_dir(spark).rstrip('/')}/built-{uuid.uuid4().hex}"
        with wide_rows(spark):
            publish_table(wh["stg_shippingorder"], f"{out}/stg_shippingorder")
            wh.replace("stg_shippingorder", read_table(spark, f"{out}/stg_shippingorder"))
            pipeline.build(spark, wh, out)
        _BUILT[key] = wh
    return _BUILT[key]


def _model(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return warehouse_for(spark, sf_dir)[1][name]
    run.__name__ = name
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: _model(name) for name in Warehouse.MODELS
}


def _report(name: str) -> Callable[[SparkSession, str], DataFrame]:
    mart, fn = reports.REPORTS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(warehouse_for(spark, sf_dir)[1][mart])
    run.__name__ = name
    return run


QUERIES.update({name: _report(name) for name in reports.REPORTS})


# ---------------------------------------------------------------- operators


SCD_KEY = "client_id"
SCD_CHECK = ["tier", "client_channel", "is_b2b"]
SCD_PAYLOAD = ["client_id", "shop_id", "client_type", "client_channel", "tier", "is_b2b", "region",
               "province_name"]
SCD_RUNS = ["2000-01-01 06:00:00", "2000-07-01 06:00:00"]
TRIP_CAPACITY = 20
SAMPLE_N, SAMPLE_SEED = 100, 42


def _wh(spark, sf_dir) -> Warehouse:
    return warehouse_for(spark, sf_dir)[1]


def _fx(spark, sf_dir) -> Fixture:
    return warehouse_for(spark, sf_dir)[0]


def q_scd2_two_runs(spark, sf_dir):
    fx, wh = warehouse_for(spark, sf_dir)
    day1 = wh["dim_client"].select(*SCD_PAYLOAD)
    day2 = core.dim_client(staging.stg_client(fx.dim_client_changed()), wh["stg_province"], wh.hint) \
        .select(*SCD_PAYLOAD)
    snap1 = history.snapshot(day1, SCD_KEY, SCD_CHECK, SCD_RUNS[0])
    return history.snapshot(day2, SCD_KEY, SCD_CHECK, SCD_RUNS[1], prev=snap1)


def q_asof_tier(spark, sf_dir):
    facts = _wh(spark, sf_dir)["fct_shipping_order"].select("order_code", "client_id", "created_at")
    return history.as_of_join(facts, q_scd2_two_runs(spark, sf_dir), SCD_KEY, "created_at",
                              ["tier", "client_channel"])


def q_asof_stream(spark, sf_dir):
    """As ``asof_tier``, by merging orders and versions into one stream."""
    facts = _wh(spark, sf_dir)["fct_shipping_order"].select("order_code", "client_id", "created_at")
    return history.as_of_join(facts, q_scd2_two_runs(spark, sf_dir), SCD_KEY, "created_at",
                              ["tier", "client_channel"], max_broadcast_bytes=0)


def q_quarantine_only(spark, sf_dir):
    raw = _wh(spark, sf_dir).raw["data_shippingorder_now"]
    return staging.only_quarantine(raw).select("order_code", "status", "_data_quality")


def q_order_dedup(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    raw = staging.keep_non_quarantine(wh.raw["data_shippingorder_now"])
    return staging.keep_first(raw, "order_code", staging.dedup_order(), wh.newest_orders()) \
        .select("order_code", "created_date", "status")


def q_trip_rollup(spark, sf_dir):
    return derive.trip_rollup(_wh(spark, sf_dir).raw["data_inside_history"])


def q_trip_batches(spark, sf_dir):
    raw = _wh(spark, sf_dir).raw
    return derive.trip_batches(raw["data_inside_history"], raw["data_shippingorder_now"].select("order_code", "created_date"),
                               TRIP_CAPACITY)


def q_cod_adjustments(spark, sf_dir):
    records = _wh(spark, sf_dir).raw["data_cod"].filter(F.col("cod_status") != "adjustment")
    return (derive.cod_adjustments(records).filter(F.col("cod_status") == "adjustment")
            .select("cod_id", "order_code", "collected_amount", "discrepancy_amount", "reconcile_status",
                    "collect_time"))


def q_running_minutes(spark, sf_dir):
    return derive.running_minutes(_wh(spark, sf_dir).raw["data_inside_history"])


def q_volumetric_weight(spark, sf_dir):
    o = _wh(spark, sf_dir)["stg_shippingorder"]
    return o.select("order_code", "weight_gram", "length_cm", "width_cm", "height_cm",
                    volumetric_weight("weight_gram", "length_cm", "width_cm", "height_cm")
                    .alias("chargeable_weight_gram"))


def q_action_name(spark, sf_dir):
    h = _wh(spark, sf_dir)["stg_inside_history"]
    return (h.groupBy("action_category", "action_name")
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("derived_name", action_name("action_category")))


def q_backfill_region(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    raw = wh.raw["dim_warehouse"].select("warehouse_id", "province_id", "province_name", "region_fullname")
    p = wh["stg_province"].select("province_id", "province_name", F.col("region").alias("region_fullname"))
    return derive.backfill_from_lookup(raw, bounded_broadcast(p), "province_id",
                                       {"province_name": "province_name", "region_fullname": "region_fullname"})


def q_collected_amount(spark, sf_dir):
    c = _wh(spark, sf_dir).raw["data_cod"]
    st = lower_trim("cod_status")
    c = c.filter(st != "adjustment").withColumn("st", st)
    expected = derive.collected_amount(F.col("st"), F.col("cod_amount"), F.lit(None).cast("double"))
    # what a pending record has collected is free between nothing and all of it
    holds = F.when(F.col("st") == "pending", F.col("collected_amount").between(0, F.col("cod_amount"))) \
        .otherwise(F.col("collected_amount") == expected)
    return c.groupBy("st").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(holds).alias("rule_holds"),
        F.count_if(F.col("collected_amount") < 0).alias("negative_collected")).withColumnRenamed("st", "cod_status")


def share(df: DataFrame, col: str, by: list[str] | None = None, digits: int = 4) -> DataFrame:
    """Count per category (NULL kept) and its percentage of the total of its
    partition. The window runs over the aggregated counts only."""
    by = by or []
    counts = df.groupBy(*by, col).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*by)) if by else F.sum("n").over(Window.partitionBy())
    return counts.withColumn("pct", round_like(F.col("n") * 100.0 / total, digits))


def q_category_share(spark, sf_dir):
    raw = _wh(spark, sf_dir).raw
    parts = [raw[t].select(F.lit(t).alias("table_name"), "_data_quality")
             for t in ["data_shippingorder_now", "data_inside_history", "data_transportation", "data_shipment",
                       "data_cod"]]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return share(u, "_data_quality", ["table_name"])


def q_status_share(spark, sf_dir):
    return share(_wh(spark, sf_dir).raw["data_shippingorder_now"], "status")


def q_shipper_pool(spark, sf_dir):
    # shippers without a hub are in nobody's pool
    s = _wh(spark, sf_dir)["dim_shipper"].filter("warehouse_id is not null")
    return s.groupBy("warehouse_id").agg(
        F.count(F.lit(1)).alias("n_shippers"),
        F.array_join(F.sort_array(F.collect_list("shipper_id")).cast("array<string>"), ",").alias("shipper_ids"))


def q_sample_k(spark, sf_dir):
    """Seeded sample of exactly SAMPLE_N clients: the SAMPLE_N smallest
    digests of key and seed (a per-partition top-k, then a merge)."""
    c = _wh(spark, sf_dir)["dim_client"]
    return c.orderBy(F.md5(F.concat_ws(":", "client_id", F.lit(SAMPLE_SEED)).cast("binary")), "client_id").limit(SAMPLE_N)


def q_seed_lookup(spark, sf_dir):
    fct = _wh(spark, sf_dir)["fct_shipping_order"]
    counts = fct.groupBy("status", "outcome_group").agg(F.count(F.lit(1)).alias("n_orders"))
    seed = bounded_broadcast(read_seed(spark, "seed_status_mapping")
                             .select("status", "status_label_vn", F.col("outcome_group").alias("seed_outcome"),
                                     "is_terminal"))
    j = counts.join(seed, "status", "left")
    return j.select("status", "outcome_group", "n_orders", "status_label_vn", "is_terminal",
                    (F.col("seed_outcome") == F.col("outcome_group")).alias("outcome_agrees"))


def q_roundtrip_parquet(spark, sf_dir):
    """The KPI mart published twice as snappy parquet in the shared checkpoint
    folder, first a part of it, and its newest version read back."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/roundtrip-{uuid.uuid4().hex}"
    kpi = _wh(spark, sf_dir)["mart_daily_kpi"]
    publish_table(kpi.filter("region is null"), path)
    publish_table(kpi, path)
    return read_table(spark, path)


def q_snapshot_on_disk(spark, sf_dir):
    """Two snapshot runs written as versions of changes, then a third on the same
    rows that changes nothing; the whole history read back."""
    fx, wh = warehouse_for(spark, sf_dir)
    base = f"{checkpoint_dir(spark).rstrip('/')}/snap-{uuid.uuid4().hex}"
    day1 = wh["dim_client"].select(*SCD_PAYLOAD)
    day2 = core.dim_client(staging.stg_client(fx.dim_client_changed()), wh["stg_province"], wh.hint) \
        .select(*SCD_PAYLOAD)
    for version, (day, at) in enumerate(zip([day1, day2, day2], [*SCD_RUNS, "2000-08-01 06:00:00"], strict=True), start=1):
        write_version(spark, history.changes(day, SCD_KEY, SCD_CHECK, at, read_open(spark, base)), base, version)
    return read_history(spark, base)


def q_pruned_scan(spark, sf_dir):
    """Three of the COD table's columns, scanned alone."""
    raw = _wh(spark, sf_dir).raw
    raw["data_cod"]  # written on first use
    return read_raw(spark, raw.root, "data_cod", columns=["cod_id", "cod_amount", "collect_time"])


def q_declared_read(spark, sf_dir):
    """A client file that lacks a column, has another too many and one as text,
    read as declared, with the table's findings."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/drifted-{uuid.uuid4().hex}"
    clients = _wh(spark, sf_dir).raw["dim_client"]
    text = F.when(F.col("client_id") % 5 == 0, F.lit("n/a")).otherwise(F.col("shop_id").cast("string"))
    write_table(clients.drop("tier").withColumn("shop_id", text).withColumn("note", F.lit(1)), f"{root}/dim_client.parquet")
    found = drift("dim_client", spark.read.parquet(f"{root}/dim_client.parquet"))
    back = read_raw(spark, root, "dim_client")
    return back.select("client_id", "shop_id", "tier", "note", F.lit("; ".join(f"{c} {f}" for _, c, f, _, _ in found)).alias("findings"))


def q_export_by_week(spark, sf_dir):
    """The KPI mart exported by week, all weeks' folders read back."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/export-{uuid.uuid4().hex}"
    path = f"{root}/mart_daily_kpi"
    write_table(_wh(spark, sf_dir)["mart_daily_kpi"], path, partition_by=["week_start"])
    return (spark.read.parquet(path).groupBy(F.col("week_start").cast("date").alias("week_start"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_orders").alias("total_orders")))


WEEK_RANGE = ("1997-01-06", "1997-03-31")


def q_export_week_range(spark, sf_dir):
    """A range of weeks of the exported KPI mart: the scan opens these weeks'
    folders alone."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/export-{uuid.uuid4().hex}/mart_daily_kpi"
    write_table(_wh(spark, sf_dir)["mart_daily_kpi"], path, partition_by=["week_start"])
    weeks = F.col("week_start").between(*[F.lit(d).cast("date") for d in WEEK_RANGE])
    return spark.read.parquet(path).filter(weeks).select("week_start", "date_id", "region", "total_orders")


def q_event_nanos(spark, sf_dir):
    """Event times as whole nanoseconds with a part below the second."""
    ev = spark.read.parquet(os.path.join(sf_dir, "events.parquet"))
    micros = F.unix_micros(F.col("ts").cast("timestamp")) + (F.col("event_id") * 7919) % 1000000
    nanos = ev.select("event_id", (micros * 1000 + F.col("event_id") % 1000).alias("at"))
    return nanos_to_timestamp(nanos, ["at"])


def q_large_ids(spark, sf_dir):
    """Ids beyond the whole numbers of a DOUBLE keep every digit."""
    o = spark.read.parquet(os.path.join(sf_dir, "orders.parquet"))
    big = (F.lit(9007199254740993) + F.col("o_orderkey")).cast("long")
    return o.select("o_orderkey", to_bigint(big).alias("big_id"), money(big).alias("big_amount"),
                    to_bigint(F.col("o_totalprice").cast("double")).alias("rounded"))


def _by_steps(spark, sf_dir, states: Callable[[DataFrame], list[DataFrame]]) -> list[DataFrame]:
    """States of the order fact as three loads leave them: the days up to a
    middle one with half of that day's orders, the middle day again with all of
    them, and the days after it. Each load publishes a version."""
    fct = _wh(spark, sf_dir)["fct_shipping_order"]
    middle = fct.agg(F.percentile_approx("date_id", 0.5)).scalar()
    day, half = F.col("date_id"), F.xxhash64("order_code") % 2 == 0
    loads = [fct.filter((day < middle) | (day == middle) & half), fct.filter(day == middle), fct.filter((day > middle) | day.isNull())]
    root = f"{checkpoint_dir(spark).rstrip('/')}/states-{uuid.uuid4().hex}"
    for n, load in enumerate(loads):
        for i, fresh in enumerate(states(load)):
            old = read_table(spark, f"{root}/{i}") if n else None
            publish_table(partials.replace_days(old, fresh, load.select("date_id")), f"{root}/{i}")
    return [read_table(spark, f"{root}/{i}") for i in range(len(states(fct)))]


def q_sla_by_states(spark, sf_dir):
    """The SLA mart from stored leadtime histograms of days."""
    states = _by_steps(spark, sf_dir, lambda fct: [partials.leadtime_states(fct)])
    wh = _wh(spark, sf_dir)
    return partials.sla_breakdown(states[0], wh["dim_date"], wh.hint)


def q_hub_by_states(spark, sf_dir):
    """The hub mart from stored daily sums and bitmaps of shippers."""
    measures, bitmaps = _by_steps(spark, sf_dir, lambda fct: list(partials.hub_states(fct)))
    wh = _wh(spark, sf_dir)
    return partials.hub_performance(measures, bitmaps, wh["dim_warehouse"], wh.hint)


QUERIES.update({
    "sla_by_states": q_sla_by_states,
    "hub_by_states": q_hub_by_states,
    "snapshot_on_disk": q_snapshot_on_disk,
    "pruned_scan": q_pruned_scan,
    "declared_read": q_declared_read,
    "export_by_week": q_export_by_week,
    "export_week_range": q_export_week_range,
    "event_nanos": q_event_nanos,
    "large_ids": q_large_ids,
    "scd2_two_runs": q_scd2_two_runs,
    "asof_tier": q_asof_tier,
    "asof_stream": q_asof_stream,
    "quarantine_only": q_quarantine_only,
    "order_dedup": q_order_dedup,
    "trip_rollup": q_trip_rollup,
    "trip_batches": q_trip_batches,
    "cod_adjustments": q_cod_adjustments,
    "running_minutes": q_running_minutes,
    "volumetric_weight": q_volumetric_weight,
    "action_name": q_action_name,
    "backfill_region": q_backfill_region,
    "collected_amount": q_collected_amount,
    "category_share": q_category_share,
    "status_share": q_status_share,
    "shipper_pool": q_shipper_pool,
    "sample_k": q_sample_k,
    "seed_lookup": q_seed_lookup,
    "roundtrip_parquet": q_roundtrip_parquet,
})


# ---------------------------------------------------------------- quality


# Region names present in the fixture data (from `region`).
FIXTURE_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
FIXTURE_YEARS = list(range(1995, 2002))
# Thresholds on the fixture are shares of its rows, so they mean the same at
# every size; quality.GATE_RULES has the absolute ones of a full-size run.
FIXTURE_GATE = [quality.GateRule("mart_daily_kpi", "week_start", share=0.3, of="dim_date"),
                quality.GateRule("mart_hub_performance", "warehouse_id", share=0.5, of="dim_warehouse"),
                quality.GateRule("mart_sla_breakdown", "week_start", share=0.1, of="dim_date"),
                quality.GateRule("mart_failure_reasons", "failure_reason", 5),
                quality.GateRule("mart_cod_reconciliation", "region", share=0.1, of="dim_date")]
DELIVERED_REASON_ERROR_AFTER = 0.01  # of the orders


def resolver(spark, wh: Warehouse):
    def resolve(layer: str, model: str) -> DataFrame:
        if layer == "source":
            return wh.raw[model]
        if layer == "seed":
            return read_seed(spark, model)
        return wh[model]
    return resolve


def fixture_checks(test: str | None = None) -> list[quality.Check]:
    cat = quality.catalogue(FIXTURE_REGIONS)
    return cat if test is None else [c for c in cat if c.test == test]


def q_dq_checks(spark, sf_dir, test: str | None = None):
    wh = built_for(spark, sf_dir)
    res = quality.run_checks(spark, resolver(spark, wh), fixture_checks(test), wh.hint)
    if test is not None:
        return res
    n = len(fixture_checks())
    rules = quality.rule_results(spark, wh["fct_cod"], wh["fct_shipping_order"],
                                 delivered_error_after=DELIVERED_REASON_ERROR_AFTER)
    singular = rules.select(
        F.when(F.col("rule") == "assert_cod_discrepancy_math", n).otherwise(n + 1).alias("check_id"),
        F.lit("singular").alias("layer"),
        F.when(F.col("rule") == "assert_cod_discrepancy_math", "fct_cod").otherwise("fct_shipping_order")
         .alias("model"),
        F.lit(None).cast("string").alias("column_name"), F.col("rule").alias("test"), "failures", "status")
    return res.unionByName(singular)


def _dq_subset(test: str):
    def run(spark, sf_dir):
        return q_dq_checks(spark, sf_dir, test)
    run.__name__ = f"dq_{test}"
    return run


def q_dq_cod_math(spark, sf_dir):
    return quality.cod_math_violations(built_for(spark, sf_dir)["fct_cod"])


def q_dq_delivered_reason(spark, sf_dir):
    return quality.delivered_with_reason(built_for(spark, sf_dir)["fct_shipping_order"])


def q_dq_gate(spark, sf_dir):
    wh = built_for(spark, sf_dir)
    return quality.gate_report(lambda m: wh[m], FIXTURE_GATE)


def q_dq_profile(spark, sf_dir):
    return quality.profile(_wh(spark, sf_dir).raw, FIXTURE_YEARS)


def q_quality_classify(spark, sf_dir):
    return quality.classify_summary(_wh(spark, sf_dir).raw, F.lit(AS_OF).cast("date"))


QUERIES.update({
    "dq_checks": q_dq_checks,
    "dq_not_null": _dq_subset("not_null"),
    "dq_unique": _dq_subset("unique"),
    "dq_accepted": _dq_subset("accepted_values"),
    "dq_relationships": _dq_subset("relationships"),
    "dq_cod_math": q_dq_cod_math,
    "dq_delivered_reason": q_dq_delivered_reason,
    "dq_gate": q_dq_gate,
    "dq_profile": q_dq_profile,
    "quality_classify": q_quality_classify,
})


# ---------------------------------------------------------------- SQL text


# A dashboard card as SQL text over the marts: how far collections are off,
# by region and year, in relation to what was due.
COD_CARD_SQL = """
with yearly as (
  select year, region, sum(discrepancy_records) as records_off, sum(net_discrepancy_vnd) as net_vnd,
         sum(gross_discrepancy_vnd) as gross_vnd, sum(total_cod_amount_vnd) as due_vnd
  from main_mart.mart_cod_reconciliation
  group by year, region)
select year, region, records_off, net_vnd, gross_vnd, gross_vnd / nullif(due_vnd, 0) as gross_share
from yearly
order by gross_vnd desc, year, region"""


def q_card_sql_cod(spark, sf_dir):
    wh = built_for(spark, sf_dir)
    return views.run_sql(spark, {m: wh[m] for m in Warehouse.MARTS}, COD_CARD_SQL)


# Ad-hoc SQL over staging views by their own names.
LATE_SQL = """
select s.outcome_group, w.warehouse_type, count(*) as orders,
  count_if(s.end_delivery_at > s.first_delivered_at) as late
from stg_shippingorder s left join stg_warehouse w on s.deliver_warehouse_id = w.warehouse_id
group by s.outcome_group, w.warehouse_type"""


def q_view_sql(spark, sf_dir):
    """Staging models as session views, queried by name."""
    views.register_views(_wh(spark, sf_dir), ["stg_shippingorder", "stg_warehouse"])
    return spark.sql(LATE_SQL)


QUERIES["card_sql_cod"] = q_card_sql_cod
QUERIES["view_sql"] = q_view_sql
