"""Invariants of the operators on the sf0.01 fixture and on small frames
built to stress them (hot groups, ties, NULL keys)."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hublytics.operators import derive, history, staging
from hublytics.operators.windows import running_total
from hublytics.plans.catalog import warehouse_for
from tests.conftest import SF_CHECK


def wh(spark):
    return warehouse_for(spark, SF_CHECK)[1]


def test_quarantine_routes_partition_the_input(spark):
    raw = wh(spark).raw["data_shippingorder_now"]
    keep, only = staging.keep_non_quarantine(raw), staging.only_quarantine(raw)
    assert keep.count() + only.count() == raw.count()
    assert keep.join(only, ["order_code", "created_date"], "inner").count() == 0


def test_dedup_leaves_one_row_per_key(spark):
    stg = wh(spark)["stg_shippingorder"]
    assert stg.count() == stg.select("order_code").distinct().count()
    # the duplicate copies are the newer rows, so they win
    raw = wh(spark).raw["data_shippingorder_now"]
    dup_keys = (raw.groupBy("order_code").agg(F.count_distinct("created_date").alias("n")).filter("n > 1")
                .select(F.trim("order_code").alias("order_code")))
    won = stg.join(dup_keys, "order_code").select("status").distinct().collect()
    assert [r[0] for r in won] == ["cancelled"]


def test_region_rows_sum_to_global_and_outcomes_to_total(spark):
    w = wh(spark)
    kpi = w["mart_daily_kpi"]
    s = kpi.agg(F.sum("total_orders"), F.sum(F.col("delivered_orders") + F.col("returned_orders")
                                             + F.col("cancelled_orders") + F.col("in_progress_orders"))).first()
    assert s[0] == s[1]
    fct = w["fct_shipping_order"]
    dates = w["dim_date"].select("date_id")
    assert s[0] == fct.join(dates, "date_id", "left_semi").count()


def test_failure_share_is_null_only_for_unknown_region(spark):
    rows = wh(spark)["mart_failure_reasons"].collect()
    for r in rows:
        assert (r["pct_of_region_failures"] is None) == (r["region"] == "unknown")
    known = [r for r in rows if r["region"] != "unknown"]
    by_region = {}
    for r in known:
        by_region[r["region"]] = by_region.get(r["region"], 0) + r["pct_of_region_failures"]
    assert all(abs(v - 100.0) < 0.1 for v in by_region.values())


def _snap_cols():
    return ["client_id", "shop_id", "client_type", "client_channel", "tier", "is_b2b", "region", "province_name"]


def test_scd2_one_open_row_per_key_and_no_overlap(spark):
    from hublytics.plans.catalog import q_scd2_two_runs
    snap = q_scd2_two_runs(spark, SF_CHECK)
    open_rows = snap.filter(F.col("valid_to").isNull())
    assert open_rows.count() == open_rows.select("client_id").distinct().count()
    w = Window.partitionBy("client_id").orderBy("valid_from")
    nxt = snap.withColumn("next_from", F.lead("valid_from").over(w))
    assert nxt.filter(F.col("next_from").isNotNull() & (F.col("valid_to") != F.col("next_from"))).count() == 0
    # changed tiers produce exactly one closed + one open version
    closed = snap.filter(F.col("valid_to").isNotNull()).count()
    assert closed > 0 and snap.count() == open_rows.count() + closed


def test_scd2_rerun_on_unchanged_input_changes_nothing(spark):
    src = wh(spark)["dim_client"].select(*_snap_cols())
    s1 = history.snapshot(src, "client_id", ["tier", "client_channel", "is_b2b"], "2000-01-01 00:00:00")
    s2 = history.snapshot(src, "client_id", ["tier", "client_channel", "is_b2b"], "2000-02-01 00:00:00", prev=s1)
    assert sorted(map(tuple, s1.collect())) == sorted(map(tuple, s2.collect()))


def test_scd2_missing_key_stays_open_and_null_safe_compare(spark):
    prev_src = spark.createDataFrame([(1, "Gold", None), (2, "Silver", True), (3, None, False)],
                                     "client_id long, tier string, is_b2b boolean")
    new_src = spark.createDataFrame([(1, "Gold", None), (3, None, True), (4, "Bronze", False)],
                                    "client_id long, tier string, is_b2b boolean")
    s1 = history.snapshot(prev_src, "client_id", ["tier", "is_b2b"], "2024-01-01 00:00:00")
    s2 = history.snapshot(new_src, "client_id", ["tier", "is_b2b"], "2024-02-01 00:00:00", prev=s1)
    rows = {(r["client_id"], r["valid_to"] is None) for r in s2.collect()}
    assert rows == {(1, True), (2, True), (3, False), (3, True), (4, True)}


def test_running_total_equals_plain_window_with_a_hot_group(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [("hot", base + dt.timedelta(seconds=i // 3), i % 7) for i in range(3000)]
    rows += [(f"g{i % 10}", base + dt.timedelta(seconds=i), i % 5) for i in range(500)]
    rows += [(None, base, 1), (None, base, 2)]
    df = spark.createDataFrame(rows, "g string, t timestamp_ntz, v long")
    order = [F.col("t"), F.col("v")]
    got = running_total(df, ["g"], F.unix_seconds(F.col("t").cast("timestamp")), order,
                        values={"n": None, "s": F.col("v")})
    w = Window.partitionBy("g").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("g", "t", "v", F.count(F.lit(1)).over(w).alias("n"), F.sum("v").over(w).alias("s"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_running_total_cuts_hot_groups(spark):
    """A hot group in parts equals the plain window; offsets stay few."""
    from hublytics.operators import windows
    base = dt.datetime(2024, 1, 1)
    rows = [("hot", base + dt.timedelta(seconds=(i * i) % 997), i) for i in range(3000)]
    rows += [("warm", base + dt.timedelta(days=i % 40), i) for i in range(700)] + [("same", base, i) for i in range(400)]
    rows += [(None, None if i % 9 == 0 else base + dt.timedelta(seconds=i), i) for i in range(600)] + [("g", None, 5), ("h", base, 1)]
    df = spark.createDataFrame(rows, "g string, t timestamp_ntz, v long").repartition(5)
    order = [F.col("t"), F.col("v")]
    at = F.unix_seconds(F.col("t").cast("timestamp"))
    got = running_total(df, ["g"], at, order, values={"n": None, "s": F.col("v")}, max_rows=100)
    w = Window.partitionBy("g").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("g", "t", "v", F.count(F.lit(1)).over(w).alias("n"), F.sum("v").over(w).alias("s"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    data = df.select(F.struct("g").alias("__g"), at.cast("long").alias("__at"))
    bounds = {r["__bg"]["g"]: r["__bounds"] for r in windows.slices(data, 100).collect()}
    assert set(bounds) == {"hot", "warm", "same", None}
    assert 15 <= len(bounds["hot"]) <= 60 and sum(map(len, bounds.values())) <= 2 * len(rows) / 100
    assert running_total(df.limit(0), ["g"], at, order).count() == 0


def test_a_hot_group_within_one_second_is_cut(spark):
    """Events of one second lie in several parts where their microseconds differ."""
    from hublytics.operators import windows
    base = dt.datetime(2024, 1, 1)
    rows = [("hot", base + dt.timedelta(microseconds=(i * 7919) % 999_983), i % 13) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, t timestamp_ntz, v long").repartition(5)
    at, order = F.unix_micros(F.col("t").cast("timestamp")), [F.col("t"), F.col("v")]
    data = df.select(F.struct("g").alias("__g"), at.alias("__at"))
    assert 15 <= len(windows.slices(data, 100).first()["__bounds"]) <= 60
    got = running_total(df, ["g"], at, order, values={"n": None, "s": F.col("v")}, max_rows=100)
    w = Window.partitionBy("g").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("g", "t", "v", F.count(F.lit(1)).over(w).alias("n"), F.sum("v").over(w).alias("s"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_as_of_stream_equals_the_range_join_with_a_hot_key(spark):
    base = dt.datetime(2024, 1, 1)
    at = lambda i: base + dt.timedelta(minutes=i)
    versions = []
    for k in ("hot", "cold", "once"):
        marks = sorted({(i * 37) % 900 for i in range(25 if k != "once" else 1)})
        for a, b in zip(marks, marks[1:] + [None], strict=True):
            if a % 5 != 3:  # gaps between versions
                versions.append((k, at(a), None if b is None else at(b), f"{k}{a}"))
    versions += [("hot", at(2000), at(2000), "empty"), ("gone", at(5), at(9), "gone"), (None, at(1), None, "none")]
    h = spark.createDataFrame(versions, "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, tier string")
    h = h.filter("tier not in ('hot999')")
    facts = [("hot", at(i % 1100), i) for i in range(2500)] + [("cold", at(i * 9), i) for i in range(120)]
    facts += [(None, at(3), 1), ("hot", None, 2), ("unknown", at(4), 3), ("gone", at(9), 4), ("gone", at(8), 5), facts[0], ("hot", at(2000), 6)]
    f = spark.createDataFrame(facts, "k string, t timestamp_ntz, n int").repartition(4)
    rows = lambda d: sorted(map(tuple, d.collect()), key=str)
    want = rows(history.as_of_join(f, h, "k", "t", ["tier"]))
    assert rows(history.as_of_join(f, h, "k", "t", ["tier"], max_broadcast_bytes=0)) == want
    assert rows(history.as_of_join(f, h, "k", "t", ["tier"], max_broadcast_bytes=0, max_rows=100)) == want
    assert sum(r[3] is not None for r in want) > 1500 and sum(r[3] is None for r in want) > 5


def test_a_run_without_changes_writes_no_row(spark, tmp_root):
    from hublytics.sources.sinks import read_history, read_open, version_path, write_version
    base = f"{tmp_root}/snap_delta"
    check = ["tier", "is_b2b"]
    days = [[(1, "Gold", None), (2, "Silver", True), (3, None, False)], [(1, "Gold", None), (2, "Silver", True), (3, None, False)],
            [(1, "Gold", None), (3, None, True), (4, "Bronze", False)], [(1, "Gold", None), (2, "Gold", True), (3, None, False), (4, "Bronze", False)]]
    whole, sizes = None, []
    for v, day in enumerate(days, start=1):
        src = spark.createDataFrame(day, "client_id long, tier string, is_b2b boolean")
        at = f"2024-0{v}-01 00:00:00"
        write_version(spark, history.changes(src, "client_id", check, at, read_open(spark, base)), base, v)
        sizes.append(spark.read.parquet(version_path(base, v)).count())
        whole = history.snapshot(src, "client_id", check, at, prev=whole)
    assert sizes == [3, 0, 3, 4]
    rows = lambda d: sorted((str(r.client_id), r.tier, r.is_b2b, str(r.valid_from), str(r.valid_to), r.scd_id) for r in d.collect())
    assert rows(read_history(spark, base)) == rows(whole)


def _orders(n):
    """Codes of which one holds a third of the rows; ties, whole copies, missing codes and times."""
    out = []
    for i in range(n):
        code = "hot" if i % 3 == 0 else None if i % 100 == 1 else f"o{i // 4 if i % 50 == 2 else i}"
        at = None if i % 11 == 0 else dt.datetime(2024, 1, 1) + dt.timedelta(hours=i % 17)
        out.append((code, at, ["a", "b", None][i % 3], float(i % 5), i % 4, f"payload {i}"))
    return out + out[: n // 10]


ORDER_SCHEMA = ("order_code string, created_date timestamp_ntz, status string, deliver_warehouse_id double, cod_amount int, "
                "note string")


def test_key_only_dedup_equals_the_window(spark, tmp_root):
    from hublytics.operators import dedup
    path = f"{tmp_root}/dedup_orders"
    spark.createDataFrame(_orders(3000), ORDER_SCHEMA).repartition(6).write.parquet(path)
    raw = spark.read.parquet(path).filter("cod_amount < 3")
    order = staging.dedup_order()
    places = dedup.first_places(raw, "order_code", order, staging.DEDUP_COLUMNS)
    got = dedup.keep_first(raw, "order_code", order, places)
    want = dedup.dedup_latest(raw, "order_code", order)
    cols = ["order_code", *staging.DEDUP_COLUMNS]
    as_rows = lambda d: sorted(map(tuple, d.select(*cols).collect()), key=str)
    assert as_rows(got) == as_rows(want)
    whole = {tuple(r) for r in raw.collect()}
    kept = [tuple(r) for r in got.collect()]
    assert len(kept) == len({r[0] for r in whole}) and set(kept) <= whole
    # one row a repeated code, whatever the code's rows
    codes = [r[0] for r in raw.select("order_code").collect()]
    assert places.count() == len({c for c in codes if codes.count(c) > 1})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan
    # beyond the bound, and for rows that come from no file, the window does it
    assert "Window" in dedup.keep_first(raw, "order_code", order, places, max_bytes=0)._jdf.queryExecution().executedPlan().toString()
    made = spark.createDataFrame(_orders(60), ORDER_SCHEMA)
    assert dedup.first_places(made, "order_code", order, staging.DEDUP_COLUMNS) is None
    assert staging.keep_first(made, "order_code", order, None).count() == made.select("order_code").distinct().count()


def test_trip_rollup_takes_the_first_known_hubs_in_any_row_order(spark):
    import itertools
    nan, t1, t2 = float("nan"), dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 1, 1, 9)
    rows = [("T1", t1, "p1", None, 7.0), ("T1", t1, "p2", nan, 8.0), ("T1", t2, "p3", 5.0, 6.0), ("T1", t2, "p3", 4.0, 9.0),
            ("T2", t1, "p1", None, 3.0), ("T2", t2, "p0", 2.0, nan), ("T2", t2, "p0", 1.0, None), ("T3", t1, "p", None, nan)]
    seen = set()
    for some in itertools.islice(itertools.permutations(rows), 0, 40320, 8001):
        h = spark.createDataFrame([("export", *r) for r in some], "action_category string, trip_code string, action_time timestamp_ntz, "
                                  "package_code string, from_warehouse_id double, to_warehouse_id double")
        seen.add(str(sorted((r.trip_code, r.from_warehouse_id, r.to_warehouse_id, r.n_packages) for r in derive.trip_rollup(h).collect())))
    assert seen == {"[('T1', 4.0, 9.0, 4), ('T2', 1.0, 3.0, 3), ('T3', None, None, 1)]"}


def test_checks_on_text_keys_mixed_types_and_hot_failures(spark):
    from hublytics.operators import quality
    child = spark.createDataFrame([(1, "a", None), (1, "b", "x"), (2, "c", "x"), (9, "c", "y"), (None, None, None)] + [(7, "h", "bad")] * 500,
                                  "n int, t string, v string")
    parent = spark.createDataFrame([(1, "a"), (1, "a"), (2, "c"), (None, "b")], "id long, t string")
    C = quality.Check
    checks = [C("l", "child", "n", "relationships", to="parent", field="id"), C("l", "child", "t", "relationships", to="parent", field="t"),
              C("l", "child", "n", "unique"), C("l", "parent", "id", "unique"), C("l", "child", "t", "unique"), C("l", "child", "v", "not_null"),
              C("l", "child", "v", "accepted_values", values=("x", "y"), severity="warn"), C("l", "parent", "id", "not_null"),
              C("l", "child", "n", "relationships", to="parent", field="t"), C("l", "parent", "t", "accepted_values", values=("a", "b", "c"))]
    got = quality.run_checks(spark, lambda layer, m: {"child": child, "parent": parent}[m], checks).orderBy("check_id").collect()
    assert [r.failures for r in got] == [501, 500, 2, 1, 2, 2, 500, 1, 504, 0]
    assert [r.status for r in got] == ["ERROR"] * 6 + ["WARN", "ERROR", "ERROR", "PASS"]


def test_trip_batches_respect_capacity(spark):
    raw = wh(spark).raw
    b = derive.trip_batches(raw["data_inside_history"], raw["data_shippingorder_now"], capacity=5)
    assert b.filter(F.col("n_packages") > 5).count() == 0
    exports = wh(spark).raw["data_inside_history"].filter(F.col("action_category") == "export").count()
    assert b.agg(F.sum("n_packages")).first()[0] == exports


def test_cod_adjustment_ids_are_new_and_unique(spark):
    cod = wh(spark).raw["data_cod"]
    assert cod.count() == cod.select("cod_id").distinct().count()
    adj = cod.filter(F.col("cod_status") == "adjustment")
    base_max = cod.filter(F.col("cod_status") != "adjustment").agg(F.max("cod_id")).first()[0]
    ids = sorted(r[0] for r in adj.select("cod_id").collect())
    assert ids and ids == list(range(base_max + 1, base_max + 1 + len(ids)))
    assert adj.filter(F.col("discrepancy_amount") != 0).count() == 0


def test_minute_level_leadtimes_agree_with_tolerance(spark):
    """Minute-level durations: compared unrounded with a tolerance (the
    driver's exact hash is not used for them)."""
    import duckdb
    from oracle.models import with_ctes
    fct = wh(spark)["fct_shipping_order"]
    got = {r[0]: r[1] for r in fct.groupBy("deliver_region").agg(
        F.avg((F.unix_seconds(F.col("end_pick_at").cast("timestamp"))
               - F.unix_seconds(F.col("created_at").cast("timestamp"))) / 60.0 + F.minute("created_at") / 7.0))
        .collect()}
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "orders", "lineitem", "events"]:
        con.execute(f"create view {t} as select * from read_parquet('{SF_CHECK}/{t}.parquet')")
    sql = with_ctes("select deliver_region, avg(date_diff('second', created_at, end_pick_at) / 60.0 "
                    "+ minute(created_at) / 7.0) from fct_shipping_order group by 1")
    want = {r[0]: r[1] for r in con.execute(sql).fetchall()}
    assert got.keys() == want.keys()
    for k in got:
        assert abs(got[k] - want[k]) < 1e-9


def test_relationship_check_same_result_with_and_without_broadcast(spark):
    from hublytics.operators import quality
    from hublytics.operators.joins import BroadcastPolicy
    from hublytics.plans.catalog import fixture_checks, resolver
    w = wh(spark)
    checks = fixture_checks("relationships")
    every = resolver(spark, w)

    def resolve(layer, model):  # half of the hubs are unknown
        df = every(layer, model)
        return df.filter("warehouse_id % 2 = 0") if model == "dim_warehouse" else df
    small = quality.run_checks(spark, resolve, checks, BroadcastPolicy())
    big = quality.run_checks(spark, resolve, checks, BroadcastPolicy(max_bytes=0))
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, big.collect()))
    assert any(r["failures"] > 0 for r in small.collect())


def test_approximate_distinct_counts_are_close(spark):
    from hublytics.operators import marts
    w = wh(spark)
    exact = {r["warehouse_id"]: r["active_shippers"] for r in w["mart_hub_performance"].collect()}
    approx = {r["warehouse_id"]: r["active_shippers"] for r in
              marts.mart_hub_performance(w["fct_shipping_order"], w["dim_warehouse"], w.hint, 0.01).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - exact[k]) <= max(2, 0.05 * exact[k]) for k in exact)


def test_exact_percentiles_equal_builtin_with_hot_group_and_nulls(spark):
    import random
    from hublytics.operators.percentiles import exact_percentiles
    rnd = random.Random(7)
    rows = [("hot", float(rnd.randint(0, 50))) for _ in range(5000)]
    rows += [(f"g{i % 20}", rnd.choice([None, rnd.random() * 100, float(rnd.randint(0, 9))])) for i in range(800)]
    rows += [("single", 3.25), ("nulls", None), ("nulls", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    ps = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    got = {r["g"]: r for r in exact_percentiles(df, ["g"], "v", ps).collect()}
    want = {r["g"]: r for r in df.groupBy("g").agg(
        *[F.percentile("v", F.lit(p)).alias(n) for n, p in ps.items()]).collect()}
    assert got.keys() == want.keys()
    for g in want:
        for n in ps:
            a, b = got[g][n], want[g][n]
            assert (a is None and b is None) or abs(a - b) < 1e-9, (g, n, a, b)


def test_trip_batches_use_the_day_of_the_order(spark):
    history = spark.createDataFrame(
        [("export", f"p{i}", "o1" if i % 2 else "o2", f"2000-01-0{1 + i % 5} 10:00:00", 1.0, 2.0) for i in range(10)],
        "action_category string, package_code string, order_code string, action_time string, from_warehouse_id double, "
        "to_warehouse_id double").withColumn("action_time", F.col("action_time").cast("timestamp_ntz"))
    orders = spark.createDataFrame([("o1", "1999-12-30 08:00:00"), ("o1", "1999-12-31 08:00:00")], "order_code string, t string") \
        .select("order_code", F.col("t").cast("timestamp_ntz").alias("created_date"))
    rows = derive.trip_batches(history, orders, capacity=3).collect()
    got = sorted((str(r.route_day), r.batch_no, r.n_packages) for r in rows)
    assert got == [("1999-12-30", 0, 3), ("1999-12-30", 1, 2), ("None", 0, 3), ("None", 1, 2)]


def test_exact_copies_of_an_order_are_repeats(spark):
    from hublytics.operators import quality
    raw = dict(wh(spark).raw.items())
    one = raw["data_shippingorder_now"].filter(F.col("_data_quality") == "clean").orderBy("order_code").limit(1)
    raw["data_shippingorder_now"] = one.union(one).union(one)
    rows = quality.quality_rules(raw, F.lit("2001-06-30").cast("date"))["data_shippingorder_now"].collect()
    assert sorted(r.derived == "heavy_issue" for r in rows) == [False, True, True]


def test_fixture_grows_with_its_tables(spark):
    raw = wh(spark).raw
    customers = spark.read.parquet(f"{SF_CHECK}/customer.parquet").count()
    assert raw["dim_shipper"].count() == customers
    hubs = raw["dim_warehouse"].count()
    assert raw["data_transportation"].select("from_warehouse_id").distinct().count() > hubs // 2
    last = spark.read.parquet(f"{SF_CHECK}/orders.parquet").agg(F.max(F.to_date("o_orderdate"))).first()[0]
    assert raw["dim_date"].agg(F.max("date")).first()[0] == last
    assert quality_violations(spark) > 0


def quality_violations(spark):
    from hublytics.operators import quality
    return quality.cod_math_violations(wh(spark)["fct_cod"]).count()


def test_kpi_drops_orders_without_a_calendar_day(spark):
    """The inner join to the calendar (shown on a small frame)."""
    from hublytics.operators import marts
    w = wh(spark)
    days = w["dim_date"].orderBy("date_id").limit(3)
    ids = {r.date_id for r in days.collect()}
    got = {r.date_id for r in marts.mart_daily_kpi(w["fct_shipping_order"], spark.createDataFrame(days.collect(), days.schema)).collect()}
    assert got and got <= ids


def test_states_by_day_merge_to_the_full_marts(spark):
    """Distinct counts and quantiles from merged states, also for ids beyond one
    bitmap, hubs without shippers, days without a key and days that shrink."""
    from hublytics.operators import marts, partials
    w = wh(spark)
    fct = w["fct_shipping_order"].withColumn("deliver_user_id", F.col("deliver_user_id") * 40_000 - 7_000_000)
    fct = fct.withColumn("deliver_user_id", F.when(F.col("deliver_warehouse_id") % 9 != 0, F.col("deliver_user_id")))
    rows = lambda d: sorted(map(str, d.collect()))
    measures, bitmaps = partials.hub_states(fct)
    want = marts.mart_hub_performance(fct, w["dim_warehouse"], w.hint)
    assert rows(partials.hub_performance(measures, bitmaps, w["dim_warehouse"], w.hint)) == rows(want)
    assert bitmaps.select("bucket").distinct().count() > 10 and want.filter("active_shippers = 0").count() > 0
    lost = fct.filter("date_id % 3 = 0").filter("hash(order_code) % 2 = 0")
    after = fct.filter("date_id % 3 != 0").unionByName(lost)
    states = partials.replace_days(partials.leadtime_states(fct), partials.leadtime_states(lost), fct.filter("date_id % 3 = 0"))
    assert rows(partials.sla_breakdown(states, w["dim_date"], w.hint)) == rows(marts.mart_sla_breakdown(after, w["dim_date"], w.hint))


def test_shipper_states_are_as_small_as_their_shippers(spark):
    """One order a hub and day, shippers far apart: no state is wider than a few
    numbers, and none needs sorted buffers; ids below 0 and at a word's ends count."""
    from hublytics.operators import marts, partials
    ids = [-65, -64, -1, 0, 63, 64, 2 ** 40, 2 ** 62, -2 ** 63]
    rows = [(20000101 + i % 3, i % 2, ids[i % len(ids)]) for i in range(60)] + [(20000101, 2, None), (None, 1, 63)]
    fct = spark.createDataFrame(rows, "date_id int, deliver_warehouse_id long, deliver_user_id long").selectExpr(
        "*", "true is_delivered", "false is_returned", "false is_sla_breach", "false is_cod", "0L cod_amount_vnd", "1.0D delivery_hours")
    hubs = spark.range(3).selectExpr("id warehouse_id", "'' warehouse_name", "'' warehouse_type", "'' region", "'' region_shortname",
                                     "'' province_name")
    measures, bitmaps = partials.hub_states(fct)
    got = {r.warehouse_id: r.active_shippers for r in partials.hub_performance(measures, bitmaps, hubs).collect()}
    assert got == {0: 9, 1: 9, 2: 0} == {r.warehouse_id: r.active_shippers for r in marts.mart_hub_performance(fct, hubs).collect()}
    assert all(f.dataType.typeName() in ("integer", "long") for f in bitmaps.schema.fields)
    assert "SortAggregate" not in bitmaps._jdf.queryExecution().executedPlan().toString()


def test_attempts_travel_to_their_orders_as_flags(spark):
    """The classifier's shuffle join of attempts carries no status, reason or hub;
    attempts without order, time or status are judged as before."""
    from hublytics.operators import quality
    w = wh(spark)
    at = dt.datetime(2000, 1, 2)
    early = at - dt.timedelta(days=1)
    rows = [("A", " Failed ", None, at, 1.0), ("A", "failed", "other", at, 1.0), (" A", "success", None, early, 1.0), ("A", None, None, None, None),
            ("X", "success", None, early, float("nan")), (None, "success", None, early, 1.0), ("A", None, None, early, 1.0)]
    attempts = spark.createDataFrame(rows, "order_code string, attempt_status string, failure_reason string, deliver_time timestamp_ntz, "
                                           "deliver_warehouse_id double").withColumn("_data_quality", F.lit("q"))
    orders = w.raw["data_shippingorder_now"].limit(2).withColumns({"order_code": F.lit(" A "), "created_date": F.lit(at).cast("timestamp_ntz")})
    raw = {n: w.raw[n] for n in w.raw if n not in ("data_shipment", "data_shippingorder_now")}
    found = quality.quality_rules(raw | {"data_shipment": attempts, "data_shippingorder_now": orders}, F.lit("2001-01-01").cast("date"))
    got = sorted(r.derived for r in found["data_shipment"].collect())
    assert got == sorted(["heavy_issue", "clean", "heavy_issue", "light_issue", "light_issue", "clean", "heavy_issue"])
    plan = quality.quality_rules(w.raw, F.lit("2001-01-01").cast("date"))["data_shipment"]
    join = plan._jdf.queryExecution().optimizedPlan().children().head()
    carried = {a.split("#")[0] for a in str(join.children().head().output().mkString(",")).split(",")}
    assert carried == {"carried", "__code", "deliver_time", "__heavy", "__light"}


def test_wide_tables_are_written_with_small_methods(spark, monkeypatch):
    """No generated method beyond what the JVM compiles while wide tables are
    written; the session's own settings come back, after a failure too."""
    from hublytics.plans import catalog
    from hublytics.session import WIDE_CONF, wide_rows
    kept = {k: spark.conf.get(k, None) for k in WIDE_CONF}
    seen = []
    monkeypatch.setattr(catalog, "write_table", lambda df, path: (
        seen.append({k: spark.conf.get(k) for k in WIDE_CONF}), df.write.mode("overwrite").parquet(path)))
    fx = wh(spark).raw.fx
    raw = catalog.MaterializedRaw(spark, fx)
    rows = sorted(map(str, raw["data_shippingorder_now"].collect()))
    assert seen == [WIDE_CONF] and int(WIDE_CONF["spark.sql.codegen.hugeMethodLimit"]) <= 8000
    assert {k: spark.conf.get(k, None) for k in WIDE_CONF} == kept
    assert rows == sorted(map(str, fx.data_shippingorder_now().collect()))
    with pytest.raises(ValueError), wide_rows(spark):
        raise ValueError
    assert {k: spark.conf.get(k, None) for k in WIDE_CONF} == kept


def test_a_well_compressed_dimension_is_not_broadcast(spark, tmp_root):
    """Files of a few MB that hold hundreds of MB of rows."""
    from hublytics.operators import joins
    path = f"{tmp_root}/compressed_dim"
    spark.range(1_000_000).select("id", F.repeat(F.lit("x"), 400).alias("a"), F.lit("region").alias("b")).write.parquet(path)
    dim = spark.read.parquet(path)
    assert joins.SURE_BYTES < joins.estimated_bytes(dim) < joins.MAX_BROADCAST_BYTES < 300_000_000 < joins.measured_bytes(dim)
    policy = joins.BroadcastPolicy()
    assert not policy.is_small("dim", dim) and policy.is_small("dim", dim.select("id", "b").limit(1000))
    facts = spark.range(10).withColumnRenamed("id", "k")
    plan = lambda d: facts.join(policy("dim", d), facts["k"] == d["id"])._jdf.queryExecution().logical().toString()
    assert "ResolvedHint" not in plan(dim) and "Hint" in plan(dim.filter("id < 5").select("id", "b"))
    assert not joins.fits(dim, 10) and joins.fits(dim.limit(0))
