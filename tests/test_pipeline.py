"""The daily run end to end on sf0.001: raw parquet -> written core and
marts -> checks -> snapshot versions -> gate."""

import os

import pytest
from pyspark.sql import functions as F

from hublytics.operators import quality
from hublytics.plans import catalog, pipeline
from hublytics.sources.fixtures import fixture_tables
from hublytics.sources.sinks import SnapshotError, current_version, read_history, read_open, version_path, write_table, write_version
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def raw_dir(spark, tmp_root):
    d = os.path.join(tmp_root, "raw")
    for name, df in fixture_tables(spark, SF_SMALL).items():
        write_table(df, os.path.join(d, f"{name}.parquet"))
    return d


def test_daily_run(spark, tmp_root, raw_dir):
    out = os.path.join(tmp_root, "wh")
    rules = [quality.GateRule("mart_daily_kpi", "week_start", 1), quality.GateRule("mart_hub_performance",
                                                                                    "warehouse_id", 1)]
    rep = pipeline.run(spark, raw_dir, out, as_of=catalog.AS_OF, run_at="2001-07-01 06:00:00",
                       checks=catalog.fixture_checks(), gate_rules=rules, fail_fast=False)
    for s in ("seed_status_mapping", "seed_sla_threshold"):
        assert spark.read.parquet(os.path.join(out, s)).count() > 0
    assert rep["gate_error"] is None and rep["schema_drift"] == []
    assert sum(rep["tests"].values()) == 89
    for m in ["fct_shipping_order", "mart_daily_kpi", "mart_cod_reconciliation", "_test_results"]:
        assert spark.read.parquet(os.path.join(out, m)).count() > 0
    assert rep["snapshot"].endswith("v=000001")

    # second day: a new snapshot version, open rows unchanged for unchanged input
    base = os.path.join(out, "snap_client_tier")
    v1 = spark.read.parquet(rep["snapshot"])
    raw = pipeline.read_raw_tables(spark, raw_dir)
    wh = pipeline.Warehouse(raw, as_of=catalog.AS_OF)
    path = pipeline.snapshot(spark, wh, out, "2001-07-02 06:00:00")
    assert path.endswith("v=000002") and version_path(base, current_version(spark, base)) == path
    assert spark.read.parquet(path).count() == 0  # nothing changed, nothing is written
    assert read_open(spark, base).count() == v1.filter(F.col("valid_to").isNull()).count() == v1.count()


def test_gate_raises_listing_all_failures(spark, tmp_root, raw_dir):
    out = os.path.join(tmp_root, "wh_gate")
    rules = [quality.GateRule("mart_daily_kpi", "week_start", 10**9),
             quality.GateRule("mart_failure_reasons", "failure_reason", 10**9)]
    with pytest.raises(ValueError) as e:
        pipeline.run(spark, raw_dir, out, as_of=catalog.AS_OF, run_at="2001-07-01 06:00:00",
                     checks=catalog.fixture_checks("not_null"), gate_rules=rules, fail_fast=False)
    assert "mart_daily_kpi" in str(e.value) and "mart_failure_reasons" in str(e.value)


def test_export_partitions_weekly_marts(spark, tmp_root):
    from hublytics.plans.catalog import warehouse_for
    from hublytics.plans.views import export_marts
    wh = warehouse_for(spark, SF_SMALL)[1]
    paths = export_marts(wh, os.path.join(tmp_root, "export"))
    kpi_dirs = [d for d in os.listdir(paths["mart_daily_kpi"]) if d.startswith("week_start=")]
    assert len(kpi_dirs) > 10
    assert not any(d.startswith("week_start=") for d in os.listdir(paths["mart_hub_performance"]))
    back = spark.read.parquet(paths["mart_daily_kpi"])
    assert back.count() == wh["mart_daily_kpi"].count()


def test_observed_checks_equal_scanned_checks(spark, tmp_root, raw_dir):
    from hublytics.plans.warehouse import Warehouse
    out = os.path.join(tmp_root, "wh_obs")
    checks = catalog.fixture_checks()
    pipeline.run(spark, raw_dir, out, as_of=catalog.AS_OF, run_at="2001-07-01 06:00:00", checks=checks,
                 gate_rules=[], raise_on_gate=False, fail_fast=False)
    got = {r["check_id"]: (r["failures"], r["status"])
           for r in spark.read.parquet(os.path.join(out, "_test_results")).collect()}
    wh = Warehouse(pipeline.read_raw_tables(spark, raw_dir), as_of=catalog.AS_OF)
    res = quality.run_checks(spark, catalog.resolver(spark, wh), checks, wh.hint)
    want = {r["check_id"]: (r["failures"], r["status"]) for r in res.collect()}
    assert {k: v for k, v in got.items() if k < len(checks)} == want
    assert any(f > 0 for f, _ in want.values())


def test_cli_daily_run(tmp_root, raw_dir):
    import json
    import subprocess
    import sys
    out = os.path.join(tmp_root, "wh_cli")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    p = subprocess.run([sys.executable, "-m", "hublytics", "run", "--raw", raw_dir, "--out", out,
                        "--as-of", catalog.AS_OF, "--run-at", "2001-07-01 06:00:00", "--master", "local[4]", "--keep-going"],
                       cwd=root, capture_output=True, text=True, timeout=900)
    report = json.loads(p.stdout.strip().splitlines()[-1])
    assert sum(report["tests"].values()) == 89
    assert report["snapshot"].endswith("v=000001")
    # the default gate (full-size thresholds) fails on the tiny fixture -> exit code 1
    assert report["gate_error"] and p.returncode == 1


def test_fail_fast_stops_before_snapshot(spark, tmp_root, raw_dir):
    out = os.path.join(tmp_root, "wh_ff")
    with pytest.raises(ValueError) as e:
        pipeline.run(spark, raw_dir, out, as_of=catalog.AS_OF, run_at="2001-07-01 06:00:00",
                     checks=quality.catalogue())  # default regions: accepted-values ERROR
    assert "accepted_values" in str(e.value)
    assert not os.path.exists(os.path.join(out, "snap_client_tier"))


def test_fixture_tables_are_written_lazily(spark):
    from hublytics.plans.catalog import MaterializedRaw
    from hublytics.sources.fixtures import Fixture
    raw = MaterializedRaw(spark, Fixture(spark, SF_SMALL))
    assert "data_cod" in raw and len(raw) == 11
    raw["dim_date"].count()
    assert sorted(os.listdir(raw.root)) == ["dim_date.parquet"]


def _snap(spark, prev, tiers, at):
    from hublytics.operators import history
    src = spark.createDataFrame(list(tiers.items()), "k long, tier string")
    return history.changes(src, "k", ["tier"], at, prev)


def test_snapshot_versions_are_safe(spark, tmp_root):
    base = os.path.join(tmp_root, "snap_safe")
    write_version(spark, _snap(spark, None, {1: "a", 2: "b"}, "2000-01-01 00:00:00"), base, 1)
    write_version(spark, _snap(spark, read_open(spark, base), {1: "a", 2: "c"}, "2000-02-01 00:00:00"), base, 2)
    closed = lambda: read_history(spark, base).filter("valid_to is not null").count()
    assert closed() == 1
    # a half-written third version is not seen, and is replaced
    spark.range(3).write.parquet(os.path.join(base, "v=000003"))
    os.remove(os.path.join(base, "v=000003", "_SUCCESS"))
    assert current_version(spark, base) == 2
    # version 1 or 2 cannot be written again
    for v in (1, 2):
        with pytest.raises(SnapshotError):
            write_version(spark, spark.range(1), base, v)
    # two runs built on version 2: the second to finish raises
    one = _snap(spark, read_open(spark, base), {1: "z", 2: "c"}, "2000-03-01 00:00:00")
    two = _snap(spark, read_open(spark, base), {1: "y", 2: "c"}, "2000-03-01 00:00:01")
    write_version(spark, one, base, 3)
    with pytest.raises(SnapshotError):
        write_version(spark, two, base, 3)
    assert current_version(spark, base) == 3 and closed() == 2
    assert read_history(spark, base).count() == 4
    # a version holds no row that an earlier one closed
    assert spark.read.parquet(version_path(base, 3)).filter("valid_to is not null").count() == 1
    assert not [f for f in os.listdir(base) if f.startswith("_writing")]


def test_unreadable_snapshot_folder_is_an_error(spark, tmp_root):
    base = os.path.join(tmp_root, "snap_file")
    assert current_version(spark, base) is None
    os.makedirs(os.path.join(base, "v=broken"))
    open(os.path.join(base, "v=broken", "_SUCCESS"), "w").close()
    with pytest.raises(ValueError):
        current_version(spark, base)


def test_published_table_is_whole_old_or_whole_new(spark, tmp_root):
    """A reader during a refresh and a failed refresh both see the old table."""
    from hublytics.sources.sinks import TableError, complete_versions, publish_table, read_table
    path = os.path.join(tmp_root, "published")
    with pytest.raises(TableError):
        read_table(spark, path)
    publish_table(spark.range(10), path)
    old = read_table(spark, path)
    fails = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("broken row"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken row"):
        publish_table(fails, path)
    assert read_table(spark, path).count() == 10 and not [f for f in os.listdir(path) if f.startswith("_writing")]
    # half-written: there, but without its mark
    spark.range(3).write.parquet(os.path.join(path, "v=000007"))
    os.remove(os.path.join(path, "v=000007", "_SUCCESS"))
    assert read_table(spark, path).count() == 10
    publish_table(spark.range(20), path)
    assert old.count() == 10 and read_table(spark, path).count() == 20  # the reader's files are still there
    publish_table(spark.range(30), path)
    assert read_table(spark, path).count() == 30
    assert complete_versions(spark, path) == [8, 9]  # older ones go
    # a table refreshed from itself
    publish_table(read_table(spark, path).filter("id < 5"), path)
    assert sorted(r.id for r in read_table(spark, path).collect()) == list(range(5))


def test_concurrent_refreshes_all_publish(spark, tmp_root):
    from concurrent.futures import ThreadPoolExecutor
    from hublytics.sources.sinks import complete_versions, publish_table, read_table
    path = os.path.join(tmp_root, "published_by_many")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: publish_table(spark.range(n), path, keep=10), [1, 2, 3, 4, 5, 6]))
    assert complete_versions(spark, path) == [1, 2, 3, 4, 5, 6]
    assert read_table(spark, path).count() in range(1, 7)


def test_report_sql_leaves_the_catalog_alone(spark, tmp_root):
    from hublytics.plans import views
    from hublytics.sources.sinks import TableError, publish_table
    spark.sql("create schema if not exists main_mart")
    spark.sql("create table main_mart.mart_cod_reconciliation using parquet as select id from range(7)")
    assert catalog.QUERIES["card_sql_cod"](spark, SF_SMALL).count() > 0
    assert spark.table("main_mart.mart_cod_reconciliation").count() == 7
    got = views.run_sql(spark, {"m": spark.range(3)}, "select 'main_mart.m' as t, count(*) as n from MAIN_MART.`m` join main_mart.m using (id)")
    assert [tuple(r) for r in got.collect()] == [("main_mart.m", 3)]
    # published tables in the catalog: created, moved to the newest version, never taken from others
    path = os.path.join(tmp_root, "in_catalog")
    publish_table(spark.range(4), path)
    assert views.publish_to_catalog(spark, {"own": path}, "main_mart") == ["main_mart.own"]
    assert spark.table("main_mart.own").count() == 4
    publish_table(spark.range(6), path)
    views.publish_to_catalog(spark, {"own": path}, "main_mart")
    assert spark.table("main_mart.own").count() == 6
    with pytest.raises(TableError):
        views.publish_to_catalog(spark, {"mart_cod_reconciliation": path}, "main_mart")
    assert spark.table("main_mart.mart_cod_reconciliation").count() == 7
    spark.sql("drop table main_mart.mart_cod_reconciliation")


def test_a_run_on_drifted_files_reports_and_goes_on(spark, tmp_root, raw_dir):
    from hublytics.sources import raw as raw_tables
    drifted = os.path.join(tmp_root, "raw_drifted")
    for name in raw_tables.RAW_TABLES:
        df = spark.read.parquet(os.path.join(raw_dir, f"{name}.parquet"))
        if name == "data_shipment":
            df = df.drop("attempt_result").withColumn("attempt_no", F.col("attempt_no").cast("string"))
        if name == "data_cod":
            df = df.withColumn("cod_amount", F.when(F.col("cod_id") % 2 == 0, "unknown").otherwise(F.col("cod_amount").cast("string")))
        write_table(df, os.path.join(drifted, f"{name}.parquet"))
    rep = pipeline.run(spark, drifted, os.path.join(tmp_root, "wh_drifted"), as_of=catalog.AS_OF, run_at="2001-07-01 06:00:00",
                       checks=catalog.fixture_checks("not_null"), gate_rules=[], raise_on_gate=False, fail_fast=False)
    assert sorted(rep["schema_drift"]) == ["data_cod.cod_amount: type", "data_shipment.attempt_no: type", "data_shipment.attempt_result: missing"]
    assert raw_tables.schema_drift(spark, raw_dir).count() == 0
    whole = spark.read.parquet(os.path.join(raw_dir, "data_shipment.parquet"))
    back = raw_tables.read_raw(spark, drifted, "data_shipment")
    assert back.filter("attempt_result is not null").count() == 0
    assert back.agg(F.sum("attempt_no")).first()[0] == whole.agg(F.sum("attempt_no")).first()[0]
    assert raw_tables.read_raw(spark, drifted, "data_cod").filter("cod_id % 2 = 0 and cod_amount is not null").count() == 0
