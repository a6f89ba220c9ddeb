"""Benchmark: the daily warehouse run at one scale factor.

Setup (not in the headline): derive the 11 raw parcel tables from the test
tables in ``$BENCH_SF_DIR`` and write them as parquet, the way the raw
layer arrives. Timed: the daily run over those files -- build all 11 core
tables and 5 marts (written as parquet), the 89 checks, the SCD2 snapshot
and the gate -- then the report queries over the written marts.

The headline is the first (cold) run in a fresh JVM; a second run in the
same process (warm: JIT and codegen caches filled) is reported next to
it, with per-layer times and input rows. A third run, on the same tables
with every fact row ``$BENCH_GROW`` times (8 by default), separates the cost
of a row from a run's fixed cost. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from hublytics import get_session  # noqa: E402
from hublytics.operators import reports  # noqa: E402
from hublytics.plans import catalog, pipeline  # noqa: E402
from hublytics.plans.warehouse import Warehouse  # noqa: E402
from hublytics.sources.fixtures import fixture_tables  # noqa: E402
from hublytics.sources.raw import RAW_TABLES  # noqa: E402
from hublytics.sources.sinks import read_table, write_table  # noqa: E402


def daily(spark, raw_dir: str, out_dir: str) -> tuple[float, dict]:
    t = time.perf_counter()
    rep = pipeline.run(spark, raw_dir, out_dir, as_of=catalog.AS_OF, run_at="2001-07-01 06:00:00",
                       checks=catalog.fixture_checks(), gate_rules=catalog.FIXTURE_GATE,
                       delivered_error_after=catalog.DELIVERED_REASON_ERROR_AFTER, raise_on_gate=False, fail_fast=False)
    return time.perf_counter() - t, rep


#: columns that identify a row or refer to one in the facts that grow
GROWN = {
    "data_shippingorder_now": ["order_code"],
    "data_inside_history": ["order_code", "package_code", "trip_code"],
    "data_transportation": ["trip_code"],
    "data_shipment": ["order_code", "trip_code"],
    "data_cod": ["order_code"],
}
ROW_GROUP_BYTES = 16 * 1024 * 1024


def grow(spark, raw_dir: str, out_dir: str, times: int) -> None:
    """The raw tables with every fact row ``times`` times, under keys of its
    own; the dimensions stay."""
    for name in RAW_TABLES:
        df = spark.read.parquet(os.path.join(raw_dir, f"{name}.parquet"))
        if name in GROWN:
            df = df.withColumn("__i", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
            df = df.withColumns({c: F.concat(F.col(c), F.lit("-"), F.col("__i").cast("string")) for c in GROWN[name]})
            if name == "data_cod":
                df = df.withColumn("cod_id", F.col("cod_id") * times + F.col("__i"))
            df = df.drop("__i")
        # row groups of about a million rows, as the raw layer's writer makes them: a file of
        # one row group would be one task
        df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(os.path.join(out_dir, f"{name}.parquet"))


def count_rows(spark, raw_dir: str) -> dict[str, int]:
    return {n: spark.read.parquet(os.path.join(raw_dir, f"{n}.parquet")).count() for n in sorted(RAW_TABLES)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    times = int(os.environ.get("BENCH_GROW", "8"))
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    scratch = tempfile.mkdtemp(prefix="bench-", dir=os.environ.get("BENCH_SCRATCH", "/tmp"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus,
                        extra={"spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
                               "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)})
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))

    raw_dir = os.path.join(scratch, "raw")
    t = time.perf_counter()
    for name, df in fixture_tables(spark, sf_dir).items():
        write_table(df, os.path.join(raw_dir, f"{name}.parquet"))
    setup = time.perf_counter() - t
    rows = count_rows(spark, raw_dir)
    raw_rows = sum(rows.values())

    cold, rep = daily(spark, raw_dir, os.path.join(scratch, "wh"))
    warm, rep_warm = daily(spark, raw_dir, os.path.join(scratch, "wh_warm"))

    # the same day on more rows: what a row costs, and what a run costs whatever its rows
    large: dict = {}
    if times > 1:
        big_dir = os.path.join(scratch, "raw_grown")
        grow(spark, raw_dir, big_dir, times)
        big_rows = sum(count_rows(spark, big_dir).values())
        _, rep_big = daily(spark, big_dir, os.path.join(scratch, "wh_grown"))
        steps = ("build", "test", "snapshot", "gate")
        per_row = {k: max(0.0, rep_big["steps"][k] - rep_warm["steps"][k]) / (big_rows - raw_rows) for k in steps}
        large = {
            "raw_rows": big_rows,
            "steps_sec": {k: rep_big["steps"][k] for k in steps},
            "rows_per_sec": {k: round(big_rows / max(rep_big["steps"][k], 1e-3), 1) for k in steps},
            "fixed_sec": {k: round(rep_warm["steps"][k] - per_row[k] * raw_rows, 3) for k in steps},
            "marginal_rows_per_sec": {k: round(1 / per_row[k], 1) if per_row[k] > 0 else None for k in steps},
        }

    # report cards over the written marts
    wh_dir = os.path.join(scratch, "wh")
    marts = {m: read_table(spark, os.path.join(wh_dir, m)) for m in Warehouse.MARTS}
    qtimes = {}
    for name, (mart, fn) in reports.REPORTS.items():
        t = time.perf_counter()
        fn(marts[mart]).collect()
        qtimes[name] = round(time.perf_counter() - t, 3)

    queries = {k.replace("build.", ""): v for k, v in rep["steps"].items()}
    queries.update(qtimes)
    layers = lambda r: {k: v for k, v in r["steps"].items()
                        if k.startswith("level.") or k in ("build", "test", "snapshot", "gate")}
    out = {
        "metric": "daily_run_sec",
        "value": round(cold, 3),
        "unit": "sec",
        "queries": queries,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "warm_daily_run_sec": round(warm, 3),
        "layers_cold": layers(rep),
        "layers_warm": layers(rep_warm),
        "setup_raw_sec": round(setup, 3),
        "raw_rows": raw_rows,
        "raw_rows_by_table": rows,
        "grown": large,
        "rows_per_sec_cold": round(raw_rows / cold, 1),
        "rows_per_sec_warm": round(raw_rows / warm, 1),
        "tests": rep["tests"],
        "gate_error": rep["gate_error"],
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
