"""The daily run: build -> test -> snapshot -> gate.

1. **build**: every core table, then every mart, is published as snappy
   parquet under ``out_dir`` (full refresh by a new version, see
   :mod:`hublytics.sources.sinks`). Each published table replaces
   its lineage in the :class:`Warehouse`, so the three marts over the order
   fact read the written fact instead of recomputing staging + dedup, and
   a lost executor only recomputes from the last written table.
2. **test**: the check catalogue plus the two business rules, over the
   written tables; results are written too.
3. **snapshot**: SCD2 merge of the client dimension into a new version
   folder of the snapshot table (the version being read is never
   overwritten; a pointer file names the current version).
4. **gate**: row-count / NULL-key rule per mart; raises on failure.

Staging models stay lazy views, as in the reference.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hublytics.operators import history, quality
from hublytics.plans.warehouse import Warehouse
from hublytics.sources.raw import SEED_SCHEMAS, read_raw_tables, read_seed, schema_drift
from hublytics.sources.sinks import current_version, publish_table, read_open, read_table, write_version

SNAPSHOT_KEY = "client_id"
SNAPSHOT_CHECK = ["tier", "client_channel", "is_b2b"]
SNAPSHOT_PAYLOAD = ["client_id", "shop_id", "client_type", "client_channel", "tier", "is_b2b", "region",
                    "province_name"]


class Timer:
    def __init__(self):
        self.steps: dict[str, float] = {}

    def __call__(self, name: str, fn: Callable):
        t = time.perf_counter()
        out = fn()
        self.steps[name] = round(time.perf_counter() - t, 3)
        return out


# Build order: each level only reads models of earlier levels, so the
# models of one level are written concurrently (Spark runs jobs submitted
# from several driver threads side by side). Within a level the largest
# models come first, so the longest jobs start without waiting for a thread.
LEVELS = [
    ["dim_client", "dim_warehouse", "dim_date", "dim_district", "dim_province"],
    ["fct_shipment", "fct_shipping_order", "fct_inside_history", "fct_cod", "fct_transportation", "dim_shipper"],
    ["mart_sla_breakdown", "mart_failure_reasons", "mart_hub_performance", "mart_daily_kpi",
     "mart_cod_reconciliation"],
]
LEVEL_NAMES = ["dims", "facts", "marts"]
ROW_LOCAL_TESTS = ("not_null", "accepted_values")


def build(spark: SparkSession, wh: Warehouse, out_dir: str, timer: Timer | None = None,
          models: list[str] | None = None, threads: int = 4,
          observe: list[tuple[int, quality.Check]] | None = None) -> dict[int, int]:
    """Write every core table and mart, level by level; within a level up to
    ``threads`` models are written at once.

    ``observe`` lists (id, check) pairs of row-local checks (not_null,
    accepted_values) on built models: their failure counts are computed by
    the write job itself (``DataFrame.observe``), so those checks cost no
    extra scan. Returns ``{check id: failures}``.
    """
    timer = timer or Timer()
    wanted = set(models or (Warehouse.CORE + Warehouse.MARTS))
    observed: dict[int, int] = {}
    for li, level in enumerate(LEVELS):
        t_level = time.perf_counter()
        names = [n for n in level if n in wanted]
        # plans are built on the calling thread; only the writes run in parallel
        plans, observations = {}, {}
        for n in names:
            df = wh[n]
            mine = [(i, c) for i, c in (observe or []) if c.model == n and c.test in ROW_LOCAL_TESTS]
            if mine:
                obs = Observation(f"dq_{n}_{uuid.uuid4().hex}")
                df = df.observe(obs, *[F.expr(quality.count_expr(c)).alias(f"c{i}") for i, c in mine])
                observations[n] = (obs, mine)
            plans[n] = df
        paths = {n: os.path.join(out_dir, n) for n in names}

        def write(n: str) -> None:
            timer(f"build.{n}", lambda: publish_table(plans[n], paths[n]))

        with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
            # the order fact needs to know its repeated codes; found beside the dimensions
            keys = pool.submit(wh.newest_orders) if li == 0 and "fct_shipping_order" in wanted else None
            list(pool.map(write, names))
            if keys:
                keys.result()
        for n, (obs, mine) in observations.items():
            got = obs.get
            observed.update({i: int(got[f"c{i}"]) for i, _ in mine})
        for n in names:
            wh.replace(n, read_table(spark, paths[n]))
        timer.steps[f"level.{LEVEL_NAMES[li]}"] = round(time.perf_counter() - t_level, 3)
    return observed


def test(spark: SparkSession, wh: Warehouse, out_dir: str, checks: list[quality.Check],
         delivered_error_after: int | float = 5000, observed: dict[int, int] | None = None) -> DataFrame:
    """Run the check catalogue and the two business rules.

    Checks already measured during the build (``observed``) are not run
    again; all others are one job (:func:`quality.run_checks`) that scans each
    model once. It returns one row per check.
    """
    observed = observed or {}

    def resolve(layer: str, model: str) -> DataFrame:
        if layer == "source":
            return wh.raw[model]
        if layer == "seed":
            return read_seed(spark, model)
        return wh[model]

    rest = [(i, c) for i, c in enumerate(checks) if i not in observed]
    rows = [(i, c.layer, c.model, c.column, c.test, f, quality.status_of(f, c.severity))
            for i, c in enumerate(checks) if i in observed for f in [observed[i]]]
    if rest:
        found = quality.run_checks(spark, resolve, [c for _, c in rest])
        rows += [(rest[r["check_id"]][0],) + tuple(r)[1:] for r in found.collect()]
    res = spark.createDataFrame(rows, "check_id int, layer string, model string, column_name string, "
                                      "test string, failures long, status string")
    rules = quality.rule_results(spark, wh["fct_cod"], wh["fct_shipping_order"],
                                 delivered_error_after=delivered_error_after)
    n = len(checks)
    singular = rules.select(
        F.when(F.col("rule") == "assert_cod_discrepancy_math", n).otherwise(n + 1).alias("check_id"),
        F.lit("singular").alias("layer"),
        F.when(F.col("rule") == "assert_cod_discrepancy_math", "fct_cod").otherwise("fct_shipping_order")
         .alias("model"),
        F.lit(None).cast("string").alias("column_name"), F.col("rule").alias("test"), "failures", "status")
    path = os.path.join(out_dir, "_test_results")
    publish_table(res.unionByName(singular).coalesce(1), path)
    return read_table(spark, path)


def snapshot(spark: SparkSession, wh: Warehouse, out_dir: str, run_at: str) -> str:
    base = os.path.join(out_dir, "snap_client_tier")
    version = current_version(spark, base) or 0
    src = wh["dim_client"].select(*SNAPSHOT_PAYLOAD)
    delta = history.changes(src, SNAPSHOT_KEY, SNAPSHOT_CHECK, run_at, read_open(spark, base))
    return write_version(spark, delta, base, version + 1)


def seed(spark: SparkSession, out_dir: str) -> None:
    """Write the seeds as tables, typed as declared."""
    for name in SEED_SCHEMAS:
        publish_table(read_seed(spark, name).coalesce(1), os.path.join(out_dir, name))


def run(spark: SparkSession, raw_dir: str, out_dir: str, as_of: str | None = None, run_at: str | None = None,
        checks: list[quality.Check] | None = None, gate_rules: list[quality.GateRule] | None = None,
        delivered_error_after: int | float = 5000, raise_on_gate: bool = True, threads: int = 4,
        fail_fast: bool = True) -> dict:
    """Run the whole day; returns step timings and the test summary.

    The chain is seed, build, test, snapshot, gate. A check at ERROR stops it
    before the snapshot; with ``fail_fast=False`` every step runs and the
    report carries the check outcomes."""
    timer = Timer()
    raw = read_raw_tables(spark, raw_dir)
    found = schema_drift(spark, raw_dir)
    publish_table(found.coalesce(1), os.path.join(out_dir, "_schema_drift"))
    wh = Warehouse(raw, as_of=as_of, ordered_marts=False)
    checks = checks or quality.catalogue()
    built = set(Warehouse.CORE + Warehouse.MARTS)
    row_local = [(i, c) for i, c in enumerate(checks)
                 if c.layer in ("core", "mart") and c.model in built and c.test in ROW_LOCAL_TESTS]
    timer("seed", lambda: seed(spark, out_dir))
    observed = timer("build", lambda: build(spark, wh, out_dir, timer, threads=threads, observe=row_local))
    run_at = run_at or time.strftime("%Y-%m-%d %H:%M:%S")
    rules = gate_rules or quality.GATE_RULES

    def run_tests() -> DataFrame:
        return timer("test", lambda: test(spark, wh, out_dir, checks, delivered_error_after, observed))

    def run_gate() -> str | None:
        try:
            timer("gate", lambda: quality.gate(lambda m: wh[m], rules))
            return None
        except ValueError as e:
            return str(e)

    def summarize(results: DataFrame) -> dict:
        return {r["status"]: r["n"] for r in
                results.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}

    for m in ["dim_client"] + Warehouse.MARTS:  # plans built on this thread before fanning out
        wh[m]
    if fail_fast:
        results = run_tests()
        summary = summarize(results)
        if summary.get("ERROR"):
            failed = [f"{r['model']}.{r['column_name']} {r['test']}: {r['failures']}"
                      for r in results.filter(F.col("status") == "ERROR").collect()]  # one row per check
            raise ValueError("checks at ERROR:\n" + "\n".join(failed))
        path = timer("snapshot", lambda: snapshot(spark, wh, out_dir, run_at))
        gate_error = run_gate()
    else:
        # snapshot and gate do not read the check results: run all three at once
        with ThreadPoolExecutor(max_workers=3) as pool:
            f_test = pool.submit(run_tests)
            f_snap = pool.submit(lambda: timer("snapshot", lambda: snapshot(spark, wh, out_dir, run_at)))
            f_gate = pool.submit(run_gate)
            summary, path, gate_error = summarize(f_test.result()), f_snap.result(), f_gate.result()
    if gate_error and raise_on_gate:
        raise ValueError(gate_error)
    drifted = [f"{r['table_name']}.{r['column_name']}: {r['finding']}" for r in found.collect()]  # columns, not rows
    return {"steps": timer.steps, "tests": summary, "snapshot": path, "gate_error": gate_error, "schema_drift": drifted}
