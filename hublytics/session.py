"""SparkSession construction with the settings the warehouse relies on."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every run needs, whatever the cluster:
#  * UTC session zone: warehouse timestamps are zone-less (TIMESTAMP_NTZ);
#    the few places that need epoch seconds cast through the session zone.
#  * ANSI mode stays on (the Spark 4 default): bad casts fail loudly; the
#    cleaning layer uses try_cast only where a bad value must become NULL.
#  * AQE: runtime coalescing of shuffle partitions and skew-join splitting.
#  * Raw generators write pandas nanosecond timestamps; read them as longs.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    "spark.sql.parquet.compression.codec": "snappy",
}

# For writes of tables with many computed columns. Spark fuses all of a stage's
# expressions into one method, and the JVM never compiles a method of more than
# 8000 bytes: such stages run interpreted. Up to this limit they are fused, beyond it
# each expression is a method of its own. Shared parts of expressions are not lifted
# out either: lifted, they end up in one such method again.
WIDE_CONF = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.subexpressionElimination.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "hublytics", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with :data:`CORE_CONF` applied.

    ``master`` is only set when given, so on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        # local runs: no UI server, driver is the only JVM
        builder = builder.config("spark.ui.enabled", "false")
    for k, v in CORE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of :data:`CORE_CONF` to a session
    someone else built (e.g. the verification driver's)."""
    for k, v in CORE_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)  # all of them can be set at run time; a refusal is an error


@contextmanager
def wide_rows(spark: SparkSession) -> Iterator[None]:
    """:data:`WIDE_CONF` for the writes inside; the session's own settings come
    back at the end. It changes how expressions are compiled, never their values."""
    before = {k: spark.conf.get(k, None) for k in WIDE_CONF}
    for k, v in WIDE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can
    reach; it is read from the session and never overridden. Only a local
    session (tests) without it gets a fresh scratch folder; a cluster session
    without it is an error, since a machine-local folder is not shared.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        try:
            current = spark.sparkContext.getCheckpointDir()
        except Exception:  # no SparkContext (e.g. a remote session)
            current = None
    if current:
        return current
    try:
        master = spark.sparkContext.master
    except Exception:
        master = ""
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: set it to a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="hublytics-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local
