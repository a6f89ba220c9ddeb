"""Sinks: published tables, snapshot versions, exports, scratch tables.

A published table is a folder of versions (``v=000001``, ``v=000002``, ...).
A refresh writes a folder of its own and renames it to the next version when
every file is there; readers take the newest complete version. So a reader sees
the whole old table or the whole new one, a failed refresh leaves the old one,
and nothing that a reader has open is overwritten: the ``keep`` newest
versions stay.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hublytics.session import checkpoint_dir

#: versions of a published table that stay readable
KEEP_VERSIONS = 2


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                compression: str = "snappy") -> None:
    """One folder of snappy parquet, written over (exports, files that nobody
    reads meanwhile)."""
    w = df.write.mode("overwrite").option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back: its
    lineage ends and its size is known. The folder's owner expires old files."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/hublytics/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class TableError(RuntimeError):
    """A published table could not be read or refreshed."""


def publish_table(df: DataFrame, path: str, partition_by: list[str] | None = None, compression: str = "snappy",
                  keep: int = KEEP_VERSIONS) -> str:
    """Full refresh of the published table at ``path``; returns the folder of
    the new version. Of two refreshes at once the later rename is the newer."""
    spark = df.sparkSession
    tmp = f"{path.rstrip('/')}/_writing-{uuid.uuid4().hex}"
    fs, source = _folder(spark, tmp)
    try:
        write_table(df, tmp, partition_by, compression)
        version = _claim(spark, path, tmp)
    finally:
        if fs.exists(source):
            fs.delete(source, True)
    for old in complete_versions(spark, path)[:-max(keep, 1)]:
        fs.delete(_folder(spark, version_path(path, old))[1], True)
    return version_path(path, version)


def _claim(spark: SparkSession, path: str, tmp: str, attempts: int = 20) -> int:
    """Rename ``tmp`` to the next free version of ``path``."""
    fs, source = _folder(spark, tmp)
    for _ in range(attempts):
        version = max(_versions(spark, path), default=0) + 1
        target = _folder(spark, version_path(path, version))[1]
        if fs.exists(target) or not fs.rename(source, target):
            continue  # another refresh took the number
        nested = _folder(spark, f"{version_path(path, version)}/{tmp.rsplit('/', 1)[1]}")[1]
        if not fs.exists(nested):
            return version
        # the store put this folder inside the one that another refresh had just put there
        if not fs.rename(nested, source):
            break
    raise TableError(f"{path}: no version could be claimed")


def newest_path(spark: SparkSession, path: str) -> str:
    done = complete_versions(spark, path)
    if not done:
        raise TableError(f"{path} has no complete version")
    return version_path(path, done[-1])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version of a published table."""
    return spark.read.parquet(newest_path(spark, path))


def plain_path(spark: SparkSession, path: str) -> str:
    """``path`` as its store names it."""
    fs, p = _folder(spark, path)
    return fs.makeQualified(p).toString()


def parent_path(spark: SparkSession, path: str) -> str:
    return plain_path(spark, path.rstrip("/").rsplit("/", 1)[0]) if "/" in path else ""


class SnapshotError(RuntimeError):
    """A snapshot folder is not what a run expects to find."""


def _folder(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path): the store that Spark itself writes to."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, base: str) -> list[int]:
    fs, root = _folder(spark, base)
    if not fs.exists(root):
        return []
    names = [entry.getPath().getName() for entry in fs.listStatus(root)]
    return sorted(int(n[2:]) for n in names if n.startswith("v="))


def complete_versions(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the finished versions under ``base``, oldest first. A folder
    that is not there has none; every other failure to read it is raised."""
    fs, _ = _folder(spark, base)
    return [v for v in _versions(spark, base) if fs.exists(_folder(spark, f"{version_path(base, v)}/_SUCCESS")[1])]


def version_path(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/v={version:06d}"


def write_version(spark: SparkSession, df: DataFrame, base: str, version: int) -> str:
    """Publish ``df`` as version ``version`` of the snapshot in ``base``.

    ``df`` was built on version ``version - 1``, which must still be the newest
    one. The rows are written to a folder of their own and renamed into place
    when they are complete, so a half-written version is never seen, no
    version is ever overwritten, and there is no pointer to lose. A run that
    another one has overtaken raises :class:`SnapshotError`."""
    fs, target = _folder(spark, version_path(base, version))
    tmp = f"{base.rstrip('/')}/_writing-{uuid.uuid4().hex}"
    _, source = _folder(spark, tmp)

    def check() -> None:
        done = complete_versions(spark, base)
        if (done[-1] if done else 0) != version - 1:
            raise SnapshotError(f"{base}: version {version} follows {version - 1}, but the newest is {done[-1] if done else None}")

    check()
    df.write.option("compression", "snappy").parquet(tmp)
    try:
        check()
        if fs.exists(target):  # left over from a write that never finished
            fs.delete(target, True)
        if not fs.rename(source, target):
            raise SnapshotError(f"{target} could not be put in place")
        # where two runs rename at once, some stores put the later folder inside the first
        nested = _folder(spark, f"{version_path(base, version)}/{tmp.rsplit('/', 1)[1]}")[1]
        if fs.exists(nested):
            fs.delete(nested, True)
            raise SnapshotError(f"{base}: another run published version {version}")
    finally:
        if fs.exists(source):
            fs.delete(source, True)
    return version_path(base, version)


def current_version(spark: SparkSession, base: str) -> int | None:
    done = complete_versions(spark, base)
    return done[-1] if done else None


def _runs(spark: SparkSession, base: str) -> DataFrame | None:
    """The rows of all complete versions: every run's changes."""
    done = complete_versions(spark, base)
    if not done:
        return None
    return spark.read.option("basePath", base).parquet(*[version_path(base, v) for v in done]).drop("v")


def _still_open(rows: DataFrame, closed_at: str, row_id: str) -> DataFrame:
    closed = rows.filter(F.col(closed_at).isNotNull()).select(F.col(row_id).alias("__closed"))
    return rows.filter(F.col(closed_at).isNull()).join(closed, F.col(row_id) == F.col("__closed"), "left_anti")


def read_open(spark: SparkSession, base: str, closed_at: str = "valid_to", row_id: str = "scd_id") -> DataFrame | None:
    """The rows that no run has closed; None if there is no version."""
    rows = _runs(spark, base)
    return None if rows is None else _still_open(rows, closed_at, row_id)


def read_history(spark: SparkSession, base: str, closed_at: str = "valid_to", row_id: str = "scd_id") -> DataFrame | None:
    """The whole history: every closed row as its run closed it, and the rows
    still open."""
    rows = _runs(spark, base)
    return None if rows is None else rows.filter(F.col(closed_at).isNotNull()).unionByName(_still_open(rows, closed_at, row_id))
