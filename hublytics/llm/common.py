"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hublytics.session import checkpoint_dir

#: the white space of the text contracts: space, tab, LF, VT, FF, CR
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back.

    This ends the lineage (a lost executor costs a re-read, not a re-run of
    everything before) and lets several readers share one computation. The
    folder's owner expires old files; nothing here is reused across runs.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/hublytics-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table of :func:`cut` that has been read for the last time."""
    files = table.inputFiles()
    folder = files[0].rsplit("/", 1)[0] if files else ""
    if "/hublytics-llm/" in folder:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def slices(batches, rows: int = 512):
    """Arrow batches in pieces of at most ``rows`` rows, so that what a task
    makes of a batch stays small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def without_space(text: Column) -> Column:
    return F.regexp_replace(text, SPACE + "+", "")


def positions(df: DataFrame, group: list[str], bucket: str, order: list[str], out: str) -> DataFrame:
    """0-based position of each row inside ``group`` (all rows if empty) in
    (bucket, order): position in the bucket plus rows of earlier buckets."""
    counts = df.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*(group or [F.lit(0)])).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, bucket, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*group, bucket).orderBy(*order)
    local = df.withColumn("__at", F.row_number().over(inside) - 1)
    joined = local.join(offsets, [*group, bucket])
    return joined.withColumn(out, F.col("__before") + F.col("__at")).drop("__before", "__at")
