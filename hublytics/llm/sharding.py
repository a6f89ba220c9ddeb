"""Sharding by proportional stratified interleaving (DataFrame functions only).

Inside each source the rows are put into a seeded random order; a row's
fractional rank is (rank + 1/2) / rows of the source. Sorting all rows by
that fraction interleaves the sources in proportion, and cutting the sorted
order into equal runs gives shards that each hold the corpus' mixture, with
counts at most one apart (law ``rows``).

How it runs: no source and no global order is ever one task. The shuffle key
is hex text, so its leading digits are an order-preserving, even bucket:
ranks are taken inside (source, bucket) and shifted by the rows of earlier
buckets. Fractional ranks are spread evenly over [0, 1) whatever the sources'
sizes, so equal slices of that range hold equal shares of all rows; global
positions are taken inside a slice and shifted the same way.

Defined cases: null text has no bytes (size 16) and the checksum of empty
bytes; a null source is the source ''; equal shuffle keys (repeated doc_id)
are ordered by checksum and size, and rows that agree on all of these are
interchangeable; fewer rows than shards leave shards empty; an empty table
gives no rows. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hublytics.llm.common import cut, positions, text_or_empty

SHARDS = 40
SEED = "shard-1"
#: rows meant for a bucket: the plan gets more buckets with more rows, the result is the same
BUCKET_ROWS = 200_000
#: bytes counted for a row besides its text
ROW_OVERHEAD = 16


def shuffle_key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def shard(docs: DataFrame, shards: int = SHARDS, seed: str = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, source, size, text_crc32, law, shard, slot, grown_shard."""
    body = text_or_empty().cast("binary")
    rows = docs.select(
        F.col("doc_id"), F.coalesce(F.col("source"), F.lit("")).alias("source"),
        (F.octet_length(body) + ROW_OVERHEAD).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        shuffle_key(F.col("doc_id"), seed).alias("key"))
    rows = cut(rows, "shard-rows")
    total = rows.count()
    slices = 16
    while slices * bucket_rows < total:
        slices *= 16
    rows = rows.withColumn("bucket", F.substring("key", 1, len(f"{slices:x}") - 1))

    ranked = positions(rows, ["source"], "bucket", ["key", "text_crc32", "size"], "rank")
    sizes = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    ranked = ranked.join(sizes, "source").withColumn("fraction", (F.col("rank") + 0.5) / F.col("n"))
    ranked = cut(ranked.withColumn("slice", F.floor(F.col("fraction") * slices)), "shard-ranks")

    placed = positions(ranked, [], "slice", ["fraction", "source", "rank"], "pos")
    placed = placed.withColumn("shard", F.expr(f"(pos * {shards}) div {max(total, 1)}").cast("int"))
    first = F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")
    return placed.select(
        "doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("pos") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
