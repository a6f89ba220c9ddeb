"""Exact dedup by deterministic block naming.

A normalised text is cut into blocks of a fixed number of bytes. Level 0
sorts the distinct blocks and gives each an integer name; every further level
pairs adjacent names of a document, (0,1), (2,3), ..., sorts the distinct
pairs and names those, until each document is one name. Two documents get the
same (level, name) exactly when their normalised texts are identical: a name
stands for one content, never for a hash of it.

How it runs:

* Level 0 ships each distinct block once per map task (partial aggregation),
  not once per document, so a block shared by a third of all rows is small.
  The way back from a block to its name uses a 64-bit routing key, so that
  documents' contents are not shuffled a second time. Blocks that share a
  routing key keep separate names and are matched on their content (``clash``).
* Pairs are two integers; distinct pairs are aggregated map-side as well.
* The joins back to the documents read written tables on both sides, so AQE
  can split a hot block, pair or group of copies over several tasks.

Defined cases: null text is the empty text, and all empty texts are equal;
of equal texts the longest original stays, then the smallest doc_id (null
last), then an arbitrary one of wholly repeated rows, so exactly one row of
each group stays. Further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hublytics.llm.common import cut, text_or_empty, without_space
from hublytics.operators.joins import bounded_broadcast

BLOCK_BYTES = 4096


def route(block: Column) -> Column:
    return F.xxhash64(block)


def _occurrences(docs: DataFrame, block_bytes: int, key) -> DataFrame:
    """One row per block: the row's key and facts, position, content, route."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id"),
        F.length(text_or_empty()).cast("long").alias("n_cp"),
        without_space(text_or_empty()).cast("binary").alias("body"))
    rows = rows.withColumns({
        "sha": F.sha2("body", 256),
        "blocks": F.greatest(F.lit(1), F.ceil(F.octet_length("body") / F.lit(block_bytes))).cast("int")})
    parts = F.expr(f"transform(sequence(0, blocks - 1), i -> substring(body, i * {block_bytes} + 1, {block_bytes}))")
    rows = rows.select("row", "doc_id", "n_cp", "sha", "blocks", F.posexplode(parts).alias("pos", "block"))
    return rows.withColumn("route", key(F.col("block")))


def _named_blocks(occ: DataFrame) -> DataFrame:
    """(route, name, clash, block): a name for every distinct block; the block
    itself only where two contents share a route."""
    sets = occ.groupBy("route").agg(F.collect_set("block").alias("contents"))
    each = sets.select("route", (F.size("contents") > 1).alias("clash"), F.explode("contents").alias("block"))
    # sorted inside each partition, so a re-run of a task gives the same names
    named = each.sortWithinPartitions("block").withColumn("name", F.monotonically_increasing_id())
    return named.select("route", "name", "clash", F.when(F.col("clash"), F.col("block")).alias("block"))


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES, key=route) -> DataFrame:
    """(row, doc_id, n_cp, sha, level, name): ``(level, name)`` is equal for
    two rows exactly when their normalised texts are equal."""
    facts = ["doc_id", "n_cp", "sha"]
    occ = _occurrences(docs, block_bytes, key)
    names = cut(_named_blocks(occ), "block-names")
    slim = occ.withColumn("facts", F.when(F.col("pos") == 0, F.struct(*facts)))
    level = slim.drop("block").join(names.where(~F.col("clash")).select("route", "name"), "route")
    level = level.select("row", "facts", "blocks", "pos", "name")
    if names.where("clash").limit(1).count():
        exact = slim.join(names.where("clash").select("route", "block", "name"), ["route", "block"])
        level = level.unionByName(exact.select(*level.columns))
    level = cut(level, "names-0")
    done = [level.where("blocks = 1").select("row", "facts", F.lit(0).alias("level"), "name")]
    most = level.agg(F.max("blocks")).first()[0] or 1
    depth = 0
    while most > 1:
        depth, most = depth + 1, (most + 1) // 2
        even = F.col("pos") % 2 == 0
        pairs = (level.where("blocks > 1")
                 .groupBy("row", F.shiftright("pos", 1).alias("pos"))
                 .agg(F.max("facts").alias("facts"),
                      F.max(F.ceil(F.col("blocks") / 2).cast("int")).alias("blocks"),
                      F.max(F.when(even, F.col("name"))).alias("a"),
                      # a name is never negative: -1 says that the last one has no partner
                      F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1).cast("long")).alias("b")))
        pairs = cut(pairs, f"pairs-{depth}")
        named = (pairs.select("a", "b").distinct().sortWithinPartitions("a", "b")
                 .withColumn("name", F.monotonically_increasing_id()))
        level = pairs.join(cut(named, f"pair-names-{depth}"), ["a", "b"])
        level = level.select("row", "facts", "blocks", "pos", "name")
        done.append(level.where("blocks = 1").select("row", "facts", F.lit(depth).alias("level"), "name"))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("row", "facts.*", "level", "name")


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES, key=route) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256 (of the normalised text), n_chars (of the original)."""
    ids = cut(identities(docs, block_bytes, key), "identities")
    best = F.min(F.struct((-F.col("n_cp")).alias("n"), F.col("doc_id").isNull().alias("u"), "doc_id", "row"))
    groups = cut(ids.groupBy("level", "name").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size")), "groups")
    out = ids.join(groups, ["level", "name"])
    return out.select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
                      (F.col("row") == F.col("best.row")).alias("kept"),
                      F.col("sha").alias("text_sha256"), F.col("n_cp").alias("n_chars"))


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that :func:`exact_dedup` drops; all columns
    stay. The rows are numbered and written once, so that only the numbers of
    dropped rows go back to them: texts are not shuffled where these numbers fit
    a broadcast."""
    numbered = cut(docs.withColumn("__row", F.monotonically_increasing_id()), "exact-docs")
    own = numbered.select(F.struct(F.col("doc_id").isNull().alias("u"), "doc_id", "__row").alias("doc_id"), "text")
    dropped = cut(exact_dedup(own, **options).where(~F.col("kept")).select(F.col("doc_id.__row").alias("__gone")), "exact-dropped")
    left = numbered.join(bounded_broadcast(dropped), F.col("__row") == F.col("__gone"), "left_anti")
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])
