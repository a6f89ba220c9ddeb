"""Ranked lexical search: dense products of item tiles and document tiles.

Every item's score of a document is a sum over the item's terms of a weight
(from the number of documents holding the term) times an impact (from the
term's count in the document and the document's length). Items are tiles of
ITEM_TILE with a compact vocabulary, the terms of the tile's items alone: a
0 / weight matrix (terms x items). Documents are tiles too: a matrix of
impacts (documents x terms). Their product in doubles (BLAS) gives the scores
of the tile. Weights and impacts are whole numbers; terms are taken in runs
short enough that no partial sum reaches 2^53, so every sum is exact, and runs
are added as 64-bit integers. From each tile the K best of every item are
kept, all equal scores at the edge included until ids decide.

How it runs: items are dealt by hash to blocks of about BLOCK_PAIRS (item,
term) pairs, so a block's vocabulary has a bounded size and travels with the
tasks. For each block the documents are scanned twice without a shuffle: once
for the statistics (documents, terms, and documents holding each vocabulary
term: one number a term and task), once for the scores, where a task returns at
most K rows an item. Those are ranked in two steps (SALTS parts of an item,
then the item), so no task gets all rows of an item.

A term is a longest run of characters other than ASCII ones that are not
letters or digits, with A-Z (no other letter) in lower case.

Defined cases: null texts and texts without terms count nowhere and score
nothing; a null doc_id ranks after all others and is returned as null (the id
2^63-1 reads as null); rows that repeat a doc_id are documents of their own;
items without terms, null items, empty tables give no rows; rows of the items
that repeat an item_id are items of their own. Further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hublytics.llm.best import LAST, Best
from hublytics.llm.common import cut, slices

K = 50
ITEM_TILE = 64
#: doubles in a tile of documents
TILE = 1 << 21
BLOCK_PAIRS = 1 << 17
SALTS = 64
EXACT = 2 ** 53
#: impacts are below it: tf / (tf + something positive) in millionths
IMPACT = 10 ** 6


def _separators() -> bytes:
    """A byte table: ASCII letters in lower case, digits and bytes beyond ASCII
    as they are, everything else a space."""
    out = bytearray(b" " * 128) + bytearray(range(128, 256))
    for c in range(128):
        if chr(c).isalnum():
            out[c] = ord(chr(c).lower())
    return bytes(out)


_TABLE = _separators()


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def _item_terms(batches):
    for b in slices(batches):
        rows, items, found = [], [], []
        for row, item, text in zip(*(c.to_pylist() for c in (b.column(0), b.column(1), b.column(2).cast(pa.binary()))), strict=True):
            distinct = sorted(set(terms(text or b"")))
            rows += [row] * len(distinct)
            items += [item] * len(distinct)
            found += distinct
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(items, pa.int64()), pa.array(found, pa.binary())],
                                         ["row", "item_id", "term"])


def _tallies(texts: list[bytes], vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Number of terms of each text; counts (texts x vocabulary)."""
    total, found, lengths = [], [], []
    for t in texts:
        words = terms(t)
        total.append(len(words))
        known = [vocabulary[w] for w in words if w in vocabulary]
        found += known
        lengths.append(len(known))
    width = max(len(vocabulary), 1)
    cell = np.repeat(np.arange(len(texts)) * width, lengths) + np.array(found, np.int64)
    return np.array(total, np.int64), np.bincount(cell, minlength=len(texts) * width).reshape(len(texts), width)


def _texts(b: pa.RecordBatch, column: int) -> list[bytes]:
    return [t or b"" for t in b.column(column).cast(pa.binary()).to_pylist()]


def _rows_a_tile(vocabulary: dict) -> int:
    return max(1, min(512, TILE // max(len(vocabulary), 1)))


def _statistics(vocabulary: dict[bytes, int]):
    """Rows (term, n) of a task: documents holding a term; -1: documents with
    a term; -2: terms of all documents."""
    def run(batches):
        docs = size = 0
        holding = np.zeros(max(len(vocabulary), 1), np.int64)
        for b in slices(batches, _rows_a_tile(vocabulary)):
            total, counts = _tallies(_texts(b, 0), vocabulary)
            docs, size = docs + int((total > 0).sum()), size + int(total.sum())
            holding += (counts > 0).sum(axis=0)
        some = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays([pa.array([-1, -2, *some], pa.int64()), pa.array([docs, size, *holding[some]], pa.int64())],
                                         ["term", "n"])
    return run


def _impacts(counts: np.ndarray, total: np.ndarray, docs: int, size: int) -> np.ndarray:
    """Whole-number impacts as doubles."""
    if 50 * int(total.max(initial=0)) * docs < 2 ** 63:
        m = 50 + 50 * total * docs // max(size, 1)
    else:  # whole numbers without a limit, then back
        m = np.array([50 + 50 * int(n) * docs // max(size, 1) for n in total], np.int64)
    row, col = np.nonzero(counts)
    tf = counts[row, col]
    out = np.zeros(counts.shape)
    out[row, col] = 10 ** 9 * tf // (1000 * tf + 20 * m[row])
    return out


def _tiles(item: np.ndarray, term: np.ndarray, weight: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(items, their terms, weights terms x items) of ITEM_TILE items each."""
    out = []
    for at in range(0, int(item.max(initial=-1)) + 1, ITEM_TILE):
        mine = (item >= at) & (item < at + ITEM_TILE)
        who, i = np.unique(item[mine], return_inverse=True)
        cols, t = np.unique(term[mine], return_inverse=True)
        w = np.zeros((len(cols), len(who)))
        w[t, i] = weight[cols[t]]
        out.append((who, cols, w))
    return out


def _scores(impacts: np.ndarray, cols: np.ndarray, w: np.ndarray) -> np.ndarray:
    """documents x items, exact."""
    run = max(1, EXACT // (IMPACT * max(int(w.max(initial=1)), 1)) - 1)
    out = np.zeros((len(impacts), w.shape[1]), np.int64)
    for at in range(0, len(cols), run):
        out += (impacts[:, cols[at: at + run]] @ w[at: at + run]).astype(np.int64)
    return out


def _search(vocabulary: dict[bytes, int], item: np.ndarray, term: np.ndarray, weight: np.ndarray, docs: int, size: int, k: int):
    def run(batches):
        tiles = _tiles(item, term, weight)
        best = Best(int(item.max(initial=-1)) + 1, k)
        for b in slices(batches, _rows_a_tile(vocabulary)):
            ids = b.column(0).fill_null(LAST).to_numpy(zero_copy_only=False)
            total, counts = _tallies(_texts(b, 1), vocabulary)
            impacts = _impacts(counts, total, docs, size)
            for who, cols, w in tiles:
                score = _scores(impacts, cols, w).T
                best.offer(who, score, ids, score > 0)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in (best.who, best.score, best.id)], ["item", "score", "id"])
    return run


def _block(docs: DataFrame, pairs: pa.Table, k: int) -> DataFrame:
    """item_row, item_id, rank, doc_id, score of one block of items."""
    spark = docs.sparkSession
    known = sorted(set(pairs.column("term").to_pylist()))
    vocabulary = {t: i for i, t in enumerate(known)}
    rows, item = np.unique(pairs.column("row").to_numpy(), return_inverse=True)
    item_ids = dict(zip(pairs.column("row").to_pylist(), pairs.column("item_id").to_pylist(), strict=True))
    term = np.array([vocabulary[t] for t in pairs.column("term").to_pylist()], np.int64)
    counted = docs.select("text").mapInArrow(_statistics(vocabulary), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r.term: r.n for r in counted.collect()}  # a row a vocabulary term
    n, size = found.get(-1, 0), found.get(-2, 0)
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * found.get(i, 0) + 1))) for i in range(len(known))], np.float64)
    hits = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _search(vocabulary, item, term, weight, n, size, k), "item long, score long, id long")
    salted = hits.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    for part in (["item", "salt"], ["item"]):
        order = Window.partitionBy(*part).orderBy(F.desc("score"), "id")
        salted = salted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, int(r), item_ids[int(r)]) for i, r in enumerate(rows)], "item long, item_row long, item_id long")
    return salted.join(F.broadcast(names), "item").select(
        "item_row", "item_id", "rank", F.when(F.col("id") < LAST, F.col("id")).alias("doc_id"), "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """item_id, rank, doc_id, score, item_row: the ``k`` best rows of ``docs``
    (doc_id, text) with a score above 0 for every row of ``items`` (item_id,
    text)."""
    numbered = items.select(F.monotonically_increasing_id().alias("row"), F.col("item_id").cast("long").alias("item_id"), "text")
    pairs = cut(numbered.mapInArrow(_item_terms, "row long, item_id long, term binary"), "lexical-items")
    blocks = -(-pairs.count() // block_pairs)
    found = []
    for b in range(blocks):
        mine = pairs.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).toArrow()  # about block_pairs rows
        if mine.num_rows:
            hits = _block(docs, mine, k)
            found.append(hits if blocks == 1 else cut(hits, "lexical-block"))
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long, item_row long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select("item_id", "rank", "doc_id", "score", "item_row")
