"""Hard negatives by lists that the anchors of a cluster share.

Anchors are clustered by direction. For a cluster with centre c and largest
angle b between c and a member, no member u scores a row x above
|u| |x| cos(max(0, angle(x, c) - b)). A task sorts its candidates by that bound
(without |u|) once for a cluster; every member walks the shared list from the top, a run of
rows at a time, and stops when the bound of the next row is below what it
still needs: its k-th score, or the lower end of the window it looks in. What
it has not seen cannot enter its result.

Two walks: first the ``positives`` best rows of the anchor's own label, then
for each of these the ``negatives`` best rows of other labels whose score lies
between ``low`` and ``high`` percent of the positive's (one walk an anchor
serves all its positives).

How it runs: candidates are never shuffled: a task walks its partition in chunks
of bounded size, with last places kept from chunk to chunk. Anchors come in
blocks of at most about BLOCK (consecutive clusters; larger clusters are
split), which travel with the tasks; a job a walk and block. A task returns at
most ``positives`` rows an anchor, or ``negatives`` an anchor and positive;
windows with a partial group limit rank them.

Scores are exact integers: products are summed in doubles while they cannot
reach 2^53, in 64-bit integers otherwise (a score beyond 64 bits has no defined value).
Defined cases: rows with a null vec_id or label, a null vector or null or
non-finite components take no part; vectors of different lengths are compared
as if padded with zeros; rows that repeat a vec_id are rows of their own (an
anchor's own row alone is excluded from its positives); fewer rows than asked
for give fewer results; a window that no score can meet (positive scores below
0) gives none; an empty table gives none. Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hublytics.llm.best import NONE, Best
from hublytics.llm.common import cut
from hublytics.llm.topk_search import EXACT, SCALE, _matrix, _pad, _usable, quantise

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90
BLOCK = 4096
#: anchors a cluster, on average
CLUSTER = 32
CLUSTERS = 512
#: anchors of least hash that shape the clusters (a bounded sample; every anchor is then placed)
SAMPLE = 16384
ROUNDS = 8
#: numbers in a chunk of candidates
CHUNK = 1 << 22
RUN = 256


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.sqrt((x ** 2).sum(axis=1, keepdims=True))
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


def _centres(sample: np.ndarray, clusters: int) -> np.ndarray:
    """Directions by spherical k-means from evenly spaced members."""
    x = _unit(sample.astype(np.float64))
    if not len(x):
        return x
    centres = x[np.linspace(0, len(x) - 1, clusters).astype(int)]
    for _ in range(ROUNDS):
        near = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = np.where((np.bincount(near, minlength=len(centres)) > 0)[:, None], _unit(sums), centres)
    return centres


def _place(centres: np.ndarray):
    def run(batches):
        for b in batches:
            column = b.column(b.schema.get_field_index("vec"))
            dim = max(centres.shape[1], max((len(v) for v in column), default=0))
            x = _unit(_matrix(pa.chunked_array([column]), dim).astype(np.float64))
            near = (x @ _pad(centres, dim).T).argmax(axis=1) if len(centres) else np.zeros(len(x), np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near, pa.int64())], [*b.schema.names, "cluster"])
    return run


class _Block:
    """Anchors of some clusters, in order of cluster."""

    def __init__(self, table: pa.Table):
        self.dim = max((len(v) for v in table.column("vec")), default=0)
        self.vecs = _matrix(table.column("vec"), self.dim)
        self.rows, self.labels, self.ids = (table.column(n).to_numpy() for n in ("row", "label", "vec_id"))
        cluster = table.column("cluster").to_numpy()
        self.clusters = [np.flatnonzero(cluster == c) for c in np.unique(cluster)]


def _chunks(batches, dim: int):
    """Candidates as (rows, ids, labels, matrix) of about CHUNK numbers."""
    held, rows = [], 0
    wide = max(dim, 1)
    for b in batches:
        for at in range(0, b.num_rows, 1024):
            part = b.slice(at, 1024)
            held.append(part)
            rows += part.num_rows
            wide = max(wide, max((len(v) for v in part.column(3)), default=0))
            if rows * wide >= CHUNK:
                yield _arrays(held, dim)
                held, rows = [], 0
    if held:
        yield _arrays(held, dim)


def _arrays(held: list, dim: int):
    table = pa.Table.from_batches(held)
    width = max(dim, max((len(v) for v in table.column("vec")), default=0))
    return *(table.column(n).to_numpy() for n in ("row", "vec_id", "label")), _matrix(table.column("vec"), width)


def _shared_list(members: np.ndarray, x: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidates in order of the cluster's bound; the bounds, for |u| = 1."""
    own = _unit(members)
    centre = _unit(own.sum(axis=0, keepdims=True))[0]
    spread = np.arccos(np.clip(own @ centre, -1, 1))
    widest = spread[(own != 0).any(axis=1)].max(initial=0.0)
    away = np.arccos(np.clip(np.divide(x @ centre, length, out=np.ones(len(x)), where=length > 0), -1, 1))
    bound = length * (np.cos(np.maximum(away - widest, 0)) + 1e-6)  # angles are good to about 1e-8
    order = np.argsort(-bound, kind="stable")
    return order, bound[order]


def _walk(block: _Block, member_of: np.ndarray, same: bool, least: np.ndarray, most: np.ndarray, k: int):
    """Walkers (each an anchor of ``block``) look for the k best rows of their
    label (``same``) or of other labels with a score from least to most."""
    def run(batches):
        best = Best(len(member_of), k)
        for rows, ids, labels, vecs in _chunks(batches, block.dim):
            u = _pad(block.vecs, vecs.shape[1])
            size = float(np.abs(u).max(initial=0)) * float(np.abs(vecs).max(initial=0)) * max(vecs.shape[1], 1)
            x = vecs.astype(np.float64)
            length = np.sqrt((x ** 2).sum(axis=1))
            for members in block.clusters:
                walkers = np.flatnonzero(np.isin(member_of, members))
                if not len(walkers):
                    continue
                order, bound = _shared_list(u[members].astype(np.float64), x, length)
                reach = np.sqrt((u[member_of[walkers]].astype(np.float64) ** 2).sum(axis=1))
                at, run_rows = 0, RUN
                while at < len(order):
                    need = np.maximum(best.kth_score[walkers], least[walkers])
                    going = reach * bound[at] + 1e-6 >= need
                    walkers, reach = walkers[going], reach[going]
                    if not len(walkers):
                        break
                    who, of = np.unique(member_of[walkers], return_inverse=True)
                    here = order[at: at + run_rows]
                    score = (u[who].astype(np.float64) @ x[here].T).astype(np.int64) if size < EXACT else u[who] @ vecs[here].T
                    equal = block.labels[who, None] == labels[here]
                    fits = equal & (block.rows[who, None] != rows[here]) if same else ~equal
                    s = score[of]
                    best.offer(walkers, s, ids[here], fits[of] & (s >= least[walkers, None]) & (s <= most[walkers, None]))
                    at, run_rows = at + run_rows, min(2 * run_rows, 4096)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in (best.who, best.score, best.id)], ["walker", "score", "id"])
    return run


def _ranked(vectors: DataFrame, walk, k: int) -> DataFrame:
    hits = vectors.mapInArrow(walk, "walker long, score long, id long")
    order = Window.partitionBy("walker").orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _mine_block(vectors: DataFrame, block: _Block, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    spark = vectors.sparkSession
    every = np.arange(len(block.rows))
    open_end = np.full(len(every), NONE), np.full(len(every), np.iinfo(np.int64).max)
    found = _ranked(vectors, _walk(block, every, True, *open_end, positives), positives).toArrow().sort_by(
        [("walker", "ascending"), ("rank", "ascending")])  # at most BLOCK x positives rows
    member, of, score = (found.column(n).to_numpy() for n in ("walker", "id", "score"))
    least = np.array([-(-low * int(s) // 100) for s in score], np.int64)
    most = np.array([high * int(s) // 100 for s in score], np.int64)
    can = least <= most
    member, of, score, least, most = (a[can] for a in (member, of, score, least, most))
    hits = _ranked(vectors, _walk(block, member, False, least, most, negatives), negatives)
    pairs = pa.table({"walker": np.arange(len(member)), "anchor_id": block.ids[member], "positive_id": of, "positive_score": score})
    return hits.join(F.broadcast(spark.createDataFrame(pairs)), "walker").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _blocks(anchors: DataFrame, size: int) -> DataFrame:
    """Anchors with ``cluster`` (parts of at most about ``size``) and ``block``."""
    total = anchors.count()
    clusters = max(1, min(CLUSTERS, -(-total // CLUSTER)))
    sample = anchors.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("vec").toArrow().column("vec")
    centres = _centres(_matrix(sample, max((len(v) for v in sample), default=0)), min(clusters, max(len(sample), 1)))
    placed = cut(anchors.mapInArrow(_place(centres), "row long, vec_id long, label long, vec array<long>, cluster long"), "negatives-anchors")
    sizes = placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))  # at most CLUSTERS rows
    sizes = sizes.select("cluster", F.ceil(F.col("n") / size).cast("long").alias("parts"), "n")
    before = F.sum("n").over(Window.orderBy("cluster")) - F.col("n")
    dealt = placed.join(F.broadcast(sizes.withColumn("before", before)), "cluster")
    part = F.pmod(F.xxhash64("row"), F.col("parts"))
    block = F.floor((F.col("before") + part * F.col("n") / F.col("parts")) / size).cast("long")
    return cut(dealt.select("row", "vec_id", "label", "vec", (F.col("cluster") * (total + 1) + part).alias("cluster"), block.alias("block")),
               "negatives-blocks")


def mine(table: DataFrame, every: int, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score from ``table`` (vec_id, embedding, label), with the rows
    whose vec_id is divisible by ``every`` as anchors."""
    usable = table.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("embedding")))
    vectors = cut(usable.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                                F.col("label").cast("long").alias("label"), quantise(F.col("embedding"), scale).alias("vec")),
                  "negatives-vectors")
    placed = _blocks(vectors.where(F.col("vec_id") % every == 0), block)
    out = vectors.sparkSession.createDataFrame(
        [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for b in [r.block for r in placed.select("block").distinct().orderBy("block").collect()]:
        mine_ = _Block(placed.where(F.col("block") == b).orderBy("cluster", "row").toArrow())
        out = out.unionByName(cut(_mine_block(vectors, mine_, positives, negatives, low, high), "negatives-block"))
    return out


def noisy_labels(table: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """``table`` with the label of rows whose vec_id is divisible by ``every``
    moved on by one (the benchmark's planted label noise)."""
    moved = (F.col("label").cast("long") + 1) % labels
    return table.withColumn("label", F.when(F.col("vec_id") % every == 0, moved).otherwise(F.col("label").cast("long")))
