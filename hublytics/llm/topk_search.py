"""Exact top-k search by inner product: a ball tree per shard.

Vectors are dealt to shards of at most about SHARD_ROWS rows: by the nearest
of a few pivot vectors, so that a shard is a region, and by hash inside a
region that holds more. Each shard is one ball tree. A ball with centre c and
radius r holds no inner product with q above <q, c> + |q| r; leaves are
visited in the order of that bound (never above any of their ancestors'
bounds) until it falls below the query's current k-th score. At equal score
the smaller vec_id wins, so a leaf whose bound equals the k-th score is
visited only if it has a smaller id.

How it runs: queries are rows of the table, so each is first answered inside
its own shard. The k-th score found there is shared with every other shard.
Before a query travels to a shard, the upper balls of its tree (at most 16, a
cut through the tree) are bounded: PACK shards' balls meet a block of at most
about BLOCK_ROWS queries, and only queries that some ball may still serve go on.
A shard's tree meets them in parts of about a block; shards that no query asks
are not shuffled at all. The shared score prunes there from the start.
Only results that beat the shared score come back, and a window with a partial
group limit ranks them.

Scores are exact integers: the products are summed in doubles while they
cannot exceed 2^53, in 64-bit integers otherwise (a score beyond 64 bits has no defined value). Defined
cases: vectors that
are null or hold null or non-finite components, and rows without vec_id, take
no part; vectors of different lengths are compared as if padded with zeros;
rows that repeat a vec_id are rows of their own (a query's own row alone is
excluded), so their ids can appear twice; fewer than k candidates give fewer
results; an empty table gives none. Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hublytics.llm.common import cut

K = 5
SCALE = 256
SHARD_ROWS = 4096
BLOCK_ROWS = 8192
LEAF = 64
#: a tree's first nodes, of which those without children among them bound the shard (odd: children come in pairs)
FRONT = 31
#: shards whose bounds meet a block of queries at once
PACK = 256
#: pivots are the rows of smallest hash: a bounded, documented sample that only shapes the shards
PIVOTS = 64
EXACT = 2.0 ** 53

_TREE = "shard long, dim int, vecs binary, rows binary, ids binary, lo binary, hi binary, centre binary, radius binary, parent binary"
_BLOCK = "block long, dim int, vecs binary, rows binary, ids binary, score binary, held binary, home binary"
_FRONT = "shard long, dim int, centre binary, radius binary"
_ASKED = "shard long, block long, n long, dim int, vecs binary, rows binary, ids binary, score binary, held binary"
_HIT = "query_row long, query_id long, score long, vec_id long"


def quantise(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def _usable(vector: Column) -> Column:
    fine = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, fine), F.lit(False))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of integers, padded with zeros to ``dim``."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    flat, at = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
    if len(at) and (at == dim).all():
        return flat.reshape(len(at), dim).astype(np.int64)
    out = np.zeros((len(at), dim), np.int64)
    out[np.arange(dim) < at[:, None]] = flat
    return out


def _ball_tree(x: np.ndarray) -> dict[str, np.ndarray]:
    """Nodes in breadth-first order over an order of the rows: lo, hi, centre,
    radius, parent; ``order`` of the rows."""
    order = np.arange(len(x))
    lo, hi, centre, radius, parent = [0], [len(x)], [], [], [-1]
    at = 0
    while at < len(lo):
        part = x[order[lo[at]: hi[at]]].astype(np.float64)
        c = part.mean(axis=0)
        far = np.sqrt(((part - c) ** 2).sum(axis=1))
        centre.append(c)
        radius.append(far.max())
        if len(part) > LEAF and far.max() > 0:
            one = part[far.argmax()]
            other = part[((part - one) ** 2).sum(axis=1).argmax()]
            side = part @ (other - one)
            half = len(part) // 2
            order[lo[at]: hi[at]] = order[lo[at]: hi[at]][np.argsort(side, kind="stable")]
            lo += [lo[at], lo[at] + half]
            hi += [lo[at] + half, hi[at]]
            parent += [at, at]
        at += 1
    return {"order": order, "lo": np.array(lo), "hi": np.array(hi), "centre": np.array(centre),
            "radius": np.array(radius), "parent": np.array(parent)}


def _build(table: pa.Table) -> pa.Table:
    lengths = [len(v) for v in table.column("vec")]
    dim = max(lengths, default=0)
    x = _matrix(table.column("vec"), dim)
    tree = _ball_tree(x)
    o = tree["order"]
    values = {
        "shard": table.column("shard")[0].as_py(), "dim": dim, "vecs": x[o].tobytes(),
        "rows": table.column("row").to_numpy()[o].tobytes(), "ids": table.column("vec_id").to_numpy()[o].tobytes(),
        **{n: tree[n].astype(np.float64 if n in ("centre", "radius") else np.int64).tobytes()
           for n in ("lo", "hi", "centre", "radius", "parent")}}
    return pa.table({n: pa.array([v], pa.int64() if n == "shard" else pa.int32() if n == "dim" else pa.binary())
                     for n, v in values.items()})


def _load(row: dict) -> dict:
    """The arrays of a tree or block row."""
    out = {n: np.frombuffer(v, np.float64 if n in ("centre", "radius") else np.int64) if isinstance(v, bytes) else v
           for n, v in row.items()}
    for n in ("vecs", "centre"):
        if n in out:
            out[n] = out[n].reshape(len(out["rows"] if n == "vecs" else out["lo"]), out["dim"])
    return out


def _pad(x: np.ndarray, dim: int) -> np.ndarray:
    return x if x.shape[1] == dim else np.pad(x, ((0, 0), (0, dim - x.shape[1])))


NONE = np.iinfo(np.int64).min
LAST = np.iinfo(np.int64).max


def _search(tree: dict, q: np.ndarray, own: np.ndarray, score: np.ndarray, held: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(score, id) of up to k rows of the tree for every query, best first,
    that beat the query's k-th (score, held); NONE where there is none."""
    dim = max(tree["dim"], q.shape[1])
    x, q = _pad(tree["vecs"], dim), _pad(q, dim)
    q_float = q.astype(np.float64)
    size = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(dim, 1)
    as_float = size < EXACT
    xs, qs = (x.astype(np.float64), q_float) if as_float else (x, q)
    bound = _bound(q, _pad(tree["centre"], dim), tree["radius"])
    parent = tree["parent"]
    for n in range(1, len(parent)):  # breadth first: parents come before children
        np.minimum(bound[:, n], bound[:, parent[n]], out=bound[:, n])
    inner = np.zeros(len(parent), bool)
    inner[parent[1:]] = True
    leaf = np.flatnonzero(~inner)
    least = np.array([tree["ids"][tree["lo"][n]: tree["hi"][n]].min() for n in leaf])
    reach = bound[:, leaf]
    turn = np.argsort(-reach, axis=1, kind="stable")
    top_s = np.full((len(q), k), NONE)
    top_i = np.full((len(q), k), LAST)
    # the current k-th result: the shared one until k better ones are found here
    kth_s, kth_i = score.copy(), held.copy()
    active = np.arange(len(q))
    for step in range(len(leaf)):
        pick = turn[active, step]
        limit = reach[active, pick]
        going = limit >= kth_s[active]
        active, pick, limit = active[going], pick[going], limit[going]
        if not len(active):
            break
        visit = (limit >= kth_s[active] + 1) | (least[pick] < kth_i[active])
        for n in np.unique(pick[visit]):
            who = active[visit & (pick == n)]
            lo, hi = tree["lo"][leaf[n]], tree["hi"][leaf[n]]
            s = qs[who] @ xs[lo:hi].T
            s = s.astype(np.int64) if as_float else s
            ids = np.broadcast_to(tree["ids"][lo:hi], s.shape)
            better = (s > kth_s[who, None]) | ((s == kth_s[who, None]) & (ids < kth_i[who, None]))
            better &= tree["rows"][lo:hi] != own[who, None]
            some = better.any(axis=1)
            who, s, ids, better = who[some], s[some], ids[some], better[some]
            if not len(who):
                continue
            all_s = np.concatenate([top_s[who], np.where(better, s, NONE)], axis=1)
            all_i = np.concatenate([top_i[who], np.where(better, ids, LAST)], axis=1)
            first = np.lexsort((all_i, np.where(all_s == NONE, LAST, -all_s)), axis=1)[:, :k]
            top_s[who] = np.take_along_axis(all_s, first, axis=1)
            top_i[who] = np.take_along_axis(all_i, first, axis=1)
            last_s, last_i = top_s[who, k - 1], top_i[who, k - 1]
            raise_it = (last_s > kth_s[who]) | ((last_s == kth_s[who]) & (last_i < kth_i[who]))
            kth_s[who[raise_it]], kth_i[who[raise_it]] = last_s[raise_it], last_i[raise_it]
    return top_s, top_i


def _hits(rows: np.ndarray, ids: np.ndarray, s: np.ndarray, i: np.ndarray) -> pa.Table:
    q, r = np.nonzero(s != NONE)
    return pa.table({"query_row": rows[q], "query_id": ids[q], "score": s[q, r], "vec_id": i[q, r]})


def _home(every: int, k: int):
    """A shard's own queries, answered inside it: one block row."""
    def run(table: pa.Table) -> pa.Table:
        tree = _load(table.to_pylist()[0])
        mine = tree["ids"] % every == 0
        q, rows, ids = tree["vecs"][mine], tree["rows"][mine], tree["ids"][mine]
        none = np.full(len(q), NONE)
        s, i = _search(tree, q, rows, none, np.full(len(q), LAST), k)
        found = [{"shard": tree["shard"], "dim": tree["dim"], "vecs": q.tobytes(), "rows": rows.tobytes(), "ids": ids.tobytes(),
                  "top_s": s.tobytes(), "top_i": i.tobytes()}] if len(q) else []
        return pa.Table.from_pylist(found, pa.schema([("shard", pa.int64()), ("dim", pa.int32())]
                                                        + [(n, pa.binary()) for n in ("vecs", "rows", "ids", "top_s", "top_i")]))
    return run


def _blocks(k: int):
    """Queries of several shards as one block with their k-th results."""
    def run(table: pa.Table) -> pa.Table:
        parts = table.to_pylist()
        dim = max(p["dim"] for p in parts)
        rows = [np.frombuffer(p["rows"], np.int64) for p in parts]
        vecs = [_pad(np.frombuffer(p["vecs"], np.int64).reshape(len(r), p["dim"]), dim) for p, r in zip(parts, rows, strict=True)]
        s = np.concatenate([np.frombuffer(p["top_s"], np.int64).reshape(-1, k) for p in parts])
        i = np.concatenate([np.frombuffer(p["top_i"], np.int64).reshape(-1, k) for p in parts])
        home = np.concatenate([np.full(len(r), p["shard"]) for p, r in zip(parts, rows, strict=True)])
        values = {"vecs": np.concatenate(vecs), "rows": np.concatenate(rows),
                  "ids": np.concatenate([np.frombuffer(p["ids"], np.int64) for p in parts]),
                  "score": s[:, k - 1].copy(), "held": i[:, k - 1].copy(), "home": home}
        return pa.table({"block": pa.array([parts[0]["block"]], pa.int64()), "dim": pa.array([dim], pa.int32()),
                         **{n: pa.array([v.astype(np.int64).tobytes()], pa.binary()) for n, v in values.items()}})
    return run


def _front(batches):
    """The balls that bound each tree: nodes of a cut through it."""
    for b in batches:
        out = []
        for row in b.to_pylist():
            parent = np.frombuffer(row["parent"], np.int64)[:FRONT]
            cut_at = np.setdiff1d(np.arange(len(parent)), parent)
            radius = np.frombuffer(row["radius"], np.float64)
            centre = np.frombuffer(row["centre"], np.float64).reshape(len(radius), row["dim"])
            out.append({"shard": row["shard"], "dim": row["dim"], "centre": centre[cut_at].tobytes(), "radius": radius[cut_at].tobytes()})
        yield pa.RecordBatch.from_pylist(out, pa.schema([("shard", pa.int64()), ("dim", pa.int32()), ("centre", pa.binary()),
                                                         ("radius", pa.binary())]))


def _bound(q: np.ndarray, centre: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """(queries, balls): no inner product of a query with a vector of the ball is higher."""
    q = q.astype(np.float64)
    bound = q @ centre.T + np.sqrt((q ** 2).sum(axis=1))[:, None] * radius
    return bound + 1e-6 + 1e-9 * np.abs(bound)  # rounding of the bound itself


def _ask(fronts: pa.Table, blocks: pa.Table) -> pa.Table:
    """A block's queries for each shard that may hold one of their results."""
    schema = pa.schema([(n, pa.int32() if n == "dim" else pa.int64() if n in ("shard", "block", "n") else pa.binary())
                        for n in (f.split()[0] for f in _ASKED.split(", "))])
    out = []
    for b in blocks.to_pylist():
        block = _load(b)
        for f in fronts.to_pylist():
            dim = max(f["dim"], b["dim"])
            radius = np.frombuffer(f["radius"], np.float64)
            centre = np.frombuffer(f["centre"], np.float64).reshape(len(radius), f["dim"])
            bound = _bound(_pad(block["vecs"], dim), _pad(centre, dim), radius).max(axis=1)
            asks = (bound >= block["score"]) & (block["home"] != f["shard"])
            if asks.any():
                out.append({"shard": f["shard"], "block": b["block"], "n": int(asks.sum()), "dim": b["dim"],
                            **{n: block[n][asks].tobytes() for n in ("vecs", "rows", "ids", "score", "held")}})
    return pa.Table.from_pylist(out, schema)


def _visit(k: int):
    def run(trees: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        for t in trees.to_pylist():
            tree = _load(t)
            for b in asked.to_pylist():
                block = _load(b)
                s, i = _search(tree, block["vecs"], block["rows"], block["score"].copy(), block["held"].copy(), k)
                out.append(_hits(block["rows"], block["ids"], s, i))
        return pa.concat_tables(out) if out else _hits(*[np.zeros(0, np.int64)] * 2, *[np.zeros((0, k), np.int64)] * 2)
    return run


def _nearest(pivots: np.ndarray):
    def run(batches):
        for b in batches:
            column = b.column(b.schema.get_field_index("vec"))
            dim = max(pivots.shape[1], max((len(v) for v in column), default=0))
            p = _pad(pivots, dim)
            x = _matrix(pa.chunked_array([column]), dim).astype(np.float64)
            near = ((p ** 2).sum(axis=1) - 2 * (x @ p.T)).argmin(axis=1) if len(p) else np.zeros(len(x), np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near, pa.int64())], [*b.schema.names, "region"])
    return run


def _trees(vectors: DataFrame, shard_rows: int) -> DataFrame:
    few = max(1, min(PIVOTS, -(-vectors.count() // shard_rows)))
    least = vectors.orderBy(F.xxhash64("row"), "row").limit(few).select("vec").collect()
    dim = max((len(r[0]) for r in least), default=0)
    pivots = np.zeros((len(least), dim))
    for n, r in enumerate(least):
        pivots[n, : len(r[0])] = r[0]
    placed = cut(vectors.mapInArrow(_nearest(pivots), "row long, vec_id long, vec array<long>, region long"), "topk-regions")
    regions = placed.groupBy("region").agg(F.count(F.lit(1)).alias("n"))
    regions = regions.select("region", F.ceil(F.col("n") / shard_rows).cast("long").alias("parts"))
    # at most PIVOTS rows: number the shards of all regions from 0
    regions = regions.withColumn("from", F.sum("parts").over(Window.orderBy("region")) - F.col("parts"))
    dealt = placed.join(F.broadcast(regions), "region")
    shard = F.col("from") + F.pmod(F.xxhash64("row"), F.col("parts"))
    return cut(dealt.withColumn("shard", shard).select("shard", "row", "vec_id", "vec").groupBy("shard").applyInArrow(_build, _TREE), "topk-trees")


def asked_shards(trees: DataFrame, packed: DataFrame, shards: int, blocks: int) -> DataFrame:
    """The queries of each block that each shard has to answer (_ASKED)."""
    fronts = cut(trees.select("shard", "dim", "centre", "radius", "parent").mapInArrow(_front, _FRONT), "topk-fronts")
    packs = -(-shards // PACK)
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(n - 1, 0)).cast("long")))
    some_shards = fronts.withColumn("pack", F.expr(f"shard div {PACK}")).withColumn("block", upto(blocks))
    some_queries = packed.withColumn("pack", upto(packs))
    return some_shards.groupBy("pack", "block").cogroup(some_queries.groupBy("pack", "block")).applyInArrow(_ask, _ASKED)


def _away(trees: DataFrame, packed: DataFrame, shards: int, blocks: int, k: int, block_rows: int) -> DataFrame:
    """Results of other shards than the queries' own."""
    asked = cut(asked_shards(trees, packed, shards, blocks), "topk-asked")
    # a shard's queries in parts of at most two blocks
    earlier = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = asked.select("shard", "block", F.floor(F.coalesce(F.sum("n").over(earlier), F.lit(0)) / block_rows).alias("part"))
    parts = cut(parts, "topk-parts")
    met = trees.join(parts.select("shard", F.col("part").alias("to")).distinct(), "shard")
    sent = asked.join(parts, ["shard", "block"])
    return met.groupBy("shard", "to").cogroup(sent.groupBy("shard", "part")).applyInArrow(_visit(k), _HIT)


def top_k(table: DataFrame, every: int, k: int = K, scale: int = SCALE, shard_rows: int = SHARD_ROWS,
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows of ``table`` (vec_id,
    embedding) for every row whose vec_id is divisible by ``every``."""
    usable = table.where(F.col("vec_id").isNotNull() & _usable(F.col("embedding")))
    vectors = cut(usable.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                                quantise(F.col("embedding"), scale).alias("vec")), "topk-vectors")
    trees = _trees(vectors, shard_rows)
    shards = trees.count()
    binary = "vecs binary, rows binary, ids binary, top_s binary, top_i binary"
    home = cut(trees.groupBy("shard").applyInArrow(_home(every, k), f"shard long, dim int, {binary}"), "topk-home")
    # consecutive shards' queries make a block; a shard holds at most about shard_rows of them
    queries = home.agg(F.sum(F.octet_length("rows") / 8)).first()[0] or 0
    blocks = max(1, int(-(-queries // block_rows)))
    packed = (home.withColumn("block", F.expr(f"shard * {blocks} div {max(shards, 1)}"))
              .groupBy("block").applyInArrow(_blocks(k), _BLOCK))
    packed = cut(packed, "topk-blocks")
    away = _away(trees, packed, shards, blocks, k, block_rows)
    hits = home.groupBy("shard").applyInArrow(_unpack(k), _HIT).union(away)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _unpack(k: int):
    def run(table: pa.Table) -> pa.Table:
        out = []
        for p in table.to_pylist():
            rows, ids = (np.frombuffer(p[n], np.int64) for n in ("rows", "ids"))
            out.append(_hits(rows, ids, *(np.frombuffer(p[n], np.int64).reshape(-1, k) for n in ("top_s", "top_i"))))
        return pa.concat_tables(out)
    return run
