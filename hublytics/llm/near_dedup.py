"""Near-duplicate documents by HyperMinHash.

A document's set is its distinct shingles, as 64-bit values. A value's top
bits choose one of REGISTERS buckets; of each bucket's smallest value only the
number of leading zeros and the next MANTISSA bits are stored (16 bits a
register). An empty bucket borrows from another one by a fixed sequence of
probes, so small sets have full sketches too. Four registers make a band of
64 bits; documents that share a band are candidates. Two sets of similarity
0.8 share a band but for a chance of (1 - 0.8^4)^32 = 5e-8.

Candidates are confirmed on the full sets: registers that agree give an
estimate of the similarity, corrected for unequal values that agree by chance,
and only pairs whose estimate is far below the threshold (ERRORS standard
errors) are spared the exact comparison.

How it runs, without listing pairs of a group:

1. Equal sets are one node (aggregated map-side; copies are never compared).
2. Band buckets give star edges to the bucket's first node; the connected
   components are candidate groups, outside of which there is no link. Each
   node's full set travels once, to its group.
3. A group of up to CHUNK nodes is resolved in one place by a union-find that
   compares only nodes not yet connected.
4. A larger group is dealt into chunks, twice with different deals; the links
   found merge most of it. Then only chunks of different components meet, in
   pairs of chunks, so every pair of nodes that is not connected already has
   been compared: no link is lost and no chunk exceeds its bound.

Defined cases: null text or text without a word has the empty set, is linked
with nothing and stays; a text of fewer words than a shingle has one shingle,
its whole word sequence; repeated rows and copies share a component; a null
doc_id is larger than every other; further columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hublytics.llm.common import cut, slices
from hublytics.llm.components import components

REGISTERS = 128
MANTISSA = 10
BAND = 4
#: one standard error of an estimate at 0.8 is sqrt(0.16 / registers); pairs below by more than this many are no candidates
ERRORS = 6.0
#: nodes, and shingles, that one task compares at once
CHUNK = 512
CHUNK_SHINGLES = 4_000_000
#: a bound of the filter that is broadcast before texts are shuffled
SLOTS = 1 << 21
#: bytes of text turned into words at once
PIECE = 1 << 20
#: chance that two unequal minima agree in zeros (1/3) and in all mantissa bits
BY_CHANCE = 2.0 ** -MANTISSA / 3

_rng = np.random.default_rng(20240601)
LETTER = _rng.integers(0, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2 ** 64))
PROBES = np.stack([_rng.permutation(REGISTERS) for _ in range(32)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _words(body: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts laid end to end, and where each
    starts. ``edges``: where texts start."""
    if not len(body):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    low = LOWER[body]
    word = ~IS_SPACE[low]
    edge = np.zeros(len(body) + 1, bool)
    edge[edges] = True
    edge[len(body)] = True
    begin = word.copy()
    begin[1:] &= ~word[:-1] | edge[1:-1]
    end = word.copy()
    end[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(len(body), BASE))
        total = np.concatenate([[np.uint64(0)], np.cumsum(LETTER[low] * power)])
        back = np.cumprod(np.full(len(body), BASE_INVERSE))
        return _mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64)), starts


def _long_words(body: np.ndarray) -> np.ndarray:
    """Word hashes of one long text, read in pieces that end at white space."""
    parts, at = [], 0
    while at < len(body):
        stop = min(at + PIECE, len(body))
        if stop < len(body):
            gaps = np.flatnonzero(IS_SPACE[body[at:stop]])
            if len(gaps):
                stop = at + int(gaps[-1]) + 1
            else:  # one word fills the piece: up to the next white space
                rest = np.flatnonzero(IS_SPACE[body[stop:]])
                stop = stop + int(rest[0]) if len(rest) else len(body)
        parts.append(_words(body[at:stop], np.array([0]))[0])
        at = stop
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _set_of(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingle values of one document's words."""
    if not len(words):
        return words
    with np.errstate(over="ignore"):
        n = min(size, len(words))
        value = words[: len(words) - n + 1]
        for k in range(1, n):
            value = _mix(value + BASE) ^ words[k: len(words) - n + 1 + k]
        return np.unique(_mix(value + np.uint64(n)))


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The set of every text of a string column, in order."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    body = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    i, n = 0, len(column)
    while i < n:
        if at[i + 1] - at[i] > PIECE:
            yield _set_of(_long_words(body[at[i]: at[i + 1]]), size)
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(at, at[i] + PIECE, "right")) - 1)
        starts = at[i:j] - at[i]
        run = body[at[i]: at[j]]
        words, begin = _words(run, starts[starts < len(run)])
        cuts = np.searchsorted(begin, np.append(starts, len(run)))
        for k in range(j - i):
            yield _set_of(words[cuts[k]: cuts[k + 1]], size)
        i = j


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, REGISTERS) compressed registers; sets must not be empty."""
    shift = np.uint64(64 - REGISTERS.bit_length() + 1)
    bounds = np.arange(REGISTERS, dtype=np.uint64) << shift
    least = np.zeros((len(sets), REGISTERS), np.uint64)
    for k, s in enumerate(sets):
        at = np.searchsorted(s, bounds)
        least[k] = s[np.minimum(at, len(s) - 1)]
        least[k, at == len(s)] = 0
    empty = (least >> shift) != np.arange(REGISTERS, dtype=np.uint64)
    # bucket 0 is told from "no value" by the set's first element
    empty[:, 0] = [int(s[0] >> shift) != 0 for s in sets]
    value = (least & ((np.uint64(1) << shift) - np.uint64(1))) >> (shift - np.uint64(53))  # 53 bits: exact as a double
    zeros = 53 - np.frexp(value.astype(np.float64))[1]
    zeros[value == 0] = 53
    mantissa = ((value << zeros.astype(np.uint64)) >> np.uint64(52 - MANTISSA)) & np.uint64(2 ** MANTISSA - 1)
    found = (zeros.astype(np.uint16) << np.uint16(MANTISSA)) | mantissa.astype(np.uint16)
    out, left = found.copy(), empty.copy()
    for probe in [*PROBES, *(np.roll(np.arange(REGISTERS), k) for k in range(1, REGISTERS))]:
        if not left.any():
            break
        take = left & ~empty[:, probe]
        out[take] = found[:, probe][take]
        left &= ~take
    return out


def sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            column = b.column(b.schema.get_field_index("text"))
            counts, digests, bands, held, at = [], [], [None] * len(column), [], []

            def flush():
                if held:
                    for k, r in zip(at, registers(held).view(np.int64), strict=True):
                        bands[k] = r
                held.clear()
                at.clear()

            for k, s in enumerate(shingle_sets(column, size)):
                counts.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                if len(s):
                    held.append(s)
                    at.append(k)
                    if sum(map(len, held)) > 200_000:
                        flush()
            flush()
            d = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(counts, pa.int64()), pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy()),
                 pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "text_key", "n", "d1", "d2", "bands"])
    return run


def full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets, bands = [], []
            for s in shingle_sets(b.column(b.schema.get_field_index("text")), size):
                sets.append(s.tobytes())
                bands.append(registers([s])[0].tobytes() if len(s) else b"")
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(sets, pa.binary()), pa.array(bands, pa.binary())],
                                             ["grp", "node", "n", "chunks", "shingles", "regs"])
    return run


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _resolve(node: np.ndarray, comp: np.ndarray, sets: list[np.ndarray], regs: np.ndarray, percent: int) -> np.ndarray:
    """Smallest label of each node after linking: union-find from ``comp``."""
    label, root = np.unique(comp, return_inverse=True)
    parent = np.arange(len(label))
    size = np.array([len(s) for s in sets])
    margin = ERRORS * np.sqrt(0.16 / np.clip(size, 1, REGISTERS))
    for i in range(len(node) - 1):
        own = parent[root[i]]
        rest = np.flatnonzero(parent[root[i + 1:]] != own) + i + 1
        if not len(rest):
            continue
        small, large = np.minimum(size[i], size[rest]), np.maximum(size[i], size[rest])
        rest = rest[100 * small >= percent * large]
        if not len(rest):
            continue
        agree = (regs[rest] == regs[i]).mean(axis=1)
        estimate = (agree - BY_CHANCE) / (1 - BY_CHANCE)
        likely = estimate >= percent / 100 - np.maximum(margin[i], margin[rest])
        for j in rest[likely][np.argsort(-estimate[likely], kind="stable")]:
            a, b = parent[root[i]], parent[root[j]]
            if a != b and _similar(sets[i], sets[j], percent):
                parent[parent == max(a, b)] = min(a, b)  # parents stay roots: labels of one chunk are few
    return label[parent[root]]


def _links(percent: int):
    def run(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        node, first = np.unique(node, return_index=True)
        shingles, regs = table.column("shingles"), table.column("regs")
        sets = [np.frombuffer(shingles[int(k)].as_py(), np.uint64) for k in first]
        sketches = np.stack([np.frombuffer(regs[int(k)].as_py(), np.uint16) for k in first])
        comp = table.column("comp").to_numpy()[first]
        label = _resolve(node, comp, sets, sketches, percent)
        keep = label != comp
        # what was joined: a node to its chunk's label, and the label it had
        return pa.table({"a": pa.array(comp[keep]), "b": pa.array(label[keep])})
    return run


def _chunks(total: str = "members", shingles: str = "shingle_sum") -> F.Column:
    return F.greatest(F.ceil(F.col(total) / CHUNK), F.ceil(F.col(shingles) / CHUNK_SHINGLES), F.lit(1)).cast("long")


def _deal(node, chunks, salt: int) -> F.Column:
    return F.pmod(F.xxhash64(node, F.lit(salt)), chunks)


def _slot(doc_id) -> F.Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(SLOTS))


def _relabel(state: DataFrame, edges: DataFrame) -> DataFrame:
    """``state`` with comp replaced by the component of comp under ``edges``."""
    found = components(edges).select(F.col("node").alias("comp"), F.col("comp").alias("__to"))
    return state.join(found, "comp", "left").withColumn("comp", F.coalesce("__to", "comp")).drop("__to")


def _resolve_groups(sets: DataFrame, percent: int) -> DataFrame:
    """(node, comp) of the nodes of ``sets`` (grp, node, n, chunks, shingles, regs)."""
    links = lambda d: d.groupBy("grp", "chunk").applyInArrow(_links(percent), "a long, b long")
    state = sets.select("grp", "node", "n", F.col("node").alias("comp"))
    first = sets.withColumn("chunk", _deal(F.col("node"), F.col("chunks"), 0)).withColumn("comp", F.col("node"))
    found = cut(links(first), "near-links")
    large = sets.where("chunks > 1").select("grp").distinct()
    if not large.limit(1).count():
        return _relabel(state, found).select("node", "comp")
    state = cut(_relabel(state, found), "near-state")
    # a second deal of the large groups joins the chunks' components
    again = sets.where("chunks > 1").join(state.select("node", "comp"), "node")
    again = again.withColumn("chunk", _deal(F.col("node"), F.col("chunks"), 1))
    state = cut(_relabel(state, links(again)), "near-state")
    # now every two components of a large group meet: a large component in
    # chunks of its own, small ones pooled
    state_l = state.join(large, "grp", "left_semi")
    sizes = (state_l.groupBy("grp", "comp").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingle_sum"))
             .withColumn("own", _chunks()))
    sizes = cut(sizes.withColumn("alone", (F.col("members") >= CHUNK) | (F.col("own") > 1)), "near-sizes")
    # a small component has fewer than CHUNK members: pools of whole components hold about CHUNK nodes
    pools = sizes.where("not alone").groupBy("grp").agg(
        F.greatest(F.ceil(F.sum("members") / CHUNK), F.ceil(F.sum("shingle_sum") / CHUNK_SHINGLES)).cast("long").alias("pools"))
    several = sizes.groupBy("grp").agg(F.count(F.lit(1)).alias("comps")).where("comps > 1").select("grp")
    placed = (sizes.join(several, "grp", "left_semi").join(pools, "grp", "left")
              .withColumn("owner", F.when(F.col("alone"), F.col("comp")).otherwise(F.lit(-1).cast("long"))))
    slots = (placed.select("grp", "owner", F.explode(F.when(F.col("alone"), F.sequence(F.lit(0).cast("long"), F.col("own") - 1))
                           .otherwise(F.array(_deal(F.col("comp"), F.col("pools"), 2)))).alias("slot")).distinct())
    slots = cut(slots, "near-slots")
    left = slots.select("grp", F.col("owner").alias("o1"), F.col("slot").alias("s1"))
    right = slots.select("grp", F.col("owner").alias("o2"), F.col("slot").alias("s2"))
    meet = left.join(right, "grp").where("o1 < o2 or (o1 = -1 and o2 = -1 and s1 <= s2)")
    meet = cut(meet.withColumn("chunk", F.monotonically_increasing_id()), "near-meet")
    sides = (meet.select("grp", "chunk", F.col("o1").alias("owner"), F.col("s1").alias("slot"))
             .union(meet.select("grp", "chunk", F.col("o2").alias("owner"), F.col("s2").alias("slot"))).distinct())
    at = (state_l.join(placed.select("grp", "comp", "alone", "own", "pools", "owner"), ["grp", "comp"])
          .select("grp", "node", "comp", "owner",
                  F.when(F.col("alone"), _deal(F.col("node"), F.col("own"), 3)).otherwise(_deal(F.col("comp"), F.col("pools"), 2)).alias("slot")))
    cross = at.join(sides, ["grp", "owner", "slot"]).join(sets.select("node", "shingles", "regs"), "node")
    return _relabel(state, links(cross)).select("node", "comp")


def near_dedup(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.
    ``size``: words a shingle; links: 100 * intersection >= percent * union."""
    key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    texts = docs.select("doc_id", key.alias("text_key"), "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = cut(texts.mapInArrow(
        sketch(size), f"doc_id {id_type}, text_key long, n long, d1 long, d2 long, bands array<long>"), "near-rows")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("u"), "doc_id", "text_key"))
    nodes = (rows.where("n > 0").groupBy("d1", "d2")
             .agg(best.alias("best"), F.first("n").alias("n"), F.first("bands").alias("bands")))
    nodes = cut(nodes.withColumn("node", F.monotonically_increasing_id()), "near-nodes")

    # a band is 64 bits: its registers themselves are the key
    keys = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    shared = cut(keys.groupBy("band", "key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("c"))
                 .where("c > 1").drop("c"), "near-buckets")
    stars = keys.join(shared, ["band", "key"]).select(F.col("hub").alias("a"), F.col("node").alias("b"))
    groups = components(stars).select("node", F.col("comp").alias("grp"))

    members = cut(groups.join(nodes.select("node", "n", "best"), "node"), "near-members")
    chunks = members.groupBy("grp").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingle_sum"))
    wanted = cut(members.join(chunks.select("grp", _chunks().alias("chunks")), "grp")
                 .select("grp", "node", "n", "chunks", F.col("best.doc_id").alias("w_id"), F.col("best.text_key").alias("w_key"),
                         _slot(F.col("best.doc_id")).alias("slot")), "near-wanted")
    # texts that are surely not wanted stay where they are: at most SLOTS numbers are broadcast
    near = texts.join(F.broadcast(wanted.select("slot").distinct()), _slot(texts["doc_id"]) == F.col("slot"), "left_semi")
    same = near["doc_id"].eqNullSafe(F.col("w_id")) & (near["text_key"] == F.col("w_key"))
    picked = (near.join(wanted.hint("merge"), same).groupBy("w_id", "w_key", "grp", "node", "n", "chunks")
              .agg(F.first("text").alias("text")).select("grp", "node", "n", "chunks", "text"))
    sets = cut(picked.mapInArrow(full_sets(size), "grp long, node long, n long, chunks long, shingles binary, regs binary"), "near-sets")
    comps = cut(_resolve_groups(sets, percent), "near-comps")

    own = nodes.join(comps, "node", "left").select("d1", "d2", F.coalesce("comp", "node").alias("comp"), "best.doc_id")
    least = own.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    labels = cut(own.join(least, "comp").select("d1", "d2", "component_id"), "near-labels")
    out = rows.select("doc_id", "n", "d1", "d2").join(labels, ["d1", "d2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                      F.when(F.col("n") > 0, F.col("doc_id").eqNullSafe(F.col("component_id"))).otherwise(True).alias("kept"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each component of :func:`near_dedup`."""
    keep = near_dedup(docs, **options).where("kept").select(F.col("doc_id").alias("__keep")).distinct()
    return docs.join(keep, F.col("doc_id").eqNullSafe(F.col("__keep")), "left_semi")
