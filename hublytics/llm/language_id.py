"""Language identification by prediction by partial matching.

For each language a context tree over bytes is trained: counts of every byte
after its last ORDER, ORDER-1, ..., 0 bytes. A byte's code length under a
context follows method C: seen bytes share n / (n + d) of the probability by
count, and an escape of d / (n + d) (n: bytes seen in the context, d: distinct
ones) goes to the context one byte shorter, at last to a uniform code over all
256 bytes. The statistics are frozen after training, so the exact code length
of a byte is a function of the last ORDER + 1 bytes only, and the trees are
flattened into one table of code lengths. A text is coded under every
language; the shortest code wins.

How it runs: counting is one pass over the training rows (byte windows counted
by numpy and kept as sorted pairs of window and number, summed by Spark) and
gathers no text. Each language's table of code lengths is made in a task of its
own from its windows, of which there are at most base ** (ORDER + 1), and
written. Scoring is one more pass without a shuffle for each group of languages
whose tables together have at most GROUP_BYTES (one group for a few dozen
languages): the group's tables are broadcast, and texts are coded in pieces of
bounded size, so neither a long text nor a large batch needs many times its own
size. With several groups a row's best languages are compared at the end, so
any number of languages is judged whole.

The bytes are first folded: A-Z to a-z, digits and white space to one symbol
each. Every folded byte of the training rows is a symbol of its own, whatever
the script; only bytes that no training row holds share one.

Defined cases: null text, or text without a letter, is ``und`` with score 0; a
null doc_id is not held out and not trained on; rows without lang are not
trained on but predicted; with no training rows at all everything is ``und``;
repeated rows are predicted alike; ties go to the language first in order.
Columns besides doc_id, text and lang are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hublytics.llm.common import cut, slices

ORDER = 2
#: size of the tables that are broadcast together
GROUP_BYTES = 64 << 20
#: pairs of window and number that a counting task holds before it adds them up
HELD = 1 << 20
#: bytes coded at once
PIECE = 1 << 20
HELD_OUT = 2
UNKNOWN = "und"
#: score from which a prediction replaces a row's own lang
SURE = 0.999

#: folded bytes: A-Z -> a-z, digits -> '0', the white space of the contracts -> ' '
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
FOLD[48:58] = 48
FOLD[9:14] = 32

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its offsets (nulls are empty)."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    body = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[at[0]: at[-1]] if len(at) else body, at - at[0] if len(at) else at


def _pieces(body: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Runs of at most PIECE bytes of one text or of several whole texts:
    (bytes before and in the run, start of each text in the run, first text,
    bytes that belong to the context only)."""
    i, n = 0, len(at) - 1
    while i < n:
        if at[i + 1] - at[i] > PIECE:
            for s in range(int(at[i]), int(at[i + 1]), PIECE):
                lead = min(ORDER, s - int(at[i]))
                yield body[s - lead: min(s + PIECE, int(at[i + 1]))], np.array([0]), i, lead
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(at, at[i] + PIECE, "right")) - 1)
        yield body[at[i]: at[j]], at[i:j] - at[i], i, 0
        i = j


def _windows(symbols: np.ndarray, starts: np.ndarray, lead: int, base: int) -> np.ndarray:
    """For each byte the number of its window (the ORDER symbols before it and
    itself); before a text's first byte there is the symbol 0."""
    window = symbols.astype(np.int32)
    before = np.arange(len(symbols), dtype=np.int64)
    first = np.zeros(len(symbols), dtype=np.int64)
    own = starts[starts < len(symbols)]
    first[own] = own
    before -= np.maximum.accumulate(first)
    for k in range(1, ORDER + 1):
        window[k:] += np.where(before[k:] >= k, symbols[:-k], 0).astype(np.int32) * base ** k
    return window[lead:]


# -- training ----------------------------------------------------------------

def _byte_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(256, np.int64)
    for b in slices(batches):
        body, _ = _bytes(b.column("text"))
        for s in range(0, len(body), PIECE):
            total += np.bincount(FOLD[body[s: s + PIECE]], minlength=256)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["byte", "n"])


def _added(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    if not keys:
        return keys, n
    one, at = np.unique(np.concatenate(keys), return_inverse=True)
    return [one], [np.bincount(at, np.concatenate(n), len(one)).astype(np.int64)]


def _window_counts(symbol_of: np.ndarray, base: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = base ** (ORDER + 1)
        number: dict[str, int] = {}
        keys, counts = [], []
        for b in slices(batches):
            langs = b.column("lang").dictionary_encode()
            own_number = np.array([number.setdefault(x, len(number)) for x in langs.dictionary.to_pylist()], np.int64)
            lang_of = own_number[langs.indices.to_numpy(zero_copy_only=False)]
            body, at = _bytes(b.column("text"))
            for run, starts, i, lead in _pieces(body, at):
                w = _windows(symbol_of[run], starts, lead, base)
                lengths = np.diff(np.append(starts, len(run)))
                lengths[0] -= lead
                key, n = np.unique(np.repeat(lang_of[i: i + len(starts)], lengths) * size + w, return_counts=True)
                keys.append(key)
                counts.append(n)
                if sum(map(len, keys)) > HELD:
                    keys, counts = _added(keys, counts)
        names = np.array(list(number), object)
        keys, counts = _added(keys, counts)
        for key, n in zip(keys, counts, strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(names[key // size], pa.string()), pa.array(key % size, pa.int64()), pa.array(n, pa.int64())],
                                             ["lang", "window", "n"])
    return count


def code_lengths(windows: np.ndarray, n: np.ndarray, base: int) -> np.ndarray:
    """Bits of every window's last symbol under one language's context tree."""
    counts = np.zeros(base ** (ORDER + 1))
    counts[windows] = n
    # window number: last symbol + base * the one before + base^2 * ...
    tree = counts.reshape([base] * (ORDER + 1))  # axes: oldest symbol ... last symbol
    p = np.full(base, 1 / 256)
    for order in range(ORDER + 1):
        seen = tree.sum(axis=tuple(range(ORDER - order)))  # contexts of this order x last symbol
        total = seen.sum(axis=-1, keepdims=True)
        kinds = (seen > 0).sum(axis=-1, keepdims=True)
        weight = np.where(total > 0, total + kinds, 1)
        escape = np.where(total > 0, kinds / weight, 1.0)
        # a context of this order ends in the context one symbol shorter
        p = seen / weight + escape * np.broadcast_to(p, seen.shape)
    return -np.log2(p).reshape(-1)


def model_of(langs: list[str], symbol_of: np.ndarray, base: int, bits: np.ndarray) -> dict:
    """Frozen code lengths ``bits[language, window]`` and how to number windows."""
    return {"langs": langs, "symbol_of": symbol_of, "base": base, "bits": bits}


def _table_of(base: int):
    """One language's windows -> its code lengths."""
    def run(table: pa.Table) -> pa.Table:
        bits = code_lengths(table.column("window").to_numpy(), table.column("n").to_numpy(), base)
        return pa.table({"lang": table.column("lang").slice(0, 1), "bits": pa.array([bits.astype(np.float32).tobytes()], pa.binary())})
    return run


class Models:
    """Frozen tables of all languages, in groups that fit a broadcast."""

    def __init__(self, tables: DataFrame | None, langs: list[str], symbol_of: np.ndarray, base: int, group_bytes: int):
        self.tables, self.symbol_of, self.base = tables, symbol_of, base
        size = max(1, group_bytes // (4 * base ** (ORDER + 1)))
        self.groups = [langs[i: i + size] for i in range(0, len(langs), size)]

    def load(self, langs: list[str]) -> dict:
        rows = {r["lang"]: r["bits"] for r in self.tables.where(F.col("lang").isin(langs)).collect()}  # at most GROUP_BYTES
        return model_of(langs, self.symbol_of, self.base, np.stack([np.frombuffer(rows[x], np.float32) for x in langs]))


def train(docs: DataFrame, group_bytes: int = GROUP_BYTES) -> Models:
    """Learn from the rows of ``docs`` that have text and lang and are not
    held out."""
    rows = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).where(
        F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    used = (rows.select("text").mapInArrow(_byte_counts, "byte int, n long")
            .groupBy("byte").agg(F.sum("n").alias("n")).collect())  # at most 256 rows
    symbol_of = np.full(256, len(used) + 1, np.uint8)  # 0: before the text; last: a byte never seen
    for k, byte in enumerate(sorted(r["byte"] for r in used)):
        symbol_of[FOLD == byte] = k + 1
    base = len(used) + 2
    counts = cut(rows.select("text", "lang").mapInArrow(_window_counts(symbol_of, base), "lang string, window long, n long")
                 .groupBy("lang", "window").agg(F.sum("n").alias("n")), "language-windows")
    tables = cut(counts.groupBy("lang").applyInArrow(_table_of(base), "lang string, bits binary"), "language-tables")
    langs = sorted(r[0] for r in tables.select("lang").collect())
    return Models(tables, langs, symbol_of, base, group_bytes)


# -- scoring -----------------------------------------------------------------

def _code(model: dict, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Total bits of each text under each language, its bytes, and whether it
    has an ASCII letter."""
    body, at = _bytes(column)
    out = np.zeros((len(at) - 1, len(model["langs"])))
    letter = np.zeros(len(at) - 1, bool)
    for run, starts, i, lead in _pieces(body, at):
        if not len(run):
            continue
        w = _windows(model["symbol_of"][run], starts, lead, model["base"])
        full = np.flatnonzero(np.diff(np.append(starts, len(run))))  # texts that have bytes
        letter[i + full] |= np.logical_or.reduceat(LETTER[run], starts[full])
        for k in range(len(model["langs"])):
            out[i + full, k] += np.add.reduceat(np.take(model["bits"][k], w), starts[full] if lead == 0 else [0], dtype=np.float64)
    return out, np.diff(at), letter


def _best(model: dict, column: pa.Array) -> tuple[list[str | None], np.ndarray, np.ndarray, np.ndarray]:
    """Of each text the language with the shortest code (None without a
    letter), its bits, the sum over languages of 2 ** (its bits - their bits),
    and the text's bytes."""
    n = len(column)
    bits, size, has = _code(model, column)
    for i in np.flatnonzero(~has & (size > 0)):  # letters of other scripts
        has[i] = any(c.isalpha() for c in column[int(i)].as_py())
    best = bits.argmin(axis=1)
    least = bits[np.arange(n), best]
    weight = np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
    return [model["langs"][b] if h else None for b, h in zip(best, has, strict=True)], least, weight, size


def _judged(docs: DataFrame, row: str, model: dict) -> DataFrame:
    """``row``, lang, bits, weight, size of every row of ``docs`` under one group."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            lang, bits, weight, size = _best(shared.value, b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(bits), pa.array(weight),
                                              pa.array(size, pa.int64())], [row, "lang", "bits", "weight", "size"])

    return docs.select(row, "text").mapInArrow(run, f"{row} long, lang string, bits double, weight double, size long")


def annotate(docs: DataFrame, models: Models, prefix: str = "") -> DataFrame:
    """``docs`` with lang_pred, score and bits_per_byte (names after ``prefix``)."""
    names = [prefix + x for x in ("lang_pred", "score", "bits_per_byte")]
    if not models.groups:
        return docs.withColumns(dict(zip(names, (F.lit(UNKNOWN), F.lit(0.0), F.lit(0.0)), strict=True)))
    if len(models.groups) > 1:
        return _annotate_by_groups(docs, models, names)
    shared = docs.sparkSession.sparkContext.broadcast(models.load(models.groups[0]))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            lang, bits, weight, size = _best(shared.value, b.column(at))
            letters = np.array([x is not None for x in lang], bool)
            arrays = [pa.array([x or UNKNOWN for x in lang], pa.string()), pa.array(np.where(letters, 1 / weight, 0.0)),
                      pa.array(bits / np.maximum(size, 1))]
            yield pa.RecordBatch.from_arrays([*b.columns, *arrays], [*b.schema.names, *names])

    schema = type(docs.schema)([*docs.schema.fields])
    for name, kind in zip(names, ("string", "double", "double"), strict=True):
        schema = schema.add(name, kind)
    return docs.mapInArrow(run, schema)


def _annotate_by_groups(docs: DataFrame, models: Models, names: list[str]) -> DataFrame:
    """One pass a group; a row's groups are put together: the shortest code
    wins, the weights are taken relative to it."""
    numbered = cut(docs.withColumn("__language_row", F.monotonically_increasing_id()), "language-docs")
    parts = [cut(_judged(numbered, "__language_row", models.load(g)), "language-judged") for g in models.groups]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    one = F.struct("bits", "lang", "weight")
    per_row = union.groupBy("__language_row").agg(F.collect_list(one).alias("all"), F.max("size").alias("size"))  # a row a group
    best = F.array_min("all")
    total = F.aggregate("all", F.lit(0.0), lambda s, x: s + x["weight"] * F.pow(F.lit(2.0), F.greatest(best["bits"] - x["bits"], F.lit(-1000.0))))
    found = per_row.select("__language_row", F.coalesce(best["lang"], F.lit(UNKNOWN)).alias(names[0]),
                           F.when(best["lang"].isNotNull(), 1 / total).otherwise(0.0).alias(names[1]),
                           (best["bits"] / F.greatest("size", F.lit(1))).alias(names[2]))
    return numbered.join(found, "__language_row").drop("__language_row")


def predict(docs: DataFrame, models: Models | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits_per_byte for every row."""
    out = annotate(docs.select("doc_id", "text"), models or train(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def keep_languages(docs: DataFrame, max_bits_per_byte: float = 8.0, sure: float = SURE) -> DataFrame:
    """``docs`` without the rows that no language accepts: no letters, or no
    language's model codes the text shorter than plain bytes do. Where ``lang``
    is null, or the prediction differs and is ``sure``, it is the prediction."""
    out = annotate(docs, train(docs), "__llm_")
    kept = out.where((F.col("__llm_lang_pred") != UNKNOWN) & (F.col("__llm_bits_per_byte") < max_bits_per_byte))
    kind = docs.schema["lang"].dataType
    told = F.when(F.col("lang").isNull() | (F.col("__llm_score") >= sure), F.col("__llm_lang_pred").cast(kind)).otherwise(F.col("lang"))
    return kept.withColumn("lang", told).select(*[F.col(f"`{c}`") for c in docs.columns])
