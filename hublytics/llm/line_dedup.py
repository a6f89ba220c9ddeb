"""Substring dedup by hashing lines and units of lines.

A line that is the same as an earlier whole line is removed whatever its
length. So that a passage pasted into the middle of a line is found too, lines
are cut into units: after sentence and clause marks, and inside clauses after
the word of the least hash of every WINDOW neighbouring words (winnowing). Where
a clause is cut depends on WINDOW words only and no unit is longer than WINDOW,
so of a passage at most 2 * WINDOW - 1 words at each end belong to units that
hold words of the host: the rest of a passage of 50 words is always a run of
MIN_WORDS. Lines and units are normalised (lower case, single spaces) and
hashed to 128 bits (a polynomial of their words' hashes); of each digest the occurrence in the smallest doc_id (then
the first in that document) is kept, of whole lines the first whole line.
Consecutive repeated units make a run; runs of at least MIN_WORDS words are
removed, of shorter ones (common phrases) only the repeated whole lines. What
is removed is given by its positions in the original text.

How it runs: one pass turns texts into digests; texts are lexed many at a time
as arrays, and each different word of them is hashed once. A first aggregation (map-side
combined) finds the digests that occur more than once by half of their bits;
only units of those go further, where the whole digest decides. Both joins
read written tables, so AQE can split a line that a third of all documents
share. A document's repeated units come together again as unit numbers, a
bounded part of that document, and its text is read once more to cut them.

Positions are code points, end exclusive. Defined cases: null text stays null
and has no units; rows that repeat doc_id and text are one document and are
treated alike; rows that share a doc_id but not the text are ranked by a
checksum of the text; a null doc_id ranks last; columns besides doc_id and
text are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hublytics.llm.common import cut, discard, slices

MIN_WORDS = 16
WINDOW = 9
#: characters that are lexed together
PIECE = 1 << 21
_ENDS = np.zeros(128, bool)
_ENDS[[ord(c) for c in ".!?,;:"]] = True
#: the characters at which ``str.split`` parts words; all beyond the table are none
_SPACE = np.array([chr(c).isspace() for c in range(0x3001)] + [False])
#: odd bases of the two polynomials over whole numbers mod 2 ** 64, with their inverses
_BASES = [0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93]
_INVERSES = [pow(b, -1, 1 << 64) for b in _BASES]


def _chosen(h: np.ndarray, clause: np.ndarray) -> np.ndarray:
    """Numbers of the words with the least hash (the last of equal ones) among
    any WINDOW neighbouring words of one clause."""
    n = len(h) - WINDOW + 1
    inside = np.flatnonzero(clause[:max(n, 0)] == clause[WINDOW - 1:])
    if not len(inside):
        return inside
    best, at = h[:n].copy(), np.zeros(n, np.int64)
    for k in range(1, WINDOW):
        less = h[k: k + n] <= best
        best[less] = h[k: k + n][less]
        at[less] = k
    return (at + np.arange(n))[inside]


class _Lexed:
    """The units of several texts, as arrays: text, number in the text, line
    (of the text), start and end (code points of the text), and the range
    first .. last of their words."""

    def __init__(self, texts: list[str]):
        joined = "\n".join(texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        edge = np.diff(_SPACE[np.minimum(points, len(_SPACE) - 1)].astype(np.int8), prepend=1)
        begins, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        size = np.array([len(t) + 1 for t in texts])
        self.text_at = np.cumsum(size) - size
        breaks = np.flatnonzero(points == 10)
        closes = np.isin(breaks, self.text_at + size - 1)  # the end of a text, not a line end of it
        # the words themselves: each different one is hashed once
        coded = pa.array(joined.lower().split(), pa.string()).dictionary_encode()
        self.code, self.unique = coded.indices.to_numpy(), coded.dictionary.cast(pa.binary()).to_pylist()
        weak = np.array([crc32(w) for w in self.unique], np.uint32) * np.uint32(2654435761)
        of_text = np.searchsorted(self.text_at, begins, "right") - 1
        line = np.searchsorted(breaks, begins)
        last_char = points[ends - 1]
        marked = _ENDS[np.minimum(last_char, 127)] & (last_char < 127)
        last = np.append(line[1:] != line[:-1], True)[:len(line)]
        cuts = marked | last
        cuts[_chosen(weak[self.code], np.cumsum(cuts) - cuts)] = True
        stops = np.flatnonzero(cuts)
        # a line without a closing mark takes its line end along
        stop_at = np.where(last & ~marked, (breaks + 1 - closes)[line], ends)[stops] if len(line) else ends
        self.text, self.global_line = of_text[stops], line[stops]
        self.line = self.global_line - np.searchsorted(breaks, self.text_at)[self.text]
        self.first, self.last = np.append(0, stops[:-1] + 1)[:len(stops)], stops + 1
        self.first_of_text = np.searchsorted(self.text, np.arange(len(texts)))
        self.number = np.arange(len(stops)) - self.first_of_text[self.text]
        before = np.append(0, stop_at[:-1])[:len(stops)]
        self.start = np.where(self.number == 0, 0, before - self.text_at[self.text])
        self.end = stop_at - self.text_at[self.text]

    def digests(self, first: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
        """Two 64-bit numbers of the words first .. last: polynomials of the
        words' hashes, taken from running sums, and mixed."""
        strong = np.frombuffer(b"".join(hashlib.blake2b(w, digest_size=16).digest() for w in self.unique), np.uint64).reshape(-1, 2)
        n, out = len(self.code), []
        for k in range(2):
            power = np.multiply.accumulate(np.append(np.uint64(1), np.full(n, _BASES[k], np.uint64)))
            back = np.multiply.accumulate(np.append(np.uint64(1), np.full(n, _INVERSES[k], np.uint64)))
            sums = np.append(np.uint64(0), np.cumsum(strong[self.code, k] * power[:n], dtype=np.uint64))
            h = (sums[last] - sums[first]) * back[first] + (last - first).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
            for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                h = (h ^ (h >> np.uint64(shift))) * np.uint64(by)
            out.append((h ^ (h >> np.uint64(31))).view(np.int64))
        return out


def _pieces(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most PIECE characters together (or one text)."""
    at = size = 0
    for i, t in enumerate(texts):
        if i > at and size + len(t) > PIECE:
            yield at, i
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


def units(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """(start, end, words) of the units of ``text`` that have words."""
    words, u = text.lower().split(), _Lexed([text])
    for i in range(len(u.text)):
        yield int(u.start[i]), int(u.end[i]), words[u.first[i]: u.last[i]]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units have a ``unit`` number, whole lines a ``line`` number, units that
    are a whole line both."""
    for b in slices(batches):
        texts = [t or "" for t in b.column(2).to_pylist()]
        for lo, hi in _pieces(texts):
            u = _Lexed(texts[lo:hi])
            n = len(u.text)
            if not n:
                continue
            begins = np.flatnonzero(np.append(True, u.global_line[1:] != u.global_line[:-1]))
            stops = np.append(begins[1:], n)
            alone = np.repeat(stops - begins == 1, stops - begins)  # a unit that is a whole line
            several = stops - begins > 1
            head, tail = begins[several], stops[several] - 1
            d1, d2 = u.digests(np.append(u.first, u.first[head]), np.append(u.last, u.last[tail]))
            none = np.zeros(len(head), bool)
            rows = pa.array(lo + np.append(u.text, u.text[head]))
            numbers = pa.array(np.append(u.number, none).astype(np.int32), mask=np.append(np.zeros(n, bool), ~none))
            lines = pa.array(np.append(u.line, u.line[head]).astype(np.int32), mask=np.append(~alone, none))
            yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), numbers, lines, pa.array(d1), pa.array(d2)],
                                             ["doc_id", "text_key", "unit", "line", "d1", "d2"])


def _removed(texts: list[str], marks: list[dict[str, np.ndarray]], min_words: int) -> tuple[np.ndarray, ...]:
    """(text, start, end, mark whose keeper is meant, whether as a line) of
    what goes. ``marks``: per text the numbers unit and line (-1: none) and the
    mark's row ``at``."""
    u = _Lexed(texts)
    n = len(u.text)
    keeper, whole = np.full(n, -1), np.full(n, -1)
    for i, m in enumerate(marks):
        lo = u.first_of_text[i]
        hi = u.first_of_text[i + 1] if i + 1 < len(texts) else n
        of_unit = m["unit"] >= 0
        keeper[lo + m["unit"][of_unit]] = m["at"][of_unit]
        of_line = m["line"] >= 0
        if of_line.any():
            by_line = np.full(u.line[lo:hi].max(initial=0) + 1, -1)
            by_line[m["line"][of_line]] = m["at"][of_line]
            whole[lo:hi] = by_line[u.line[lo:hi]]
    repeated, sure = (keeper >= 0) | (whole >= 0), whole >= 0
    new_text = np.append(True, u.text[1:] != u.text[:-1])[:n]
    begins = lambda flag: flag & (new_text | ~np.append(False, flag[:-1])[:n])
    run = np.cumsum(begins(repeated) | (~repeated)) - 1  # every other unit is a run of its own
    words = np.bincount(run, (u.last - u.first) * repeated, run.max(initial=-1) + 1) if n else np.zeros(0)
    goes = repeated & ((words[run] >= min_words) | sure) if n else repeated
    first = np.flatnonzero(begins(goes))
    last = np.flatnonzero(goes & np.append(begins(goes)[1:] | ~goes[1:] | new_text[1:], True)[:n])
    of_line = sure[first]
    return u.text[first], u.start[first], u.end[last], np.where(of_line, whole[first], keeper[first]), of_line


def _cut_runs(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts, listed = b.column(1).to_pylist(), b.column(2)
            flat = pa.concat_arrays([listed.flatten()])
            counts = np.array(listed.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
            at = np.cumsum(counts) - counts
            number = {c: flat.field(c).fill_null(-1).to_numpy(zero_copy_only=False) for c in ("unit", "line")}
            some = np.flatnonzero(counts)
            found = []
            for lo, hi in _pieces([texts[i] for i in some]):
                here = some[lo:hi]
                marks = [{"at": (r := np.arange(at[i], at[i] + counts[i])), "unit": number["unit"][r], "line": number["line"][r]} for i in here]
                of, *rest = _removed([texts[i] for i in here], marks, min_words)
                found.append((here[of], *rest))
            text, start, end, mark, of_line = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 5
            offsets = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
            for i in np.unique(text):
                parts, done = [], 0
                for s in range(offsets[i], offsets[i + 1]):
                    parts.append(texts[i][done: start[s]])
                    done = end[s]
                texts[i] = "".join([*parts, texts[i][done:]])
            line_mark, unit_mark = pa.array(mark, pa.int64(), mask=~of_line.astype(bool)), pa.array(mark, pa.int64(), mask=of_line.astype(bool))
            by_line, by_unit = flat.field("line_keep_id").take(line_mark), flat.field("keep_doc_id").take(unit_mark)
            keep = pa.compute.if_else(pa.array(of_line.astype(bool)), by_line, by_unit)
            span = pa.StructArray.from_arrays([pa.array(start, pa.int32()), pa.array(end, pa.int32()), keep], ["start", "end", "keep_doc_id"])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.ListArray.from_arrays(pa.array(offsets), span)],
                                             ["doc_id", "text", "removed"])
    return run


def repeated_units(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, unit, keep_doc_id, line, line_keep_id: the units that
    have an earlier twin and the lines that repeat an earlier whole line."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    all_units = cut(docs.select("doc_id", "text_key", "text").mapInArrow(
        _digests, f"doc_id {kind}, text_key long, unit int, line int, d1 long, d2 long"), "line-units")
    often = cut(all_units.groupBy("d1").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("d1"), "line-often")
    occ = cut(all_units.join(often, "d1", "left_semi"), "line-occurrences")
    discard(all_units)  # the largest table; what is needed of it is written
    first = cut(occ.groupBy("d1", "d2").agg(
        F.min("doc_id").alias("keep_doc_id"), F.min(F.when(F.col("line").isNotNull(), F.col("doc_id"))).alias("line_keep_id"),
        F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"), "line-first")
    both = occ.join(first, ["d1", "d2"])
    own = F.col("doc_id").eqNullSafe(F.col("keep_doc_id"))
    own_line = F.col("doc_id").eqNullSafe(F.col("line_keep_id"))
    marks = lambda df, unit, line: df.select(
        "doc_id", "text_key", F.when(unit, F.col("unit")).alias("unit"), "keep_doc_id",
        F.when(line, F.col("line")).alias("line"), "line_keep_id").where("unit is not null or line is not null")
    later = marks(both, ~own, ~own_line)
    # inside the document that keeps it, a unit's or a whole line's first place stays
    rank = lambda *of: F.dense_rank().over(Window.partitionBy("doc_id", "d1", "d2", *of).orderBy("text_key", "unit", "line"))
    kept = both.where(own | (F.col("line").isNotNull() & own_line)).withColumns(
        {"r": rank(), "r_line": rank(F.col("line").isNull())})
    again = marks(kept, own & (F.col("r") > 1), own_line & (F.col("r_line") > 1))
    return later.union(again)


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, text without the repeated lines and runs,
    n_removed, removed (array of start, end in the original, keep_doc_id)."""
    rows = docs.select("doc_id", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_key"), "text")
    marks = (repeated_units(rows).groupBy("doc_id", "text_key")
             .agg(F.collect_set(F.struct("unit", "keep_doc_id", "line", "line_keep_id")).alias("marks"))
             .select(F.col("doc_id").alias("m_id"), F.col("text_key").alias("m_key"), "marks"))
    marks = cut(marks, "line-marks")
    joined = rows.join(marks, F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("text_key") == F.col("m_key")), "left")
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = joined.select("doc_id", "text", "marks").mapInArrow(
        _cut_runs(min_words), f"doc_id {kind}, text string, removed array<struct<start:int,end:int,keep_doc_id:{kind}>>")
    return out.select("doc_id", "text", F.size("removed").cast("long").alias("n_removed"), "removed")
