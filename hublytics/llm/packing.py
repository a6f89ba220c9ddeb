"""Packing token sequences by reciprocal-capacity (harmonic) classes.

Class k holds pieces of floor(CAPACITY / k) tokens, and k of them fill a
sequence. A document is cut greedily: as many full sequences as it has, then
the largest class that the rest still fills, and so on; a last rest of fewer
than MIN_PIECE tokens is a piece of the class its length belongs to. Each cut
leaves a rest of less than a k-th of what was there, so a tail needs about
three pieces. All pieces of a class have the same length, so a piece's place
follows from its number in the class alone: sequence number div k, at
(number mod k) * length. Padding is below k tokens in a full sequence of
class k (CAPACITY mod k), and none in classes that divide the capacity.

How it runs: tokenizing and cutting is one pass over the texts, written once
because it is the expensive part. Numbers are taken inside (class, bucket) and
shifted by earlier buckets' counts, so no class is one task. Each class has
fewer than k pieces over; these leftovers of all classes number at most
LEFTOVERS whatever the table's size, and are packed largest first, without
cuts, into mixed sequences by one small task.

Ids come from the vocabulary file of a byte-level BPE. With ``added_tokens``
the file's added tokens inside a text have their own ids, as the file's own
library gives by default; without it they are ordinary text. Id END follows
each document's ids.
Defined cases: null text is empty (its only id is END); white space of any
length is encoded as the library does; repeated rows are
packed each; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hublytics.llm.common import cut, positions, slices

CAPACITY = 2048
MIN_PIECE = 32
END = 1
BUCKET_ROWS = 200_000
#: the pre-tokenisation of the vocabulary, written without backtracking but for white space before a
#: word, of which the last character is given back: longer runs than LONG_SPACE are cut there beforehand
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
LONG_SPACE = 10_000
_SPACES = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_LONG_RUN = re.compile(f"{_SPACES}{{{LONG_SPACE},}}+(?={_SPACES.replace('[', '[^', 1)})")


def parts(text: str, special: dict[str, int]) -> list[str]:
    """``text`` cut inside long white space where the tokenizer cuts it too:
    before the last character of a run, unless an added token follows (the run
    is then one piece, and nothing is given back)."""
    out, at = [], 0
    if len(text) > LONG_SPACE:
        for m in _LONG_RUN.finditer(text):
            if not any(text.startswith(t, m.end()) for t in special):
                out.append(text[at: m.end() - 1])
                at = m.end() - 1
    return [*out, text[at:]]


def classes(total: int, capacity: int = CAPACITY, min_piece: int = MIN_PIECE) -> list[tuple[int, int, int]]:
    """(start, length, class) of the pieces that ``total`` tokens are cut into."""
    out, at = [], 0
    while at < total:
        rest = total - at
        k = 1 if rest >= capacity else -(-capacity // rest)
        if rest < min_piece:
            length, k = rest, capacity // rest
        else:
            length = capacity // k
        out.append((at, length, k))
        at += length
    return out


def leftovers(capacity: int = CAPACITY, min_piece: int = MIN_PIECE) -> int:
    """A bound of the pieces that do not fill a sequence of their class."""
    kinds = {k for r in range(1, capacity + 1) for *_, k in classes(r, capacity, min_piece)[:1]}
    return sum(k - 1 for k in kinds)


def ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id of a byte-level BPE vocabulary file (JSON). Ids are in
    the order of the merges. Printable Latin-1 stands for its own byte; the
    other bytes are written as the characters from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in own}
    byte_of.update({chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in own)})
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", [])}
    return {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}


def added_ids(path: str) -> dict[str, int]:
    """Content -> id of the added tokens of a vocabulary file."""
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f).get("added_tokens", [])
    for t in tokens:
        if t.get("single_word") or t.get("lstrip") or t.get("rstrip"):
            raise ValueError(f"added token {t['content']!r} takes text around it into account")
    return {t["content"]: t["id"] for t in tokens}


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, min_piece: int = MIN_PIECE,
           added_tokens: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, class."""
    spark: SparkSession = docs.sparkSession
    # a vocabulary is one small file, read once by the driver
    shared = spark.sparkContext.broadcast((ranks(vocabulary), added_ids(vocabulary) if added_tokens else {}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken
        known, special = shared.value
        encoding = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=known, special_tokens=special)
        for b in slices(batches):
            source, rows = [], []
            for i, text in enumerate(b.column(1)):
                ids = array("I")
                for part in parts(text.as_py() or "", special):
                    ids.extend(encoding.encode(part, allowed_special="all"))
                ids.append(END)
                raw = memoryview(ids.tobytes())
                for start, length, k in classes(len(ids), capacity, min_piece):
                    source.append(i)
                    rows.append((start, length, zlib.crc32(raw[4 * start: 4 * (start + length)]), len(ids), k))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(source, pa.int64())), *(pa.array(c, pa.int64()) for c in columns[:4]),
                 pa.array(columns[4], pa.int32())],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "class"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, class int")


def _fill(capacity: int):
    """Largest first into the first sequence with room; sequence numbers are negative."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        used: list[int] = []
        at, offset = [], []
        for n in table.column("length").to_pylist():
            for b, full in enumerate(used):
                if full + n <= capacity:
                    break
            else:
                b = len(used)
                used.append(0)
            at.append(-1 - b)
            offset.append(used[b])
            used[b] += n
        return table.drop_columns(["grp"]).append_column("sequence_id", pa.array(at, pa.int64())).append_column(
            "offset", pa.array(offset, pa.int64()))
    return run


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY,
         min_piece: int = MIN_PIECE, bucket_rows: int = BUCKET_ROWS, added_tokens: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, class, sequence_id, offset."""
    rows = pieces(docs, vocabulary or vocabulary_path(), capacity, min_piece, added_tokens)
    rows = cut(rows, "pack-pieces")
    buckets = max(16, rows.count() // bucket_rows)
    own = F.xxhash64("doc_id", "start", "ids_crc32")
    rows = rows.withColumns({"key": own, "bucket": F.pmod(own, F.lit(buckets))})
    counts = rows.groupBy("class").agg(F.count(F.lit(1)).alias("of_class"))
    numbered = positions(rows, ["class"], "bucket", ["key", "doc_id", "start"], "number").join(counts, "class")
    numbered = cut(numbered.drop("key", "bucket").withColumn("over", F.expr("number >= of_class div class * class")), "pack-numbers")
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "class"]
    regular = numbered.where("not over").select(
        *cols, F.expr("class * 1099511627776L + number div class").alias("sequence_id"),
        F.expr("number % class * length").alias("offset"))
    over = numbered.where("over").select(*cols, F.lit(0).alias("grp"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rest = over.groupBy("grp").applyInArrow(
        _fill(capacity), f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, class int, "
                         "sequence_id long, offset long")
    return regular.unionByName(rest)
