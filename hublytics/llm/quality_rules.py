"""Quality rules: fixed rules, then robust multivariate outliers.

Every text gives counts (words, symbols, repeated lines, repeated 8-word
windows and the like). The fixed rules reject texts of fewer than MIN_WORDS
words and texts in which more than REPEAT_PERCENT of the words lie in a
repeated 8-word window. The texts that pass give a vector of transformed
statistics (FEATURES: logarithms of means, arc sines of the roots of shares).
For each language and source the minimum covariance determinant (MCD) gives a
centre and a covariance of the most compact SUBSET of the vectors, and a text
whose Mahalanobis distance is beyond the cut is rejected. Length alone is no
fault: it is part of the vector, so that what goes with it (fewer distinct
words in long texts) is known, and the distance used is the one given the
length, d2(all) - d2(length). Repeated lines and windows are left to the fixed
rules: most texts have none, so that one short repeated line in a clean text
would be an outlier.

How the MCD is found. One start: medians and quartile ranges by component.
Then concentration steps: distances to the current estimate, the SUBSET of
least distance, its mean and covariance, until no unit's determinant falls. A step is one
aggregation: rows are combined map-side into cells of the logarithm of the
distance, each with its count, sums and sums of products; a running count over a
unit's cells finds the cell that completes the subset, so that no unit's rows
are ever gathered or sorted (a subset ends with a whole cell). Units have numbers, as joins by a whole number take a small
hash table. Components are
integers (units of 1/GRAIN), so all sums are exact and the result does not
depend on partitions or order. A last reweighting uses all rows within the
97.5 % ellipsoid, scaled by the median distance.

Units: (lang, source) where it has MIN_ROWS rows that pass the rules, else
all rows of the lang, else all rows; with fewer rows than that altogether
there is no estimate and the fixed rules decide alone. RESOLUTION is added to
every component's variance, so a unit full of copies has a finite covariance.

Defined cases: a null text counts as empty (no words, fails); null lang or
source count as empty; rows that repeat are rows of their own; an empty table
gives none. Further columns are ignored.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hublytics.llm.common import cut, slices

MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
GRAIN = 1024
#: in the units of FEATURES; differences below it are no reason to reject
RESOLUTION = 0.05
SUBSET = 0.75
STEPS = 12
#: rows for an estimate of its own
MIN_ROWS = 200
#: a text is rejected beyond this quantile of the chi-square distribution
QUANTILE = 1 - 1e-9
#: cells of the distance for each factor of e
CELLS = 32

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_upper", "n_letters",
          "n_digits", "n_marks"]
BASE = COUNTS[:5]

_SPACE, _SYMBOL, _UPPER, _LOWER, _DIGIT, _MARK, _FIRST = (1 << k for k in range(7))


def _classes() -> np.ndarray:
    kind = np.zeros(256, np.uint8)
    kind[0x21:0x7F] = _MARK
    kind[[0x20, *range(0x09, 0x0E)]] = _SPACE
    kind[list(b"#*$%&|<>")] = _SYMBOL
    kind[ord("0"): ord("9") + 1] = _DIGIT
    kind[ord("A"): ord("Z") + 1] = _UPPER
    kind[ord("a"): ord("z") + 1] = _LOWER
    kind[0xC0:] = _LOWER
    kind[:0x80] |= _FIRST
    kind[0xC0:] |= _FIRST  # bytes that begin a code point
    return kind


def _repeated_words(ids: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which words lie in a WINDOW that its text holds twice or more. Windows
    are named by doubling: equal names mean equal words."""
    covered = np.zeros(len(ids) + 1, np.int64)
    if len(ids) < WINDOW:
        return covered[:-1] > 0
    name, width = ids.astype(np.int64), 1
    while width < WINDOW:
        pair = name[:-width] * (name.max() + 1) + name[width:]
        name, width = np.unique(pair, return_inverse=True)[1], 2 * width
    start = np.flatnonzero(text[:len(name)] == text[WINDOW - 1:])
    key = text[start] * (name.max() + 1) + name[start]
    _, at, n = np.unique(key, return_inverse=True, return_counts=True)
    again = start[n[at] > 1]
    covered[again] += 1
    covered[again + WINDOW] -= 1
    return np.cumsum(covered)[:-1] > 0


def _dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def _count(texts: list[bytes]) -> dict[str, np.ndarray]:
    kind = _classes()
    size = np.array([len(t) + 1 for t in texts])
    starts = np.concatenate([[0], np.cumsum(size)[:-1]])
    joined = b"\n".join(texts) + b"\n"
    kinds = kind[np.frombuffer(joined, np.uint8)]
    total = lambda flag: np.add.reduceat(flag, starts, dtype=np.int64)
    some = lambda bits: (kinds & bits) != 0
    space = some(_SPACE)
    begins = ~space & np.concatenate([[True], space[:-1]])
    n_words = total(begins)
    text = np.repeat(np.arange(len(texts)), n_words)
    # bytes.split() parts at the six white-space bytes of the rules and no others
    ids = pa.array(joined.split(), pa.binary()).dictionary_encode().indices.to_numpy()
    distinct = np.unique(text * (int(ids.max(initial=0)) + 1) + ids) // (int(ids.max(initial=0)) + 1)
    per_text = lambda which: np.bincount(which, minlength=len(texts))
    return {"n_words": n_words, "word_chars": total(some(_FIRST) & ~space), "n_symbols": total(some(_SYMBOL)),
            "n_dup_lines": np.array([_dup_lines(t) for t in texts]), "n_repeat_words": per_text(text[_repeated_words(ids, text)]), "n_distinct": per_text(distinct),
            "n_upper": total(some(_UPPER)), "n_letters": total(some(_UPPER | _LOWER)),
            "n_digits": total(some(_DIGIT)), "n_marks": total(some(_MARK))}


def _count_batches(batches):
    for b in slices(batches):
        if not b.num_rows:
            continue
        counts = _count([t or b"" for t in b.column(3).cast(pa.binary()).to_pylist()])
        yield pa.RecordBatch.from_arrays([*b.columns[:3], *[pa.array(counts[n], pa.int64()) for n in COUNTS]],
                                         [*b.schema.names[:3], *COUNTS])


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source (null: empty) and COUNTS of every text."""
    named = docs.select("doc_id", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], "text")
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named.schema.fields[:3])
    return named.mapInArrow(_count_batches, kept + "".join(f", {c} long" for c in COUNTS))


def _features() -> dict[str, Column]:
    share = lambda a, b: F.asin(F.sqrt(F.least(F.col(a) / F.greatest(F.col(b), F.lit(1)), F.lit(1.0))))
    return {
        "word": F.ln((F.col("word_chars") + 1) / (F.col("n_words") + 1)),
        "symbols": share("n_symbols", "word_chars"),
        "marks": share("n_marks", "word_chars"),
        "upper": share("n_upper", "n_letters"),
        "digits": share("n_digits", "word_chars"),
        "variety": F.ln(F.col("n_distinct") + 1) / F.ln(F.col("n_words") + 2),
        "length": F.ln(F.col("n_words") + 1),  # last: the distance is taken given it
    }


FEATURES = ["word", "symbols", "marks", "upper", "digits", "variety", "length"]
_P = len(FEATURES)
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]


def chi_square(quantile: float, p: int) -> float:
    """Quantile of the chi-square distribution (Wilson and Hilferty's cube)."""
    z = NormalDist().inv_cdf(quantile)
    return p * (1 - 2 / (9 * p) + z * (2 / (9 * p)) ** 0.5) ** 3


def _distance(full: bool) -> Column:
    """Squared Mahalanobis distance to a unit's (mean, prec); unless ``full``,
    given the length."""
    away = [F.col(f) - F.col("mean")[i] for i, f in enumerate(FEATURES)]
    total = F.lit(0.0)
    for k, (i, j) in enumerate(_PAIRS):
        total += away[i] * away[j] * F.col("prec")[k]
    return total if full else F.greatest(total - away[-1] * away[-1] * F.col("prec_length"), F.lit(0.0))


_ESTIMATE = "unit long, n long, mean array<double>, prec array<double>, prec_length double, logdet double, scale double"


def _invert(mean: np.ndarray, cov: np.ndarray) -> dict:
    prec = np.linalg.inv(cov)
    return {"mean": mean.tolist(), "prec": [prec[i, j] * (1 if i == j else 2) for i, j in _PAIRS], "prec_length": 1 / cov[-1, -1],
            "logdet": float(np.linalg.slogdet(cov)[1])}


def _from_quartiles(batches):
    """The start: medians and quartile ranges."""
    for b in batches:
        rows = b.to_pylist()
        out = []
        for r in rows:
            q = np.array(r["quartiles"], np.float64)  # components x 3
            spread = (q[:, 2] - q[:, 0]) / 1.349
            out.append({"unit": r["unit"], "n": r["n"], "scale": 1.0,
                        **_invert(q[:, 1], np.diag(spread ** 2 + (RESOLUTION * GRAIN) ** 2)), "logdet": float("inf")})
        yield pa.RecordBatch.from_pylist(out, _schema())


def _from_moments(batches):
    for b in batches:
        out = []
        for r in b.to_pylist():
            m = int(r["m"])
            mean = np.array([float(s) for s in r["sums"]]) / m
            cov = np.zeros((_P, _P))
            for (i, j), s in zip(_PAIRS, r["products"], strict=True):
                # whole numbers until the division: no cancellation
                cov[i, j] = cov[j, i] = (int(s) * m - int(r["sums"][i]) * int(r["sums"][j])) / (m * m)
            cov += np.eye(_P) * (RESOLUTION * GRAIN) ** 2
            out.append({"unit": r["unit"], "n": r["n"], "scale": 1.0, **_invert(mean, cov)})
        yield pa.RecordBatch.from_pylist(out, _schema())


def _schema() -> pa.Schema:
    doubles = pa.list_(pa.float64())
    return pa.schema([("unit", pa.int64()), ("n", pa.int64()), ("mean", doubles), ("prec", doubles), ("prec_length", pa.float64()),
                      ("logdet", pa.float64()), ("scale", pa.float64())])


def _start(rows: DataFrame) -> DataFrame:
    listed = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.col(f).alias("v")) for i, f in enumerate(FEATURES)])).alias("c")
    cells = rows.select("unit", listed).groupBy("unit", "c.k", "c.v").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("unit", "k").orderBy("v")
    running = cells.withColumn("upto", F.sum("n").over(order)).withColumn("all", F.sum("n").over(Window.partitionBy("unit", "k")))
    quartile = [F.min(F.when(F.col("upto") * 4 >= F.col("all") * q, F.col("v"))) for q in (1, 2, 3)]
    found = running.groupBy("unit", "k").agg(F.max("all").alias("n"), F.array(*quartile).alias("q"))
    units = found.groupBy("unit").agg(F.max("n").alias("n"),
                                      F.expr("transform(array_sort(collect_list(struct(k, q))), x -> x.q)").alias("quartiles"))
    return units.mapInArrow(_from_quartiles, _ESTIMATE)


def _cell(distance: Column) -> Column:
    return F.floor(F.ln(distance + 1e-6) * CELLS).cast("int")


def _cells(rows: DataFrame, units: DataFrame, which: Column | None = None) -> DataFrame:
    """Rows combined by cell of their distance: count, sums, sums of products."""
    placed = rows.join(units, "unit").where(F.lit(True) if which is None else which).withColumn("cell", _cell(_distance(True)))
    return placed.groupBy("unit", "cell").agg(
        F.first("n").alias("n"), F.count(F.lit(1)).alias("m"), F.array(*[F.sum(f) for f in FEATURES]).alias("sums"),
        F.array(*[F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])) for i, j in _PAIRS]).alias("products"))


def _moments(cells: DataFrame) -> DataFrame:
    # sums over a unit's cells (a few hundred rows): beyond 64 bits is possible here
    wide = lambda c, k: F.sum(F.col(c)[k].cast("decimal(38,0)"))
    return cells.groupBy("unit").agg(F.max("n").alias("n"), F.sum("m").alias("m"),
                                     F.array(*[wide("sums", i) for i in range(_P)]).alias("sums"),
                                     F.array(*[wide("products", k) for k in range(len(_PAIRS))]).alias("products"))


def _concentrate(rows: DataFrame, units: DataFrame) -> DataFrame:
    """One concentration step for all units."""
    cells = _cells(rows, units)
    before = Window.partitionBy("unit").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    chosen = cells.withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0))).where(F.col("before") < F.col("n") * SUBSET)
    return _moments(chosen).mapInArrow(_from_moments, _ESTIMATE)


def _within(rows: DataFrame, units: DataFrame) -> DataFrame:
    """The reweighting: mean and covariance of all rows inside 97.5 %."""
    scaled = cut(_scaled(rows, units, full=True), "quality-scale")
    inside = _cell(_distance(True)) <= _cell(F.col("scale") * F.lit(chi_square(0.975, _P)))
    return _moments(_cells(rows, scaled, inside)).mapInArrow(_from_moments, _ESTIMATE)


def _scaled(rows: DataFrame, units: DataFrame, full: bool) -> DataFrame:
    """Units with ``scale``: the factor by which the median distance exceeds
    that of a normal distribution (1 at least)."""
    counts = rows.join(units, "unit").groupBy("unit", _cell(_distance(full)).alias("cell")).agg(
        F.first("n").alias("n"), F.count(F.lit(1)).alias("m"))
    running = counts.withColumn("upto", F.sum("m").over(Window.partitionBy("unit").orderBy("cell")))
    middle = running.where(F.col("upto") * 2 >= F.col("n")).groupBy("unit").agg(F.min("cell").alias("cell"))
    median = F.exp((F.col("cell") + 1) / CELLS) / chi_square(0.5, _P if full else _P - 1)
    return units.drop("scale").join(middle.select("unit", F.greatest(median, F.lit(1.0)).alias("scale")), "unit")


def _units(counted: DataFrame, min_rows: int) -> DataFrame:
    """lang, source, unit (the one that judges it), name, also (all units that
    it is part of)."""
    groups = counted.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    groups = cut(groups.withColumn("group", F.monotonically_increasing_id()), "quality-groups")
    small, same = F.col("n") < min_rows, Window.partitionBy("lang")
    groups = cut(groups.withColumns({"n_lang": F.sum("n").over(same), "some_small": F.max(small).over(same),
                                     "lang_unit": -2 - F.min("group").over(same)}), "quality-groups")
    few = F.col("n_lang") < min_rows
    total, all_needed = groups.agg(F.sum("n"), F.max(few & small)).first()
    whole = F.lit(-1 if (total or 0) >= min_rows else None).cast("long")
    pick = lambda own, lang, rest: F.when(~small, own).when(~few, lang).otherwise(rest)
    also = F.array(F.when(~small, F.col("group")), F.when(F.col("some_small") & ~few, F.col("lang_unit")),
                   whole if all_needed else F.lit(None).cast("long"))
    return groups.select("lang", "source", pick(F.col("group"), F.col("lang_unit"), whole).alias("unit"),
                         pick(F.to_json(F.struct("lang", "source")), F.to_json(F.struct("lang")), F.lit("{}")).alias("name"),
                         F.filter(also, lambda x: x.isNotNull()).alias("also"))


def estimate(counted: DataFrame, min_rows: int = MIN_ROWS, steps: int = STEPS) -> tuple[DataFrame, DataFrame]:
    """(units with mean, prec, scale; lang, source -> unit) from the rows of
    ``counted`` (FEATURES as whole numbers) that pass the fixed rules."""
    groups = cut(_units(counted, min_rows), "quality-units")
    members = counted.join(groups.select("lang", "source", "also"), ["lang", "source"])
    rows = cut(members.select(F.explode("also").alias("unit"), *FEATURES), "quality-rows")
    units = cut(_start(rows), "quality-start")
    for _ in range(steps):
        after = cut(_concentrate(rows, units), "quality-step")
        falls = cut(after.join(units.select("unit", F.col("logdet").alias("was")), "unit").where(F.col("logdet") < F.col("was") - 1e-9),
                    "quality-falls")
        # a unit whose determinant no longer falls keeps its estimate
        kept = units.join(falls.select("unit"), "unit", "left_anti")
        units = cut(kept.unionByName(falls.drop("was")), "quality-step")
        if falls.isEmpty():
            break
    units = cut(_within(rows, units), "quality-within")
    return cut(_scaled(rows, units, full=False), "quality-estimate"), groups


def judge(docs: DataFrame, min_rows: int = MIN_ROWS, quantile: float = QUANTILE) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept; unit (the estimate used) and distance (as a multiple of
    the cut; null where the fixed rules decide alone)."""
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)
    counted = statistics(docs).withColumn("base_failed", failed)
    whole = [F.floor(f * GRAIN + 0.5).cast("long").alias(n) for n, f in _features().items()]
    counted = cut(counted.select("doc_id", "lang", "source", *BASE, "base_failed", *whole), "quality-counts")
    units, groups = estimate(counted.where(~F.col("base_failed")), min_rows)
    named = counted.join(groups.select("lang", "source", F.col("unit"), F.col("name")), ["lang", "source"], "left")
    joined = named.join(units, "unit", "left").withColumn("unit", F.when(F.col("unit").isNotNull(), F.col("name")))
    distance = F.when(~F.col("base_failed"), _distance(False) / (F.col("scale") * F.lit(chi_square(quantile, _P - 1))))
    return (joined.withColumn("distance", F.round(distance, 6))
            .select("doc_id", *BASE, "base_failed", (~F.col("base_failed") & F.coalesce(F.col("distance") <= 1, F.lit(True))).alias("kept"),
                    "unit", "distance"))


def keep_good(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    numbered = cut(docs.withColumn("__row", F.monotonically_increasing_id()), "quality-docs")
    verdict = judge(numbered.select(F.col("__row").alias("doc_id"), "text", "lang", "source"), **parameters)
    return numbered.join(verdict.where("kept").select(F.col("doc_id").alias("__row")), "__row", "left_semi").drop("__row")
