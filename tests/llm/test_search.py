"""Lexical search, hard negatives and quality rules against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hublytics.llm import hard_negatives, lexical_search, quality_rules
from hublytics.llm.best import Best
from hublytics.llm.common import read

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def ranked(docs, items, k):
    """The contract, restated."""
    bags = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    n = sum(bool(b) for _, b in bags)
    total = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for doc, bag in bags:
            s = 0
            for t in set(TERM.findall(lower(text))) & set(bag):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                m = 100 - 50 + (50 * sum(bag.values()) * n) // total
                s += w * (10 ** 9 * bag[t] // (1000 * bag[t] + 20 * m))
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc))
        scores.sort(key=lambda r: r[:3])
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


ITEMS = [(0, None), (1, ""), (2, "É é one ONE one_two 7"), (2, "one two"), (None, "changed1 same id other text 😀"), (5, "unheard of")]


@pytest.mark.parametrize("k, block_pairs", [(50, 1 << 17), (3, 2)])
def test_lexical_search(spark, awkward, k, block_pairs):
    rows = awkward.select("doc_id", "text").collect()
    some = [(10 + n, r.text[:300]) for n, r in enumerate(rows[6:40:4]) if r.text]
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS + some], "item_id long, text string, item string")
    found = lexical_search.search(awkward, items, k, block_pairs)
    got = sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()], key=str)
    assert got == ranked([tuple(r) for r in rows], ITEMS + some, k)


def test_lexical_search_empty(spark, awkward, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical_search.search(nothing, items).count() == 0
    assert lexical_search.search(awkward, items.where("false")).count() == 0
    assert lexical_search.search(awkward, items.where("item_id < 2")).count() == 0


def test_partial_sums_stay_exact(monkeypatch):
    rng = np.random.default_rng(1)
    impacts = rng.integers(0, 10 ** 6, (40, 300)).astype(float)
    w = rng.integers(0, 30000, (300, 7)).astype(float)
    want = impacts.astype(np.int64) @ w.astype(np.int64)
    cols = np.arange(300)
    assert (lexical_search._scores(impacts, cols, w) == want).all()
    monkeypatch.setattr(lexical_search, "EXACT", 10 ** 12)  # runs of some 30 terms
    assert (lexical_search._scores(impacts, cols, w) == want).all()


def test_best_is_tie_safe():
    rng = random.Random(2)
    for _ in range(30):
        k, best, seen = rng.randint(1, 4), None, [[] for _ in range(3)]
        best = Best(3, k)
        ids = list(range(60))
        rng.shuffle(ids)
        for at in range(0, 60, 20):
            tile = np.array(ids[at: at + 20])
            score = np.array([[rng.randint(0, 3) for _ in tile] for _ in range(3)])
            allowed = np.array([[rng.random() < 0.8 for _ in tile] for _ in range(3)])
            best.offer(np.arange(3), score, tile, allowed)
            for a in range(3):
                seen[a] += [(-score[a, j], int(i)) for j, i in enumerate(tile) if allowed[a, j]]
        got = list(zip(best.who.tolist(), (-best.score).tolist(), best.id.tolist(), strict=True))
        assert got == [(a, *x) for a in range(3) for x in sorted(seen[a])[:k]]


def mined(rows, every, positives, negatives):
    """(row, vec_id, label, ints) -> the contract's rows."""
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for row, vid, label, v in rows:
        if vid % every:
            continue
        own = sorted((-dot(v, w), i) for r, i, lab, w in rows if lab == label and r != row)[:positives]
        other = sorted((-dot(v, w), i) for _, i, lab, w in rows if lab != label)
        for s, i in own:
            fits = [(n, j) for n, j in other if 30 * -s <= 100 * -n <= 90 * -s][:negatives]
            out += [(vid, i, r, j, -s, -n) for r, (n, j) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 8])
def test_hard_negatives(spark, block):
    rng = random.Random(5)
    rows = []
    for i in range(700):  # clusters, ties and repeats
        centre = [rng.choice([-0.5, 0, 0.25, 0.5]) for _ in range(6)] if i % 7 == 0 else centre
        rows.append((i, [c + rng.choice([0.0, 0.0, 0.03125, -0.0625]) for c in centre], rng.choice([0, 0, 0, 1, 2])))
    rows += [(3, None, 1), (None, rows[0][1], 1), (7, [None, 1.0], 1), (9, [float("nan")], 1), (10, [float("inf")], 2), (20, [0.5], None),
             (30, [0.5, 0.5], 0), (40, [0.0] * 6, 0), (50, [], 1), rows[100], rows[100], (60, [2.0] * 9, 2)]
    table = spark.createDataFrame([(*r, "c", 1) for r in rows], "vec_id long, embedding array<double>, label int, cluster string, row int")
    usable = [(n, i, lab, [math.floor(256 * x) for x in v]) for n, (i, v, lab) in enumerate(rows)
              if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    got = sorted(tuple(r) for r in hard_negatives.mine(table.repartition(3), 10, block=block).collect())
    assert got == mined(usable, 10, 5, 10)
    few = sorted(tuple(r) for r in hard_negatives.mine(table, 10, positives=2, negatives=1).collect())
    assert few == mined(usable, 10, 2, 1)


def test_hard_negatives_large_numbers_and_empty(spark):
    rng = random.Random(6)
    rows = [(i, [float(rng.randint(-10 ** 6, 10 ** 6)) for _ in range(4)], i % 3) for i in range(60)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    ints = [(i, i, lab, [256 * int(x) for x in v]) for i, v, lab in rows]  # products beyond 2^53
    assert sorted(tuple(r) for r in hard_negatives.mine(table, 5).collect()) == mined(ints, 5, 5, 10)
    assert hard_negatives.mine(table.where("false"), 5).count() == 0
    assert hard_negatives.mine(table, 1000).where("anchor_id != 0").count() == 0


def test_noisy_labels(spark):
    rows = spark.createDataFrame([(7, 9), (8, 9), (14, None), (None, 3)], "vec_id long, label int")
    assert [r.label for r in hard_negatives.noisy_labels(rows).collect()] == [0, 9, None, 3]


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i: i + 8]), []).append(i)
    repeated = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated), n < 20 or 100 * len(repeated) > 30 * n)


ODD = ["a b c d e f g h a b c d e f g h", "x " * 40, "same\nsame \nsame\n\n \n\nsame", "é é \x1c ü\x85ü 😀 #*$%&|<>\r\n\x0b\x0c",
       "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 9 0 " * 3, "w " * 7, "w " * 8, "w " * 9, "\n\n", "\x00 a"]


def test_quality_counts(spark, awkward, nothing):
    docs = awkward.select("doc_id", "text", "lang", "source", "row").union(spark.createDataFrame(
        [(900 + i, t, None, "o", "r") for i, t in enumerate(ODD)], "doc_id long, text string, lang string, source string, row string"))
    docs = docs.union(read(spark, SF, "documents").selectExpr("doc_id + 2000", "text", "lang", "source", "'r'"))
    want = sorted([(r.doc_id, *base(r.text)) for r in docs.collect()], key=str)
    got = quality_rules.judge(docs).select("doc_id", *quality_rules.BASE, "base_failed").collect()
    assert sorted(map(tuple, got), key=str) == want
    assert quality_rules.judge(nothing).count() == 0
    assert quality_rules.judge(docs.where("text is null")).where("kept").count() == 0


def plain_mcd(rows):
    """The method of a unit, restated over sorted rows."""
    x = np.array(rows, dtype=np.int64)
    n, p = x.shape
    floor = np.eye(p) * (quality_rules.RESOLUTION * quality_rules.GRAIN) ** 2
    cell = lambda d: np.floor(np.log(d + 1e-6) * quality_rules.CELLS)
    ordered = np.sort(x, axis=0)
    q = [ordered[max(0, -(-n * k // 4) - 1)] for k in (1, 2, 3)]
    mean, cov = q[1].astype(float), np.diag(((q[2] - q[0]) / 1.349) ** 2) + floor
    far = lambda: np.einsum("ni,ij,nj->n", x - mean, np.linalg.inv(cov), x - mean)
    det = np.inf
    for _ in range(quality_rules.STEPS):
        c = cell(far())
        last = np.sort(c)[math.ceil(n * quality_rules.SUBSET) - 1]
        chosen = x[c <= last]
        m, s = chosen.mean(axis=0), np.cov(chosen.T, bias=True) + floor
        if np.linalg.slogdet(s)[1] >= det - 1e-9:
            break
        mean, cov, det = m, s, np.linalg.slogdet(s)[1]
    scale = max(1.0, np.exp((np.sort(cell(far()))[(n + 1) // 2 - 1] + 1) / quality_rules.CELLS) / quality_rules.chi_square(0.5, p))
    chosen = x[cell(far()) <= np.floor(np.log(scale * quality_rules.chi_square(0.975, p) + 1e-6) * quality_rules.CELLS)]
    mean, cov = chosen.mean(axis=0), np.cov(chosen.T, bias=True) + floor
    given = np.maximum(far() - (x[:, -1] - mean[-1]) ** 2 / cov[-1, -1], 0)
    scale = max(1.0, np.exp((np.sort(cell(given))[(n + 1) // 2 - 1] + 1) / quality_rules.CELLS) / quality_rules.chi_square(0.5, p - 1))
    return given / (scale * quality_rules.chi_square(quality_rules.QUANTILE, p - 1))


def test_quality_outliers(spark):
    rng = random.Random(11)
    vocab = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(600)]
    prose = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    rows = []
    for i in range(500):
        rows.append((i, prose(rng.randint(25, 400)) + ".", "en", "hot"))
    copy = prose(200)
    rows += [(1000 + i, copy, "en", "hot") for i in range(250)]       # a third are copies
    rows += [(2000 + i, prose(rng.randint(25, 400)), "de", f"s{i % 9}") for i in range(300)]  # pooled by language
    rows += [(3000 + i, "7 " + prose(60), None, "few") for i in range(5)]  # pooled over all
    junk = [" | ".join(vocab[:60]), prose(60).upper() + "!!", " ".join(f"{w}###" for w in vocab[:60]), "12345 67890 555 " * 2 + prose(30)]
    rows += [(4000 + i, t, lang, "hot") for i, (t, lang) in enumerate((t, g) for t in junk for g in ("en", "de"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    good = [r for i, r in found.items() if i < 3000]
    assert all(r.kept for r in good)
    assert not any(found[4000 + i].kept for i in range(6))
    assert {r.unit for r in good} == {'{"lang":"en","source":"hot"}', '{"lang":"de"}'} and found[3000].unit == "{}"
    again = {r.doc_id: r for r in quality_rules.judge(docs.repartition(7, F.rand(3))).collect()}
    assert found == again  # whatever the partitions
    names = quality_rules._features()
    counted = quality_rules.statistics(docs).select("doc_id", "lang", "source", *[
        F.floor(f * quality_rules.GRAIN + 0.5).cast("long").alias(n) for n, f in names.items()]).collect()
    for unit in (lambda r: r.lang == "en" and r.source == "hot", lambda r: r.lang == "de", lambda r: True):
        of = [r for r in counted if unit(r)]
        for r, want in zip(of, plain_mcd([tuple(r)[3:] for r in of]), strict=True):
            if found[r.doc_id].unit == {"en": '{"lang":"en","source":"hot"}', "de": '{"lang":"de"}'}.get(r.lang, "{}") and unit(r):
                if len(of) == len(counted) and r.lang:
                    continue
                assert found[r.doc_id].distance == pytest.approx(want, rel=1e-5, abs=2e-6), r.doc_id


def test_quality_without_an_estimate(spark, awkward):
    kept = quality_rules.keep_good(awkward, min_rows=10 ** 6)
    assert kept.columns == awkward.columns
    want = sorted(str(tuple(r)) for r in awkward.collect() if not base(r.text)[-1])
    assert sorted(str(tuple(r)) for r in kept.collect()) == want
