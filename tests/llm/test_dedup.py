import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from hublytics.llm import exact_dedup, line_dedup, near_dedup
from hublytics.llm.common import read

SPACE = re.compile(r"[\x20\x09-\x0D]")


def expected_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[SPACE.sub("", r.text or "")].append(r)
    out = []
    for norm, rs in groups.items():
        best = min(rs, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
        for r in rs:
            out.append((r.doc_id, best.doc_id, len(rs), hashlib.sha256(norm.encode()).hexdigest()))
    return out


def order(rows):
    return sorted(rows, key=str)


def test_exact_dedup_against_brute_force(awkward):
    # small blocks, so that texts go through several levels of names
    for block in (16, 4096):
        got = exact_dedup.exact_dedup(awkward, block_bytes=block).collect()
        want = expected_exact(awkward.collect())
        assert order((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == order(want)
        kept = defaultdict(int)
        for r in got:
            kept[r.text_sha256] += r.kept
            assert not r.kept or r.doc_id == r.keep_id
        assert set(kept.values()) == {1}


def test_exact_dedup_with_clashing_routes(awkward):
    """Blocks that share a routing key are told apart by their content."""
    got = exact_dedup.exact_dedup(awkward, block_bytes=64, key=lambda b: F.octet_length(b).cast("long") % 3).collect()
    assert order((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == order(expected_exact(awkward.collect()))


def test_keep_first_leaves_one_row_of_each_text(awkward):
    left = exact_dedup.keep_first(awkward)
    assert left.columns == awkward.columns
    norms = [SPACE.sub("", r.text or "") for r in left.collect()]
    assert len(norms) == len(set(norms)) == len({SPACE.sub("", r.text or "") for r in awkward.collect()})


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return set()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)}


def expected_near(rows, size, percent):
    sets = [shingles(r.text, size) for r in rows]
    comp = list(range(len(rows)))

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                comp[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            least[root(i)] = min(least.get(root(i), r.doc_id), r.doc_id)
    return [(r.doc_id, len(sets[i]), least.get(root(i))) for i, r in enumerate(rows)]


def test_near_dedup_against_brute_force(awkward):
    rows = awkward.collect()
    for size in (2, 5):
        got = near_dedup.near_dedup(awkward, size=size).collect()
        assert order((r.doc_id, r.n_shingles, r.component_id) for r in got) == order(expected_near(rows, size, 80))
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_dedup_of_a_large_group(awkward, monkeypatch):
    """Groups beyond one chunk: dealt twice, then component against component."""
    monkeypatch.setattr(near_dedup, "CHUNK", 4)
    got = near_dedup.near_dedup(awkward, size=2).collect()
    assert order((r.doc_id, r.n_shingles, r.component_id) for r in got) == order(expected_near(awkward.collect(), 2, 80))


def test_cross_check_finds_what_the_deals_miss(spark, monkeypatch):
    """One candidate group whose links run in a chain over many chunks."""
    monkeypatch.setattr(near_dedup, "CHUNK", 3)
    words = [f"w{i}" for i in range(160)]
    rows = [(i, " ".join(words[i: i + 40])) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.near_dedup(docs, size=2).collect()
    want = expected_near(docs.collect(), 2, 80)
    assert order((r.doc_id, r.n_shingles, r.component_id) for r in got) == order(want)
    assert len({c for *_, c in want}) < 100


def test_shingles_over_piece_ends(monkeypatch):
    import pyarrow as pa
    texts = ["a bb  ccc dddd " * 30, "x" * 200, None, "", "p q", "é ü\tö\x0b1"]
    want = [s.tolist() for s in near_dedup.shingle_sets(pa.array(texts), 2)]
    assert [len(s) for s in want] == [len(shingles(t, 2)) for t in texts]
    monkeypatch.setattr(near_dedup, "PIECE", 50)
    assert [s.tolist() for s in near_dedup.shingle_sets(pa.array(texts), 2)] == want




def test_line_dedup(spark, awkward):
    passage = "Here begins a passage, which several documents share. It has more than twenty words, all told; and it ends here."
    rows = [(1, f"Own words of the first one. {passage} More of the first."),
            (2, f"Other words\nof the second {passage} And its end."),
            (3, f"third: {passage}\n{passage}"), (4, "Own words of the first one."), (5, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.line_dedup(docs, min_words=10).collect()}
    assert got[1].text == rows[0][1] and got[1].n_removed == 0
    # the first unit of the pasted passage runs into the host's words; the rest goes
    assert got[2].n_removed == 1 and "several documents" not in got[2].text and got[2].text.startswith("Other words\nof the second")
    span = got[2].removed[0]
    assert rows[1][1][span.start:span.end].strip().endswith("ends here.") and span.keep_doc_id == 1
    assert got[2].text == rows[1][1][:span.start] + rows[1][1][span.end:]
    assert "documents" not in got[3].text.replace("\n", " ").split("passage,")[-1] or got[3].n_removed >= 1
    assert got[4].text == rows[3][1], "a short run stays"
    assert got[5].text is None and got[6].text == ""


def test_line_dedup_keeps_the_rest_and_the_first(awkward):
    rows = awkward.collect()
    got = line_dedup.line_dedup(awkward, min_words=1).collect()
    assert len(got) == len(rows)
    seen = defaultdict(set)
    for r in got:  # every unit of the table is still somewhere, and in one document only
        cut = lambda t: "".join(c for i, c in enumerate(t) if not any(x.start <= i < x.end for x in r.removed))  # noqa: E731, B023
        own = next(o.text or "" for o in rows if o.doc_id == r.doc_id and cut(o.text or "") == (r.text or ""))
        for start, _, w in line_dedup.units(own):
            if not any(x.start <= start < x.end for x in r.removed):
                seen[tuple(w)].add(r.doc_id)
    all_units = {tuple(w) for r in rows for _, _, w in line_dedup.units(r.text or "")}
    assert set(seen) == all_units
    assert max(len(v) for v in seen.values()) == 1


def test_line_dedup_of_short_lines(spark):
    """With the query's own parameters: a repeated whole line goes whatever its length."""
    rows = [(1, "Own words.\nSee licence: all, rights.\nShort line here\nlast of one"),
            (2, "SEE licence:  all, rights.\nof two\nshort line  here\nend of two"),
            (3, "In a line: Short line here\nand See licence: all, rights. too"), (4, "of four\nof four\nOwn words. and more"),
            (5, "last of one"), (None, "of four"), (None, "of none\nof none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = defaultdict(list)
    for r in line_dedup.line_dedup(docs).collect():
        got[r.doc_id].append((r.text, [s.keep_doc_id for s in r.removed]))
    words = {i: sorted((t.split(), k) for t, k in found) for i, found in got.items()}
    assert words[1] == [(rows[0][1].split(), [])] and words[3] == [(rows[2][1].split(), [])], "clauses of other lines stay"
    assert words[2] == [("of two end of two".split(), [1, 1])]
    assert words[4] == [("of four Own words. and more".split(), [4])]
    assert words[5] == [([], [1])]
    assert words[None] == [([], [4]), (["of", "none"], [None])]


def test_line_dedup_of_pasted_passages(spark):
    """With the query's own parameters: 50 words pasted into running lines of two documents."""
    import random
    rng = random.Random(11)
    vocab = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    prose = lambda n: [rng.choice(vocab) for _ in range(n)]
    rows = []
    for i in range(300):
        passage = prose(50)
        if i % 2:  # clauses of 8 to 22 words
            for at in range(rng.randint(7, 21), 50, 15):
                passage[at] += ","
        rows += [(2 * i + k, " ".join([*prose(rng.randint(5, 60)), *passage, *prose(rng.randint(5, 60))])) for k in (0, 1)]
    got = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts, gone = dict(rows), []
    for r in got:
        if r.doc_id % 2:
            assert r.n_removed == 1 and r.removed[0].keep_doc_id < r.doc_id
            gone.append(sum(len(texts[r.doc_id][s.start:s.end].split()) for s in r.removed))
        else:
            assert r.n_removed == 0
    assert min(gone) >= line_dedup.MIN_WORDS and sum(gone) / len(gone) > 0.8 * 50


def test_empty_tables(nothing):
    assert exact_dedup.exact_dedup(nothing).count() == 0
    assert exact_dedup.keep_first(nothing).count() == 0
    assert near_dedup.near_dedup(nothing).count() == 0
    assert line_dedup.line_dedup(nothing).count() == 0


def plain_units(text):
    """(start, end, words, line) of a text's units, word by word."""
    import re
    from zlib import crc32
    words = [(m.start(), m.end(), m[0].lower(), text.count("\n", 0, m.start())) for m in re.finditer(r"\S+", text)]
    clauses, clause = [], []
    for i, w in enumerate(words):
        clause.append(i)
        if w[2][-1] in ".!?,;:" or i + 1 == len(words) or words[i + 1][3] != w[3]:
            clauses.append(clause)
            clause = []
    out, at = [], 0
    for clause in clauses:
        h = [crc32(words[i][2].encode()) * 2654435761 % 2 ** 32 for i in clause]
        stops = {len(clause) - 1}
        for k in range(len(clause) - 8):
            least = min(h[k: k + 9])
            stops.add(max(j for j in range(k, k + 9) if h[j] == least))
        first = 0
        for j in sorted(stops):
            end, word, line = words[clause[j]][1:]
            if j == len(clause) - 1 and word[-1] not in ".!?,;:":
                brk = text.find("\n", end)
                end = len(text) if brk < 0 else brk + 1
            out.append((at, end, tuple(words[i][2] for i in clause[first: j + 1]), line))
            at, first = end, j + 1
    return out


def plain_dedup(docs, min_words):
    rows = []  # doc, words, unit, line
    for doc, text in docs:
        us = plain_units(text or "")
        of_line = defaultdict(list)
        for n, u in enumerate(us):
            of_line[u[3]].append(n)
        rows += [(doc, u[2], n, u[3] if len(of_line[u[3]]) == 1 else None) for n, u in enumerate(us)]
        rows += [(doc, sum((us[n][2] for n in ns), ()), None, line) for line, ns in of_line.items() if len(ns) > 1]
    by_words = defaultdict(list)
    for r in rows:
        by_words[r[1]].append(r)
    unit_marks, line_marks = defaultdict(dict), defaultdict(dict)
    for same in by_words.values():
        if len(same) == 1:
            continue
        keep, line_keep = min(r[0] for r in same), min((r[0] for r in same if r[3] is not None), default=None)
        order = lambda r: (r[2] is not None, r[2] or 0, r[3] or 0)
        kept = sorted((r for r in same if r[0] == keep or r[3] is not None and r[0] == line_keep), key=order)
        for r in same:
            earlier = [k for k in kept if k[0] == r[0] and order(k) < order(r)]
            if r[2] is not None and (r[0] != keep or earlier):
                unit_marks[r[0]][r[2]] = keep
            if r[3] is not None and (r[0] != line_keep or any(k[3] is not None for k in earlier)):
                line_marks[r[0]][r[3]] = line_keep
    out = {}
    for doc, text in docs:
        spans, run = [], []
        for n, u in [*enumerate(plain_units(text or "")), (None, None)]:
            if n is not None and (n in unit_marks[doc] or u[3] in line_marks[doc]):
                run.append((n, u))
                continue
            if sum(len(u[2]) for _, u in run) >= min_words:
                parts = [run]
            else:
                parts, last = [], None
                for n_u in run:
                    sure = n_u[1][3] in line_marks[doc]
                    if sure and last:
                        parts[-1].append(n_u)
                    elif sure:
                        parts.append([n_u])
                    last = sure
            for p in parts:
                line = p[0][1][3]
                spans.append((p[0][1][0], p[-1][1][1], line_marks[doc].get(line, unit_marks[doc].get(p[0][0]))))
            run = []
        out[doc] = spans
    return out


def test_line_dedup_equals_a_plain_restatement(spark):
    """At the query's own parameters, over whole texts."""
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    texts += [(9000 + i, t) for i, t in enumerate(["é\x1cü. É \n\n", "ΑΣ ας ΑΣ\nας ας ας", "a, b; c\n\na, b; c\nx a, b; c", "\n \n", "no end mark\n" * 3])]
    made = spark.createDataFrame(texts, "doc_id long, text string")
    want = plain_dedup(texts, line_dedup.MIN_WORDS)
    got = line_dedup.line_dedup(made).collect()
    assert {r.doc_id: [(s.start, s.end, s.keep_doc_id) for s in r.removed] for r in got} == want
    assert sum(map(len, want.values())) > 100
    for r in got:
        own = dict(texts)[r.doc_id]
        left = "".join(c for i, c in enumerate(own or "") if not any(a <= i < b for a, b, _ in want[r.doc_id]))
        assert (r.text or "") == left
