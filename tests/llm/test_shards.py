"""Sharding, mixing, packing, top-k search and the pipeline."""

import math
import random
import zlib
from array import array
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hublytics.llm import mixing, packing, sharding, topk_search
from hublytics.llm.common import read

SF = "/root/testdata/sf0.001"


def test_sharding_counts_slots_and_mixture(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    got = sharding.shard(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in docs.collect())
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    assert set(by) == set(range(40)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    sources = Counter(r.source for r in got)
    for rows in by.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
        own = Counter(r.source for r in rows)
        for s, n in sources.items():
            assert abs(own[s] - n * len(rows) / len(got)) < 1.5
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert all(r.size == len(texts[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) for r in got)


def test_sharding_does_not_depend_on_its_buckets(awkward, nothing):
    a = sharding.shard(awkward, shards=7).collect()
    b = sharding.shard(awkward, shards=7, bucket_rows=1).collect()
    assert sorted(map(str, a)) == sorted(map(str, b)) and len(a) == awkward.count()
    n = Counter(r.shard for r in a)
    assert max(n.values()) - min(n.values()) <= 1
    assert sharding.shard(nothing).count() == 0


def test_mixing_reaches_the_targets(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    cells = mixing.probabilities(mixing.facts(docs), rate=0.3, rounds=40).toPandas()
    assert cells.probability.between(0, 1).all()
    budget = 0.3 * cells.tokens.sum()
    by = cells.groupby("source")
    want = by.tokens.sum() ** 0.5 / (by.tokens.sum() ** 0.5).sum()
    # raking ends with topic: source and language are close, not exact
    assert (by.weight.sum() / budget - want).abs().max() < 0.02


def test_mixing_given_targets(spark):
    rows = [(i, "w " * 9, "en" if i % 4 else "de", "a" if i % 3 else "b") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    targets = {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.6, "de": 0.4}, "topic": {"prose": 1.0}}
    out = mixing.decide(docs, rate=0.4, rounds=30, targets=targets).toPandas()
    kept = out[out.selected]
    assert abs(len(kept) - 800) < 100
    assert abs((kept.source == "a").mean() - 0.5) < 0.07 and abs((kept.lang == "de").mean() - 0.4) < 0.07


def test_mixing_edge_cases(awkward, nothing):
    out = mixing.decide(awkward)
    assert out.count() == awkward.count()
    assert {r.topic for r in out.collect()} <= {"prose", "code", "legal", "contact"}
    left = mixing.mix(awkward)
    assert left.columns == awkward.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(r.doc_id for r in out.collect() if r.selected)
    assert mixing.decide(nothing).count() == 0 and mixing.mix(nothing).count() == 0


def test_packing_is_an_exact_partition(spark, awkward):
    from tokenizers import Tokenizer
    public = Tokenizer.from_file(packing.vocabulary_path())
    public.encode_special_tokens = True
    docs = read(spark, SF, "documents").select("doc_id", "text").union(
        awkward.where("doc_id is not null").dropDuplicates(["doc_id"]).select(F.col("doc_id") + 10_000, "text")).union(
        spark.createDataFrame([(20_000, "<|endoftext|> it's  \n\n a b　 '’s 12½ \x1c")], "doc_id long, text string"))
    ids = {r.doc_id: [*public.encode(r.text or "", add_special_tokens=False).ids, packing.END] for r in docs.collect()}
    got = packing.pack(docs).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(ids)
    for i, rows in pieces.items():
        at = 0
        for r in sorted(rows, key=lambda r: r.start):
            own = ids[i][r.start: r.start + r.length]
            assert r.start == at and len(own) == r.length and r.doc_tokens == len(ids[i])
            assert r.ids_crc32 == zlib.crc32(array("I", own).tobytes())
            at += r.length
        assert at == len(ids[i])
    padding = 0
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.CAPACITY
        padding += packing.CAPACITY - at if at & (at - 1) else 0
    assert padding < 0.03 * sum(map(len, ids.values()))


def test_packing_added_tokens(spark, tmp_path):
    """The query gives the ids of the file's own library with its default setting."""
    from tokenizers import Tokenizer
    from hublytics.llm.queries import QUERIES
    public = Tokenizer.from_file(packing.vocabulary_path())
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x  <|endoftext|>  y\n", "<|endoftext", "it's<|endoftext|>'s", "", "é <|endoftext|>" * 900]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op6_packing"](spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} == set(range(len(texts)))
    for r in rows:
        ids = [*public.encode(texts[r.doc_id], add_special_tokens=False).ids, packing.END]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(array("I", ids[r.start: r.start + r.length]).tobytes())


def test_harmonic_classes():
    lengths = {}
    for total in range(1, 6000, 7):
        parts = packing.classes(total)
        assert sum(n for _, n, _ in parts) == total and len(parts) < 12
        for _, n, k in parts:
            assert n * k <= packing.CAPACITY and lengths.setdefault(k, n) == n
    assert packing.leftovers() < 20_000


def test_packing_edge_cases(awkward, nothing):
    got = packing.pack(awkward, bucket_rows=1)
    assert {r.doc_id for r in got.collect()} == {r.doc_id for r in awkward.collect()}
    assert packing.pack(nothing).count() == 0


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [(i, [float((i * j) % 17) / 7 - 1 for j in range(1, 9)]) for i in range(300)]
    rows += [(i, [0.5] * 8) for i in range(300, 500)]               # one very common vector
    rows += [(500, None), (550, [1.0, None]), (600, [float("nan")] * 8), (650, [float("inf"), 1.0]), (700, [3.0]), (750, [])]
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, shard string, row int")


def test_topk_against_brute_force(vectors):
    import math
    rows = {}
    for r in vectors.collect():
        if r.embedding is not None and all(x is not None and math.isfinite(x) for x in r.embedding):
            rows[r.vec_id] = [math.floor(256 * x) for x in r.embedding]
    want = []
    for q in (i for i in rows if i % 50 == 0):
        scored = sorted((-sum(a * b for a, b in zip(rows[q], v, strict=False)), i) for i, v in rows.items() if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    for shard_rows, block_rows in ((4096, 8192), (40, 3)):
        got = topk_search.top_k(vectors, every=50, shard_rows=shard_rows, block_rows=block_rows).collect()
        assert sorted(map(tuple, got)) == sorted(want)


def test_topk_edge_cases(spark, vectors):
    assert topk_search.top_k(vectors.limit(0), every=50).count() == 0
    assert topk_search.top_k(vectors.where("vec_id in (50, 51)"), every=50).select("rank", "vec_id").collect() == [(1, 51)]
    twice = vectors.where("vec_id = 100").union(vectors.where("vec_id = 100"))
    assert [r.vec_id for r in topk_search.top_k(twice, every=50).collect()] == [100, 100]
    large = spark.createDataFrame([(0, [3e6, -1.0]), (50, [2.9e6, 1.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in topk_search.top_k(large, every=50).collect()}
    assert got[0, 50] == int(256 * 3e6) * int(256 * 2.9e6) - 256 * 256


def test_topk_sends_queries_only_where_a_bound_allows(spark, monkeypatch):
    """Eight far directions: a query's results lie in its own; most shards are not asked."""
    rng = random.Random(8)
    rows = []
    for i in range(1600):
        v = [rng.uniform(-0.05, 0.05) for _ in range(8)]
        v[i % 8] += 1
        rows.append((i, v))
    asked = []
    whole = topk_search.asked_shards

    def counted(trees, packed, shards, blocks):
        out = topk_search.cut(whole(trees, packed, shards, blocks), "counted")
        asked.append((shards, out.groupBy().sum("n").first()[0] or 0))
        return out
    monkeypatch.setattr(topk_search, "asked_shards", counted)
    monkeypatch.setattr(topk_search, "PACK", 7)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk_search.top_k(table, every=20, shard_rows=40, block_rows=9).collect()))
    ints = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    want = []
    for q in range(0, 1600, 20):
        best = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=True)), i) for i, v in ints.items() if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert got == sorted(want)
    (shards, sent), = asked
    assert shards >= 40 and sent < 80 * (shards - 1) / 3


def test_pipeline(spark):
    docs = read(spark, SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "near_dedup", "mixing", "packing"]
    sizes = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns
        docs = after.cache()
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_pipeline_of_awkward_rows(spark, awkward, nothing):
    for table in (awkward, nothing):
        docs = table
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF).cache()
            docs.count()


def test_queries_match_their_sql(spark):
    from hublytics.llm.queries import ORACLE, QUERIES
    from oracle.compare import duck_connect, duck_rows, rows_hash, spark_rows
    con = duck_connect(SF)
    for name, sql in ORACLE.items():
        left, right = rows_hash(*spark_rows(QUERIES[name](spark, SF))), rows_hash(*duck_rows(con, sql))
        assert left[:2] == right[:2], name


@pytest.mark.parametrize("text", [" " * 5_000_000 + "a", "x" + "\t" * 300_000 + "y\n" + "\n" * 20_000 + " <|endoftext|> b", "a" + " " * 50_000,
                                  "　" * 30_000 + "é" + " " * 10_000 + "<|endoftext|>" + "\r\n" * 9_000 + "z" + " \x1c" * 12_000 + "q"])
def test_packing_of_long_white_space(spark, text):
    """The ids are those of the file's own library, whatever the white space."""
    from tokenizers import Tokenizer
    import tiktoken
    public = Tokenizer.from_file(packing.vocabulary_path())
    special = packing.added_ids(packing.vocabulary_path())
    encoding = tiktoken.Encoding("bpe", pat_str=packing.PATTERN, mergeable_ranks=packing.ranks(packing.vocabulary_path()), special_tokens=special)
    got = [i for part in packing.parts(text, special) for i in encoding.encode(part, allowed_special="all")]
    assert got == public.encode(text, add_special_tokens=False).ids


def test_mixing_meets_all_marginals_at_production_parameters(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    cells = mixing.probabilities(mixing.facts(docs)).cache()
    rows = mixing.marginals(cells).collect()
    assert {r.dimension for r in rows} == {"source", "lang", "topic"} and all(r.met for r in rows)
    assert all(abs(sum(r.target for r in rows if r.dimension == d) - 1) < 1e-9 for d in mixing.DIMS)
    kept, all_ = cells.agg(F.sum("weight"), F.sum("tokens")).first()
    assert cells.where("probability > 1").count() == 0 and cells.where("probability >= 1 - 1e-8").count() >= 1
    assert 0.4 < kept / all_ <= mixing.RATE
    # the sample itself is near: by its tokens
    out = mixing.decide(docs).where("selected").toPandas()
    for r in rows:
        assert abs(out.n_tokens[out[r.dimension] == r.value].sum() / out.n_tokens.sum() - r.target) < 0.06


def test_mixing_reports_targets_that_cannot_be_met(spark, nothing):
    rows = [(i, "w " * 9, "en" if i % 2 else "de", "a" if i % 2 else "b") for i in range(200)]  # language and source are one
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    targets = {"source": {"a": 0.9, "b": 0.1}, "lang": {"en": 0.5, "de": 0.5}, "topic": {"prose": 1.0}}
    cells = mixing.probabilities(mixing.facts(docs), targets=targets)
    assert not all(r.met for r in mixing.marginals(cells).collect()) and cells.where("probability > 1").count() == 0
    assert mixing.marginals(mixing.probabilities(mixing.facts(nothing))).count() == 0
