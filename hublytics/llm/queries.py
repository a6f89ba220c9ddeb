"""Queries of this package: name -> (spark, sf_dir) -> DataFrame, and the
DuckDB SQL of those that SQL can express. Each applies one operator, with its
production parameters, to its whole table."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from hublytics.llm import (exact_dedup, hard_negatives, language_id, lexical_search, line_dedup, mixing, near_dedup, packing, pii,
                           quality_rules, secret_scan, sharding, topk_search)
from hublytics.llm.common import read


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(read(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(read(spark, sf_dir, "documents"))


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(read(spark, sf_dir, "embeddings"), every=50)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(read(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), added_tokens=True)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.decide(read(spark, sf_dir, "documents"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the contract of this query: two words, 80 percent
    return near_dedup.near_dedup(read(spark, sf_dir, "documents"), size=2, percent=80)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict(read(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("item_row")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.noisy_labels(read(spark, sf_dir, "embeddings")), every=100)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_pii, op2_line_dedup, op3_topk_search, op4_exact_dedup, op5_secret_scan, op6_packing, op7_sharding, op8_mixing,
                                op9_near_dedup, op10_language_id, op11_lexical_search, op12_hard_negatives, op13_quality_rules)}

QUERIES["pipeline"] = corpus_pipeline.run

ORACLE = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}

ORACLE["op4_exact_dedup"] = r"""
with t as (
  select doc_id, coalesce(text, '') as body,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
  from documents)
select doc_id,
       first_value(doc_id) over w as keep_id,
       count(*) over (partition by norm) as group_size,
       row_number() over w = 1 as kept,
       sha256(norm) as text_sha256,
       length(body) as n_chars
from t
window w as (partition by norm order by length(body) desc, doc_id nulls last)
"""



def _crc_step(a: str, x: str) -> str:
    """SQL of one byte's step of CRC-32 (reflected polynomial 0xEDB88320), by
    two look-ups in its table of half bytes."""
    table = []
    for v in range(16):
        for _ in range(4):
            v = v >> 1 ^ 0xEDB88320 * (v & 1)
        table.append(v)
    first = f"xor({a}, {x})"
    second = f"xor({table}[({first} & 15) + 1], {first} >> 4)"
    return f"xor({table}[({second} & 15) + 1], {second} >> 4)"


ORACLE["op7_sharding"] = rf"""
with bytes as (
  select doc_id, coalesce(source, '') as source, strlen(coalesce(text, '')) + 16 as size,
         md5('shard-1:' || coalesce(doc_id::varchar, '')) as key,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
           lambda h: ((strpos('0123456789ABCDEF', h[1]) - 1) * 16 + strpos('0123456789ABCDEF', h[2]) - 1)::bigint) as b
  from documents),
crc as (
  select doc_id, source, size, key,
         xor(list_reduce([4294967295::bigint] || b, lambda a, x: {_crc_step("a", "x")}), 4294967295) as text_crc32
  from bytes),
ranked as (
  select *, (row_number() over (partition by source order by key, text_crc32, size) - 0.5::double)
            / count(*) over (partition by source) as fraction
  from crc),
placed as (
  select *, row_number() over (order by fraction, source, key, text_crc32, size) - 1 as pos, count(*) over () as total
  from ranked),
cut_ as (select *, (pos * 40) // total as shard from placed)
select doc_id, source, size, text_crc32, 'rows' as law, shard::int as shard,
       (pos - (shard * total + 39) // 40)::bigint as slot, null::int as grown_shard
from cut_
"""

ORACLE["op9_near_dedup"] = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as ws
  from documents),
shingles as (
  select distinct doc_id, unnest(case when len(ws) >= 2 then list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])
                                      else ws end) as s
  from w),
named as (select doc_id, min(doc_id) over (partition by s) as f, dense_rank() over (order by s) as s from shingles),
sizes as (select w.doc_id, count(s) as n from w left join shingles using (doc_id) group by w.doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as k
           from named a join named b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
          where 100 * k >= 80 * (x.n + y.n - k)),
edges as (select a, b from links union all select b, a from links),
reach(a, b) as (select doc_id, doc_id from documents union select r.a, e.b from reach r join edges e on r.b = e.a),
least as (select a, min(b) as component_id from reach group by a)
select d.doc_id, n as n_shingles, component_id, d.doc_id = component_id as kept
from documents d join sizes using (doc_id) join least on least.a = d.doc_id
"""

ORACLE["op3_topk_search"] = r"""
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as query_id, b.vec_id,
         list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::bigint as score
  from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

ORACLE["op11_lexical_search"] = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ts
  from documents),
i as (
  select distinct item_id, unnest(
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark),
whole as (select count(*) filter (where len(ts) > 0)::bigint as nd, sum(len(ts))::bigint as total from d),
counts as (
  select doc_id, n, term, count(*) as tf
  from (select doc_id, len(ts)::bigint as n, unnest(ts) as term from d) group by all),
weights as (
  select term, floor(1000 * ln((2 * max(nd) + 2)::double / (2 * count(*) + 1)::double))::bigint as w from counts, whole group by term),
scored as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // total))))::bigint as score
  from i join weights using (term) join counts using (term), whole group by all),
ranked as (select *, row_number() over (partition by item_id order by score desc, doc_id)::int as rank from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 50
"""

ORACLE["op12_hard_negatives"] = r"""
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
         list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::bigint as score
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
positive as (
  select anchor_id, other_id as positive_id, score as positive_score
  from scored where same qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5),
found as (
  select anchor_id, positive_id, other_id as negative_id, positive_score, score as negative_score,
         row_number() over (partition by anchor_id, positive_id order by score desc, other_id)::int as rank
  from positive join scored using (anchor_id)
  where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from found where rank <= 10
"""


def _pii_sql() -> str:
    octet = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = (f"list_sum(list_transform(string_split(reverse({digits}), ''), lambda c, i: "
            "case when i % 2 = 1 then c::int when c::int > 4 then 2 * c::int - 9 else 2 * c::int end)) % 10 = 0")
    compact = "replace(m, ' ', '')"
    mod97 = (f"list_reduce([0::bigint] || list_transform(string_split(substr({compact}, 5) || left({compact}, 4), ''), "
             "lambda c: ord(c)::bigint), lambda a, c: if(c < 65, (a * 10 + c - 48) % 97, (a * 100 + c - 55) % 97)) = 1")
    outside = "not regexp_matches(before, '[A-Za-z0-9]$') and not regexp_matches(after, '^[A-Za-z0-9]')"
    confirm = {
        "email": "true",
        "ip": rf"regexp_full_match(m, '{octet}(?:\.{octet}){{3}}')",
        "card": f"length({digits}) between 14 and 19 and {luhn}",
        "phone": f"length({digits}) between 10 and 15",
        "iban": f"{outside} and {mod97}",
        "ssn": "not regexp_matches(before, '[0-9-]$') and not regexp_matches(after, '^[0-9-]') "
               "and not regexp_matches(m, '^(?:000|666|9)|-00-|-0000$')",
    }
    # the same patterns without the marks that only save one engine work
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
             "card": r"[0-9](?:[\x20-]?[0-9])+", "iban": pii.iban_pattern("")}
    # positions first; then context from the text around a match, which a heading hands on
    # along a list: matches at most a context apart with no letter between them
    found = "\nunion all\n".join(f"""
  select rn, {k} as k, '{kind.name}' as kind, start, start + length(m) as stop, if(near, {kind.score + pii.CONTEXT_BONUS}, {kind.score})::double as score
  from (
    select *, bool_or(hit) over (partition by rn, segment order by i rows unbounded preceding) as near from (
      select *, sum(if(listed, 0, 1)) over (partition by rn order by i rows unbounded preceding) as segment from (
        select rn, i, m, start, right(p, {c}) as before, left(coalesce(q, ''), {c}) as after,
          length(p) <= {c} and not regexp_matches(p, '\\p{{L}}') as listed,
          regexp_matches(substr(t, greatest(start - {c - 1}, 1), least(start, {c})) || ' ' || substr(t, start + length(m) + 1, {c}),
                         '(?i){kind.context.replace(chr(92) * 2, chr(92))}') as hit
        from (
          select rn, t, i, m, p, q, (sum(length(p)) over w + sum(length(m)) over w - length(m))::bigint as start
          from (select rn, t, i, ms[i] as m, ps[i] as p, ps[i + 1] as q
                from (select rn, t, ms, ps, unnest(range(1, len(ms) + 1)) as i
                      from (select rn, t, regexp_extract_all(t, '{plain.get(kind.name, kind.pattern)}') as ms,
                              string_split_regex(t, '{plain.get(kind.name, kind.pattern)}') as ps from docs)))
          window w as (partition by rn order by i)))))
  where {confirm[kind.name]}""" for k, kind in enumerate(pii.KINDS) for c in [pii.CONTEXT])
    found = f"select * from ({found}) where k < 4 or score >= {pii.MIN_SCORE}"
    kinds = [(kind.name,) for kind in pii.KINDS]
    listed = "string_agg(kind || ':' || start || ':' || stop, ',' order by start, k)"
    return f"""
with docs as (select row_number() over () as rn, doc_id, coalesce(text, '') as t from documents),
found as ({found}),
listed as (
  select rn, {", ".join(f"count(*) filter (where k = {k}) as n_{kinds[k][0]}" for k in range(4))},
    {listed} filter (where k < 4) as base, {listed} as spans,
    string_agg(printf('%.2f', score), ',' order by start, k) as scores
  from found group by rn)
select doc_id, {", ".join(f"coalesce(n_{kinds[k][0]}, 0) as n_{kinds[k][0]}" for k in range(4))},
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(scores, '') as scores
from docs left join listed using (rn)"""


def _mixing_sql() -> str:
    dims = mixing.DIMS
    topic = " ".join(f"when regexp_matches(coalesce(text, ''), '{p}') then '{n}'" for n, p in mixing.TOPICS)
    root = f"pow(sum(tokens){{}}, {mixing.TEMPER}::double)"
    target = ", ".join(f"{root.format(f' over (partition by {d})')} / (select sum(r) from (select {root.format('')} as r from cells group by {d})) "
                       f"* ({mixing.RATE}::double * (select sum(tokens) from cells)) as t_{d}" for d in dims)
    steps, last = [], "start"
    for i in range(mixing.ROUNDS):
        for d in dims:
            name = f"w_{i}_{d}"
            steps.append(f"{name} as (select * replace (coalesce(w * t_{d} / nullif(sum(w) over (partition by {d}), 0), 0) as w) from {last})")
            last = name
    raked = ",\n".join(steps)
    return f"""
with facts as (
  select doc_id, coalesce(source, '') as source, coalesce(lang, '') as lang, case {topic} else 'prose' end as topic,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint + 1 as n_tokens
  from documents),
cells as (select source, lang, topic, sum(n_tokens)::double as tokens from facts group by all),
start as (select *, tokens as w, {target} from cells),
{raked},
scaled as (select *, round(w * (select least(1, min(tokens / w) filter (where w > 0)) from {last}) / tokens, 9) as p from {last})
select doc_id, f.source, f.lang, f.topic, n_tokens, p as probability,
  ('0x' || left(md5('{mixing.SEED}:' || coalesce(doc_id::varchar, '')), 13))::bigint / 4503599627370496::double < p as selected
from facts f join scaled using (source, lang, topic)"""


ORACLE["op1_pii"] = _pii_sql()
ORACLE["op8_mixing"] = _mixing_sql()
