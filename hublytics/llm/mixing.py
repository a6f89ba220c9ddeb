"""Mixing sources to target weights (DataFrame functions only).

Documents fall into cells (source, language, topic). Iterative proportional
fitting rakes the cells' token weights until the sums by source, by language
and by topic are in proportion to their targets. Documents are not repeated, so
the raked weights are then scaled, all alike, until the kept tokens are ``rate``
of all or the first cell is kept whole, whichever comes first: the shares are
those of the targets, and only the budget gives way. Weight over tokens is the
probability with which each document of the cell is kept. :func:`marginals`
states target and reached share of every value, whatever the data (given
targets that contradict each other, or that ask for cells without tokens, cannot all be met).

Targets are shares of the kept tokens. Without given shares a dimension's
targets are in proportion to its tokens to the power TEMPER, which raises small
sources and lowers a dominant one; the further TEMPER is below 1, the smaller
the budget that the smallest cell allows.

How it runs: one pass reads the texts (topic and token counts), aggregated
map-side to cells; raking is windows over the small cell table, whose lineage
is cut every few rounds. A document's draw depends on its doc_id and the seed
only, so the decision can be joined to the documents by cell, without a
shuffle of texts as long as the cell table is small (checked).

Defined cases: a null source or language is the value ''; null text has one
token (the end mark); repeated rows have the same draw; an empty table gives
no rows; further columns stay in :func:`mix` and are ignored otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hublytics.llm.common import WORD, cut, text_or_empty

RATE = 0.8
ROUNDS = 8
#: exponent of the default targets: 1 keeps the shares as they are, 0 makes them equal
TEMPER = 0.9
#: a share that :func:`marginals` reports as reached differs from its target by at most this
TOLERANCE = 1e-3
#: raking rounds between two written tables
KEEP = 4
SEED = "mix-1"
DIMS = ("source", "lang", "topic")
#: cells up to which their probabilities are sent to every task (about 100 bytes each)
SMALL_CELLS = 50_000

#: first rule that matches; both patterns mean the same in every engine used here
TOPICS = [
    ("code", r"[{};][\x20\x09-\x0D]*\n"),
    ("legal", r"[Ll]icen[sc]e|[Cc]opyright"),
    ("contact", r"@[A-Za-z0-9-]+\."),
]


def topic(text: Column) -> Column:
    out = F.lit("prose")
    for name, pattern in reversed(TOPICS):
        out = F.when(text.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def _cell_columns() -> dict[str, Column]:
    return {"source": F.coalesce(F.col("source"), F.lit("")), "lang": F.coalesce(F.col("lang"), F.lit("")),
            "topic": topic(text_or_empty())}


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on doc_id and seed."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(16 ** 13))


def facts(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens (words and the end mark)."""
    tokens = F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long") + 1
    return docs.select("doc_id", *[c.alias(n) for n, c in _cell_columns().items()], tokens.alias("n_tokens"))


def probabilities(rows: DataFrame, rate: float = RATE, rounds: int = ROUNDS,
                  targets: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """source, lang, topic, tokens, weight, probability of every cell of
    ``rows`` (:func:`facts`). ``targets``: dimension -> value -> share."""
    cells = cut(rows.groupBy(*DIMS).agg(F.sum("n_tokens").alias("tokens")), "mix-cells")
    budget = rate * (cells.agg(F.sum("tokens")).first()[0] or 0)
    for d in DIMS:
        given = (targets or {}).get(d)
        if given:
            share = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in given.items() for x in kv]), F.col(d)), F.lit(0.0))
        else:
            total = cells.groupBy(d).agg(F.pow(F.sum("tokens").cast("double"), F.lit(TEMPER)).alias("r")).agg(F.sum("r")).first()[0] or 1.0
            share = F.pow(F.sum("tokens").over(Window.partitionBy(d)).cast("double"), F.lit(TEMPER)) / F.lit(total)
        cells = cells.withColumn(f"t_{d}", share * F.lit(budget))
    cells = cells.withColumn("w", F.col("tokens").cast("double"))
    for i in range(rounds):
        for d in DIMS:
            whole = F.nullif(F.sum("w").over(Window.partitionBy(d)), F.lit(0.0))  # a value without a target keeps nothing
            cells = cells.withColumn("w", F.coalesce(F.col("w") * F.col(f"t_{d}") / whole, F.lit(0.0)))
        if i % KEEP == KEEP - 1 or i == rounds - 1:
            cells = cut(cells, "mix-raked")
    least = cells.agg(F.min(F.when(F.col("w") > 0, F.col("tokens") / F.col("w")))).first()[0]
    scale = min(1.0, least if least is not None else 1.0)
    cells = cells.withColumn("w", F.col("w") * F.lit(scale))
    shares = [(F.col(f"t_{d}") / F.lit(budget or 1.0)).alias(f"target_{d}") for d in DIMS]
    return cells.select(*DIMS, "tokens", F.col("w").alias("weight"), F.round(F.col("w") / F.col("tokens"), 9).alias("probability"), *shares)


def marginals(cells: DataFrame) -> DataFrame:
    """dimension, value, target and reached share of the weights of
    :func:`probabilities`, and whether they agree within TOLERANCE."""
    total = cells.agg(F.sum("weight")).first()[0] or 1.0
    parts = [cells.groupBy(F.lit(d).alias("dimension"), F.col(d).alias("value"))
             .agg(F.first(f"target_{d}").alias("target"), (F.sum("weight") / F.lit(total)).alias("reached")) for d in DIMS]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.withColumn("met", F.abs(F.col("target") - F.col("reached")) <= TOLERANCE)


def _with_probability(rows: DataFrame, cells: DataFrame) -> DataFrame:
    chosen = cells.select(*[F.col(d).alias(f"__{d}") for d in DIMS], F.col("probability").alias("__p"))
    if cells.count() <= SMALL_CELLS:
        chosen = F.broadcast(chosen)
    same = [F.col(f"__c_{d}") == F.col(f"__{d}") for d in DIMS]
    return rows.join(chosen, same[0] & same[1] & same[2]).drop(*[f"__{d}" for d in DIMS])


def decide(docs: DataFrame, seed: str = SEED, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, lang, topic, n_tokens,
    probability, selected."""
    rows = cut(facts(docs), "mix-facts")
    out = _with_probability(rows.withColumns({f"__c_{d}": F.col(d) for d in DIMS}), probabilities(rows, **options))
    return out.select("doc_id", *DIMS, "n_tokens", F.col("__p").alias("probability"),
                      (draw(F.col("doc_id"), seed) < F.col("__p")).alias("selected"))


def mix(docs: DataFrame, seed: str = SEED, **options) -> DataFrame:
    """The selected rows of ``docs``, with all their columns."""
    cells = probabilities(facts(docs), **options)
    rows = docs.withColumns({f"__c_{n}": c for n, c in _cell_columns().items()})
    out = _with_probability(rows, cells).where(draw(F.col("doc_id"), seed) < F.col("__p"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
