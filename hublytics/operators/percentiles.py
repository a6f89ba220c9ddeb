"""Exact percentiles (linear interpolation) per group, without per-group
value buffers in the aggregation.

The built-in exact ``percentile`` keeps a value -> count map per group in
every partial aggregation buffer; with many groups per task and many
distinct values per group those buffers grow with the data. Here:

1. a histogram ``(group, value) -> count``: a partial aggregate, so repeated
   values collapse map-side (a hot group costs its number of *distinct*
   values, not its rows);
2. a cumulative count per group over the distinct values (a window whose
   partitions hold distinct values, not rows): value ``x`` occupies the
   0-based ranks ``[start, end)``;
3. for each quantile p, the values at ranks ``floor((n-1)p)`` and
   ``ceil((n-1)p)`` are picked by a conditional aggregate in the same
   partitioning, then ``lo + (hi - lo) * frac``.

NULL values are ignored; a group with only NULLs gets NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_histogram(hist: DataFrame, keys: list[str], x: str = "__x", c: str = "__c") -> DataFrame:
    """Add ``__start``/``__end`` (rank range of each non-NULL value) and
    ``__n`` (non-NULL count of the group) to a (keys, x, c) histogram."""
    nonnull = F.when(F.col(x).isNotNull(), F.col(c)).otherwise(F.lit(0))
    ordered = Window.partitionBy(*keys).orderBy(F.col(x).asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, 0)
    return (hist.withColumn("__end", F.sum(nonnull).over(ordered))
            .withColumn("__start", F.col("__end") - nonnull)
            .withColumn("__n", F.sum(nonnull).over(Window.partitionBy(*keys))))


def quantile_aggs(ps: dict[str, float], x: str = "__x") -> tuple[list[Column], list[Column]]:
    """Aggregates over a ranked histogram (per group) and the final
    expressions (one per output name) to select after the aggregate."""
    aggs, finals = [], []
    for name, p in ps.items():
        pos = (F.col("__n") - 1).cast("double") * F.lit(float(p))
        lo_r, hi_r = F.floor(pos), F.ceil(pos)
        aggs += [F.max(F.when((F.col("__start") <= lo_r) & (lo_r < F.col("__end")), F.col(x))).alias(f"{name}__lo"),
                 F.max(F.when((F.col("__start") <= hi_r) & (hi_r < F.col("__end")), F.col(x))).alias(f"{name}__hi"),
                 F.max(pos - lo_r).alias(f"{name}__f")]
        lo, hi, frac = F.col(f"{name}__lo"), F.col(f"{name}__hi"), F.col(f"{name}__f")
        finals.append((lo + (hi - lo) * frac).alias(name))
    return aggs, finals


def exact_percentiles(df: DataFrame, keys: list[str], value: str, ps: dict[str, float]) -> DataFrame:
    """One row per group of ``keys`` with one column per ``ps`` entry."""
    hist = df.groupBy(*keys, F.col(value).alias("__x")).agg(F.count(F.lit(1)).alias("__c"))
    aggs, finals = quantile_aggs(ps)
    return rank_histogram(hist, keys).groupBy(*keys).agg(*aggs).select(*keys, *finals)
