"""Ordered running totals that stay parallel when one group is huge.

A plain ``row_number()``/``sum().over(partitionBy(g).orderBy(o))`` sends a
whole group to one task. When a single group can hold a large share of all
rows, that task becomes the job. :func:`running_total` cuts such hot groups, and
only these, into parts:

1. a sample of the groups and of a number ``at`` that never falls in the
   ordering (for example the microseconds of a timestamp) finds groups of more than
   ``max_rows`` rows and, from their quantiles of ``at``, bounds between parts of
   about that size. The sample shapes the parts, never the result;
2. a part's offset is the sum of the totals of the earlier parts of its group:
   a window over a table of one row a part;
3. the running value inside each part is a window whose partitions are parts;
4. 2 is added to 3 by a map-side lookup.

Bounds and offsets number at most about twice the rows divided by
``max_rows``, so both are broadcast. Without hot groups all that is left is the
plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hublytics.sources.sinks import scratch

#: rows of one task's window; groups beyond about this size are cut
MAX_GROUP_ROWS = 2_000_000
#: sampled rows by which a group of MAX_GROUP_ROWS is expected to show
EXPECTED = 1000
#: parts that a group can be cut into
PARTS = 1000


def slices(data: DataFrame, max_rows: int = MAX_GROUP_ROWS, seed: int = 1) -> DataFrame:
    """__bg (group), __bounds (rising numbers) of the hot groups in ``data``
    (__g, __at): a row lies in the slice numbered by the bounds below its __at."""
    fraction = min(1.0, EXPECTED / max_rows)
    sample = scratch(data.select("__g", "__at").sample(fraction, seed), "running-sample")
    # half the expected number: a group at the limit is rarely missed, and missing one costs time only
    hot = sample.groupBy("__g").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_rows * fraction / 2)
    hot = scratch(hot.select(F.col("__g").alias("__hg"), F.ceil(F.col("n") / F.lit(max_rows * fraction)).alias("parts")), "running-hot")
    if hot.isEmpty():
        return hot
    of_hot = sample.join(F.broadcast(hot), F.col("__g") == F.col("__hg"))
    points = F.percentile_approx("__at", F.array(*[F.lit(i / PARTS) for i in range(1, PARTS)]), PARTS * 10)
    cut = of_hot.groupBy("__hg").agg(F.max("parts").alias("parts"), points.alias("at"))
    step = F.greatest(F.lit(1), F.floor(F.lit(PARTS) / F.col("parts"))).cast("int")
    chosen = F.array_distinct(F.filter("at", lambda x, i: (i + 1) % step == 0))
    return scratch(cut.select(F.col("__hg").alias("__bg"), chosen.alias("__bounds")), "running-bounds")


def running_total(df: DataFrame, group_cols: list[str], bucket: Column, order_cols: list[Column],
                  value: Column | None = None, out: str = "running",
                  values: dict[str, Column | None] | None = None, max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Add running sums within ``group_cols`` in ``order_cols`` order (rows
    unbounded preceding to current row). ``values`` maps output column ->
    value (None = count rows); the ``value``/``out`` pair is the one-column
    shorthand. ``bucket`` is a whole number that never falls in the order.

    Groups are carried as structs: a struct is never NULL itself and struct
    equality treats NULL fields as equal, so NULL groups behave as in
    ``Window.partitionBy`` while lookups by group stay plain equi-joins. Rows
    that hold the same ``bucket`` stay in one part; a NULL ``bucket`` is in the
    first (rows without a time come first).
    """
    values = values or {out: value}
    data = df.withColumns({"__g": F.struct(*group_cols), "__at": bucket.cast("long")})
    vcols = {}
    for i, (name, v) in enumerate(values.items()):
        vcols[name] = f"__v{i}"
        data = data.withColumn(f"__v{i}", F.lit(1).cast("long") if v is None else v)
    bounds = slices(data, max_rows)
    if bounds.isEmpty():
        whole = Window.partitionBy("__g").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
        return data.select(*df.columns, *[F.sum(vc).over(whole).alias(name) for name, vc in vcols.items()])

    # at most about 2 * rows / max_rows groups and bounds
    placed = data.join(F.broadcast(bounds), F.col("__g") == F.col("__bg"), "left").drop("__bg")
    part = F.when(F.col("__at").isNotNull(), F.size(F.filter("__bounds", lambda x: x < F.col("__at"))))
    placed = placed.withColumn("__b", F.when(F.col("__bounds").isNotNull(), F.coalesce(part, F.lit(0))).otherwise(F.lit(0)))
    totals = placed.filter("__bounds is not null").groupBy("__g", "__b").agg(*[F.sum(vc).alias(f"{vc}_t") for vc in vcols.values()])
    earlier = Window.partitionBy("__g").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("__g").alias("__og"), F.col("__b").alias("__ob"),
                            *[F.coalesce(F.sum(f"{vc}_t").over(earlier), F.lit(0)).alias(f"{vc}_o") for vc in vcols.values()])
    inside = Window.partitionBy("__g", "__b").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.drop("__bounds").withColumns({f"{vc}_l": F.sum(vc).over(inside) for vc in vcols.values()})
    joined = local.join(F.broadcast(scratch(offsets, "running-offsets")),
                        (F.col("__g") == F.col("__og")) & (F.col("__b") == F.col("__ob")), "left")
    return joined.select(*df.columns, *[(F.coalesce(F.col(f"{vc}_o"), F.lit(0)) + F.col(f"{vc}_l")).alias(name)
                                        for name, vc in vcols.items()])
