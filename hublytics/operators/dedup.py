"""The first row of every key, without moving the rows.

Few keys of a large table occur twice, so moving and sorting every wide row
to find them is nearly all waste. Here only keys travel:

1. keys that occur more than once: a count by key, combined map-side;
2. for these alone, the place (file and row number, from the scan's own
   metadata) of the row that comes first: a narrow window that ships at most one
   row a key and task, so a hot key cannot swamp one;
3. the wide scan keeps a row unless its key is one of these and its place is
   not the chosen one: a map-side lookup, no exchange and no sort.

The chosen places are written and their size is known before they are
broadcast; beyond the bound the plain window does the work.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hublytics.operators.joins import MAX_BROADCAST_BYTES, bounded_broadcast, fits
from hublytics.sources.sinks import scratch

_FILE, _AT, _KEY = "__file", "__at", "__key"


def dedup_latest(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Keep the first row per ``key`` in ``order``: the plain window.

    ``row_number() ... = 1`` is planned as a WindowGroupLimit: a partial
    per-key limit runs before the shuffle, so each map task ships at most one
    row per key and a hot key cannot swamp the reducer.
    """
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def _places(df: DataFrame, columns: list) -> DataFrame | None:
    """``columns`` of ``df`` and each row's place; None where rows have none
    (they do not come straight from files)."""
    try:
        return df.select(*columns, F.xxhash64("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(_AT))
    except AnalysisException:
        return None


def first_places(df: DataFrame, key: str, order: list[Column], columns: list[str]) -> DataFrame | None:
    """Key and place of the first row of every key that occurs more than once;
    ``columns`` are those that ``order`` reads. At equal order the first place
    counts. None where rows have no place."""
    rows = _places(df, [F.col(key).alias(_KEY), *columns])
    if rows is None:
        return None
    twice = scratch(df.groupBy(F.col(key).alias("__k")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("__k"), "repeated-keys")
    few = rows.join(bounded_broadcast(twice), F.col(_KEY).eqNullSafe(F.col("__k")), "left_semi")
    return scratch(dedup_latest(few, _KEY, [*order, F.col(_FILE), F.col(_AT)]).select(_KEY, _FILE, _AT), "first-places")


def keep_first(df: DataFrame, key: str, order: list[Column], places: DataFrame | None,
               max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """The first row per ``key`` in ``order``, given :func:`first_places`."""
    if places is None or not fits(places, max_bytes):
        return dedup_latest(df, key, order)
    chosen = F.broadcast(places.select(F.col(_KEY), F.col(_FILE).alias("__f"), F.col(_AT).alias("__a")))
    joined = _places(df, [*df.columns]).join(chosen, F.col(key).eqNullSafe(F.col(_KEY)), "left")
    own = (F.col(_FILE) == F.col("__f")) & (F.col(_AT) == F.col("__a"))
    return joined.filter(F.col("__a").isNull() | own).select(*df.columns)


def mark_later(df: DataFrame, key: str, order: list[Column], columns: list[str], name: str,
               max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` with ``name``: whether an earlier row has the same ``key``. A
    missing key repeats nothing."""
    known = F.col(key).isNotNull()
    places = first_places(df.filter(known), key, order, columns)
    if places is None or not fits(places, max_bytes):
        number = F.row_number().over(Window.partitionBy(key).orderBy(*order))
        return (df.filter(known).withColumn(name, number > 1)
                .unionByName(df.filter(~known).withColumn(name, F.lit(False))))
    chosen = F.broadcast(places.select(F.col(_KEY), F.col(_FILE).alias("__f"), F.col(_AT).alias("__a")))
    joined = _places(df, [*df.columns]).join(chosen, F.col(key) == F.col(_KEY), "left")
    own = (F.col(_FILE) == F.col("__f")) & (F.col(_AT) == F.col("__a"))
    return joined.select(*df.columns, (F.col("__a").isNotNull() & ~own).alias(name))
