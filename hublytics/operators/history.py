"""Slowly changing dimension, type 2 (``check`` strategy), and as-of lookup.

A snapshot table holds every version of a keyed row with
``valid_from``/``valid_to`` (``valid_to`` NULL = current), the run time
that wrote it (``updated_at``) and a version id (``scd_id``). Each run
compares the current versions with the source on the check columns
(NULL-safe):

* key new in the source  -> insert an open version;
* check columns changed  -> close the open version at the run time and
  insert a new open version;
* unchanged              -> keep;
* key gone from source   -> left open (nothing is invalidated).

:func:`snapshot` gives the complete table after a run, :func:`changes` only
what the run adds to it: the open rows of new and changed keys and the closed
rows of changed ones. A version on disk
(:func:`hublytics.sources.sinks.write_version`) holds the changes of its run,
so a run without changes writes no row and no row is ever written twice as
open; :func:`hublytics.sources.sinks.read_history` puts the runs together.
The comparison is one join on the key; both sides are keyed by a unique id,
so its shuffle is even, and only the open rows' key, id and compared columns
would be needed to find out that nothing changed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hublytics.operators.joins import MAX_BROADCAST_BYTES, fits
from hublytics.operators.windows import MAX_GROUP_ROWS, slices

META = ["scd_id", "updated_at", "valid_from", "valid_to"]


def _scd_id(key: Column, ts: Column) -> Column:
    return F.sha2(F.concat_ws("|", key.cast("string"), F.date_format(ts, "yyyy-MM-dd HH:mm:ss")), 256)


def _open_version(src: DataFrame, key: str, ts: Column) -> DataFrame:
    return src.select("*", _scd_id(F.col(key), ts).alias("scd_id"), ts.alias("updated_at"),
                      ts.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"))


def snapshot(src: DataFrame, key: str, check_cols: list[str], run_at: str | Column,
             prev: DataFrame | None = None) -> DataFrame:
    """Return the complete snapshot table after one run at ``run_at``."""
    ts = (F.lit(run_at) if isinstance(run_at, str) else run_at).cast("timestamp_ntz")
    payload = src.columns
    if prev is None:
        return _open_version(src, key, ts)

    history = prev.filter(F.col("valid_to").isNotNull())
    current = prev.filter(F.col("valid_to").isNull())
    o = current.select(*[F.col(c).alias(f"o__{c}") for c in current.columns])
    s = src.select(*[F.col(c).alias(f"s__{c}") for c in payload])
    j = o.join(s, F.col(f"o__{key}") == F.col(f"s__{key}"), "full_outer")

    in_o, in_s = F.col(f"o__{key}").isNotNull(), F.col(f"s__{key}").isNotNull()
    same = reduce(lambda a, b: a & b, [F.col(f"o__{c}").eqNullSafe(F.col(f"s__{c}")) for c in check_cols])
    changed = in_o & in_s & ~same

    # One pass over the joined rows emits up to two rows each: the current
    # version (kept, or closed at the run time) and the new version (for a
    # new or changed key). Emitting both from one join keeps a single
    # shuffle of each side; separate filters would let the optimizer split
    # the full outer join into two joins.
    cols = payload + META
    current_row = F.struct(*[F.col(f"o__{c}").alias(c) for c in payload + ["scd_id", "updated_at", "valid_from"]],
                           F.when(changed, ts).otherwise(F.col("o__valid_to")).alias("valid_to"))
    new_row = F.struct(*[F.col(f"s__{c}").alias(c) for c in payload],
                       _scd_id(F.col(f"s__{key}"), ts).alias("scd_id"), ts.alias("updated_at"),
                       ts.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"))
    rows = j.select(F.explode(F.array(F.when(in_o, current_row),
                                      F.when(in_s & (~in_o | changed), new_row))).alias("r"))
    merged = rows.filter(F.col("r").isNotNull()).select(*[F.col(f"r.{c}").alias(c) for c in cols])
    return history.unionByName(merged)


def changes(src: DataFrame, key: str, check_cols: list[str], run_at: str | Column, open_rows: DataFrame | None = None) -> DataFrame:
    """What a run at ``run_at`` adds to a history whose open rows are
    ``open_rows``: for a new key an open row; for a changed one the open row,
    closed, and a new open row; for all others nothing."""
    ts = (F.lit(run_at) if isinstance(run_at, str) else run_at).cast("timestamp_ntz")
    if open_rows is None:
        return _open_version(src, key, ts)
    payload = src.columns
    o = open_rows.select(*[F.col(c).alias(f"o__{c}") for c in payload + META])
    s = src.select(*[F.col(c).alias(f"s__{c}") for c in payload])
    j = s.join(o, F.col(f"o__{key}") == F.col(f"s__{key}"), "left")
    known = F.col(f"o__{key}").isNotNull()
    same = reduce(lambda a, b: a & b, [F.col(f"o__{c}").eqNullSafe(F.col(f"s__{c}")) for c in check_cols])
    closed = F.struct(*[F.col(f"o__{c}").alias(c) for c in payload + META[:-1]], ts.alias("valid_to"))
    fresh = F.struct(*[F.col(f"s__{c}").alias(c) for c in payload], _scd_id(F.col(f"s__{key}"), ts).alias("scd_id"),
                     ts.alias("updated_at"), ts.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"))
    rows = j.filter(~known | ~same).select(F.explode(F.array(F.when(known, closed), fresh)).alias("r"))
    return rows.filter(F.col("r").isNotNull()).select("r.*")


def _as_of_stream(facts: DataFrame, versions: DataFrame, at: str, attrs: list[str], key: str, max_rows: int) -> DataFrame:
    """Facts and versions in one stream per key, in order of time; every fact
    takes the last version before it. A hot key's stream is cut into time slices
    (:mod:`hublytics.operators.windows`), and a version goes to all slices in which
    it is valid, so each slice is complete in itself."""
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    f = facts.select(F.struct(F.col(key).alias("k")).alias("__g"), micros(at).alias("__at"), F.col(at).cast("timestamp_ntz").alias("__t"),
                     F.struct(*facts.columns).alias("__f"))
    v = versions.filter(F.col("__k").isNotNull()).select(
        F.struct(F.col("__k").alias("k")).alias("__g"), micros("valid_from").alias("__at"), micros("valid_to").alias("__end"),
        F.col("valid_from").cast("timestamp_ntz").alias("__t"), F.struct("valid_to", *[f"__{a}" for a in attrs]).alias("__v"))
    bounds = slices(f, max_rows)
    part = lambda c, least: F.coalesce(F.size(F.filter("__bounds", lambda x: x < F.col(c))), least)
    if bounds.isEmpty():
        f, v = f.withColumn("__b", F.lit(0)), v.withColumn("__b", F.lit(0))
    else:
        hot = F.broadcast(bounds)  # at most about 2 * rows / max_rows groups and bounds
        f = f.join(hot, F.col("__g") == F.col("__bg"), "left").withColumn("__b", F.when(F.col("__at").isNotNull(), part("__at", F.lit(0))).otherwise(0))
        v = v.join(hot, F.col("__g") == F.col("__bg"), "left")
        last = F.when(F.col("__end").isNull(), F.size("__bounds")).otherwise(part("__end", F.lit(0)))
        v = v.withColumn("__b", F.explode(F.sequence(part("__at", F.lit(0)), F.coalesce(last, F.lit(0)))))
    kind, order = F.lit(None), ["__t", "__kind", F.col("__v.valid_to").asc_nulls_last()]
    stream = (f.select("__g", "__b", "__t", F.lit(1).alias("__kind"), "__f", kind.cast(v.schema["__v"].dataType).alias("__v"))
              .unionByName(v.select("__g", "__b", "__t", F.lit(0).alias("__kind"), kind.cast(f.schema["__f"].dataType).alias("__f"), "__v")))
    before = Window.partitionBy("__g", "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = stream.withColumn("__last", F.last("__v", ignorenulls=True).over(before)).filter("__kind = 1")
    valid = F.col("__last.valid_to").isNull() | (F.col("__t") < F.col("__last.valid_to"))
    return found.select("__f.*", *[F.when(valid, F.col(f"__last.__{a}")).alias(a) for a in attrs])


def as_of_join(facts: DataFrame, history: DataFrame, key: str, at: str, attrs: list[str],
               max_broadcast_bytes: int = MAX_BROADCAST_BYTES, max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Attach to each fact the version of ``attrs`` valid at ``facts[at]``:
    ``valid_from <= at < coalesce(valid_to, +inf)``. Left join: facts with no
    version valid at that time get NULLs.

    Versions of a key do not overlap. A history that is small in memory is
    broadcast; otherwise facts and versions are merged into one ordered stream
    per key, which costs one sort whatever the versions of a key.
    """
    h = history.select(F.col(key).alias("__k"), "valid_from", "valid_to",
                       *[F.col(a).alias(f"__{a}") for a in attrs])
    if not fits(h, max_broadcast_bytes):
        return _as_of_stream(facts, h, at, attrs, key, max_rows)
    h = F.broadcast(h)
    cond = ((facts[key] == h["__k"]) & (h["valid_from"] <= facts[at])
            & (h["valid_to"].isNull() | (facts[at] < h["valid_to"])))
    j = facts.join(h, cond, "left")
    return j.select(*[facts[c] for c in facts.columns], *[F.col(f"__{a}").alias(a) for a in attrs])
