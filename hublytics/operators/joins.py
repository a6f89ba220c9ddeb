"""Join helpers: broadcast only what is small, by measure where in doubt."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest size (bytes in memory) of a dimension that is shipped to every
# executor. Beyond it the join is left to Spark: a shuffle join that AQE turns
# into a broadcast when the side proves small at run time, or splits when a key
# is hot.
MAX_BROADCAST_BYTES = 32 * 1024 * 1024
# Spark's estimate counts compressed file bytes. A dimension's key is unique, so a
# row takes about a byte of its file at least: up to this estimate even rows of
# some hundred bytes stay below the limit. From here to the limit the rows
# themselves are measured.
SURE_BYTES = 64 * 1024
#: what a row costs besides its values, and a value of fixed width
ROW_BYTES, VALUE_BYTES = 16, 8


def estimated_bytes(df: DataFrame) -> int:
    """Spark's size estimate of ``df``'s optimized plan; runs nothing."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def measured_bytes(df: DataFrame) -> int:
    """Size of ``df``'s rows in memory: one distributed aggregate over them."""
    fixed = ROW_BYTES + VALUE_BYTES * len(df.columns)
    text = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema.fields
            if f.dataType.typeName() in ("string", "binary", "varchar", "char")]
    nested = [F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0)) for f in df.schema.fields
              if f.dataType.typeName() in ("array", "map", "struct")]
    total = F.lit(0).cast("long")
    for part in [*text, *nested]:
        total = total + part
    n, varying = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(total), F.lit(0))).first()
    return n * fixed + varying


def fits(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df`` is at most ``max_bytes`` in memory."""
    estimate = estimated_bytes(df)
    return estimate <= max_bytes and (estimate <= min(SURE_BYTES, max_bytes) or measured_bytes(df) <= max_bytes)


def bounded_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` if it fits ``max_bytes``, else ``df`` unchanged."""
    return F.broadcast(df) if fits(df, max_bytes) else df


class BroadcastPolicy:
    """Caches the size check per dimension and columns. ``name`` identifies
    the underlying table."""

    def __init__(self, max_bytes: int = MAX_BROADCAST_BYTES, enabled: bool = True):
        self.max_bytes = max_bytes
        self.enabled = enabled
        self._ok: dict[tuple, bool] = {}

    def is_small(self, name: str, df: DataFrame) -> bool:
        if not self.enabled:
            return False
        key = (name, *df.columns)
        if key not in self._ok:
            self._ok[key] = fits(df, self.max_bytes)
        return self._ok[key]

    def __call__(self, name: str, df: DataFrame) -> DataFrame:
        return F.broadcast(df) if self.is_small(name, df) else df


def no_hint(name: str, df: DataFrame) -> DataFrame:
    return df
