"""Cleaning and arithmetic helpers, each returning a ``Column``.

All helpers are built from ``pyspark.sql.functions`` only, so they compile
into whole-stage codegen; no Python runs per row. The numeric rules follow
the warehouse's SQL semantics (zone-less timestamps, binary rounding,
NULL-safe ratios) rather than Spark's defaults where the two differ.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- numbers

def round_like(x: ColumnOrName, digits: int = 2) -> Column:
    """Round a double to ``digits`` decimals by scaling in binary.

    ``F.round(1.005, 2)`` gives 1.01 because Spark rounds the shortest
    decimal text of the double; the warehouse rounds the binary value
    (``1.005*100 = 100.49999...`` -> 1.0). Scaling first reproduces that.
    Halves are rounded away from zero in both engines.
    """
    scale = float(10 ** digits)
    return F.round(_c(x).cast("double") * F.lit(scale), 0) / F.lit(scale)


def safe_ratio(num: ColumnOrName, den: ColumnOrName, scale: float = 1.0) -> Column:
    """``num*scale / nullif(den, 0)`` as DOUBLE; NULL when ``den`` is 0 or NULL.

    Using a double literal keeps the result DOUBLE (a decimal literal would
    give DECIMAL in Spark SQL); ``nullif`` avoids the ANSI divide-by-zero.
    """
    return (_c(num).cast("double") * F.lit(float(scale))) / F.nullif(_c(den), F.lit(0)).cast("double")


def pct(num: ColumnOrName, den: ColumnOrName, digits: int = 2) -> Column:
    """Safe percentage: ``round(num*100.0/nullif(den,0), digits)``."""
    return round_like(safe_ratio(num, den, 100.0), digits)


def ratio(num: ColumnOrName, den: ColumnOrName, digits: int = 1) -> Column:
    """Safe ratio: ``round(num*1.0/nullif(den,0), digits)``."""
    return round_like(safe_ratio(num, den, 1.0), digits)


def is_inf(x: ColumnOrName) -> Column:
    return F.abs(_c(x)) == F.lit(float("inf"))


def _is_integer(c: Column) -> Column:
    """Whether the column's type is an integer type: known when the plan is
    made, so only the matching branch remains in it."""
    return F.typeof(c).isin("tinyint", "smallint", "int", "bigint")


def to_bigint(x: ColumnOrName) -> Column:
    """Number that may hold NULL/NaN/+-Inf -> BIGINT, bad values -> NULL.

    A plain double->bigint cast in the warehouse rounds half to even
    (1.5->2, 2.5->2, 1.7->2); Spark truncates, so round with ``rint`` first.
    Integers stay as they are: large ids do not fit a DOUBLE.
    """
    c = _c(x).cast("double")
    rounded = F.when(F.isnan(c) | is_inf(c), F.lit(None).cast("long")).otherwise(F.rint(c).cast("long"))
    return F.when(_is_integer(_c(x)), _c(x).cast("long")).otherwise(rounded)


def money(x: ColumnOrName) -> Column:
    """``cast(round(x) as bigint)``: amounts rounded half away from zero."""
    return F.when(_is_integer(_c(x)), _c(x).cast("long")).otherwise(F.round(_c(x).cast("double"), 0).cast("long"))


# ---------------------------------------------------------------- text

def clean_text(x: ColumnOrName) -> Column:
    """Trim spaces; empty string -> NULL."""
    return F.nullif(F.trim(_c(x)), F.lit(""))


def lower_trim(x: ColumnOrName) -> Column:
    return F.lower(F.trim(_c(x)))


def normalize_plate(x: ColumnOrName) -> Column:
    """Plate number: NULL -> '', trim, drop all whitespace, upper case."""
    return F.upper(F.regexp_replace(F.trim(F.coalesce(_c(x), F.lit(""))), r"\s+", ""))


# Order-status synonyms -> canonical status. Matching is on
# lower(trim(status)); anything else passes through as lower(trim(status)).
STATUS_SYNONYMS = {
    "delivered": ["delivered", "done", "finish", "finished", "success"],
    "return_to_sender": ["return_to_sender", "returned", "return"],
    "cancelled": ["cancelled", "canceled", "cancel"],
    "ready_to_pick": ["ready_to_pick", "ready", "waiting_pickup"],
    "picking": ["picking", "picked", "pickup"],
    "in_transit": ["in_transit", "transit", "transporting"],
    "delivering": ["delivering", "delivery", "shipping"],
}

CANONICAL_STATUSES = list(STATUS_SYNONYMS)
OUTCOME_GROUPS = ["success", "return", "cancelled", "in_progress"]


def _synonym_map() -> Column:
    pairs = []
    for canonical, words in STATUS_SYNONYMS.items():
        for w in words:
            pairs += [F.lit(w), F.lit(canonical)]
    return F.create_map(*pairs)


def normalize_order_status(x: ColumnOrName) -> Column:
    """Canonical order status (one map lookup instead of a CASE chain)."""
    key = lower_trim(x)
    return F.coalesce(F.try_element_at(_synonym_map(), key), key)


def order_outcome_group(status: ColumnOrName) -> Column:
    """Business outcome of a canonical status; NULL/unknown -> in_progress."""
    s = _c(status)
    return (F.when(s == "delivered", "success")
            .when(s == "return_to_sender", "return")
            .when(s == "cancelled", "cancelled")
            .otherwise("in_progress"))


# client_type (upper-cased) groups into a sales channel.
MARKETPLACES = ["SHOPEE", "LAZADA", "TIKI", "SENDO"]
CLIENT_CHANNELS = ["marketplace", "sme", "tts", "other"]


def client_channel(client_type: ColumnOrName) -> Column:
    u = F.upper(_c(client_type))
    return (F.when(u.isin(*MARKETPLACES), "marketplace")
            .when(u == "SME", "sme")
            .when(u == "TTS", "tts")
            .otherwise("other"))


# Package-event category -> event name; unknown -> NULL.
ACTION_NAMES = {
    "receive": "receive_package",
    "pack": "pack_to_bag",
    "unpack": "unpack_bag",
    "export": "export_to_truck",
    "return_receive": "return_receive",
    "return_export": "return_export",
}


def action_name(category: ColumnOrName) -> Column:
    pairs = []
    for k, v in ACTION_NAMES.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), _c(category))


# ---------------------------------------------------------------- dates

# A day in a text: year, month and day with the same mark between them ('-',
# '/', '\' or one blank), white space before it allowed.
_DAY = r"^\s*0*([1-9][0-9]{0,3})([-/\\ ])([0-9]{1,2})\2([0-9]{1,2})"
# A valid time of day after it, to the second or to the minute, or the day's end;
# what follows a 'Z', an offset or white space is not read.
_REST = r"(?:Z|[+-][0-9](?s:.*)|\s(?s:.*))?\z"
_HOUR = r"(?:T\s*|\s+)0*([01]?[0-9]|2[0-3]):([0-5]?[0-9])"
_SECOND = _DAY + _HOUR + r":([0-5]?[0-9])(\.[0-9]+)?\.?" + _REST
_MINUTE = _DAY + _HOUR + r"(?::(?:\.[0-9]*)?)?" + _REST
_END = _DAY + r"(?:T\s*|\s+)0*24:0?0(?::(?:0?0)?(?:\.0*)?)?" + _REST
_ALONE = _DAY + r"\z"
_ANY = _DAY + rf"(?:\s*\z|{_SECOND[len(_DAY):]}|{_MINUTE[len(_DAY):]}|{_END[len(_DAY):]})"
# How nearly all texts look; the cast alone reads these.
_PLAIN_DAY = r"^[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}\z"
_PLAIN_TIME = r"^[1-9][0-9]{3}-[0-9]{2}-[0-9]{2} (?:[01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]\z"


def _read(s: Column, pattern: str, kind: str, rest: str = "") -> Column:
    """A text that matches ``pattern``, rewritten for the cast. Zeros before a
    year are read over, up to 7 digits in a day and 6 in a time; 4 are needed."""
    zeros = "000" if kind == "date" else "00"
    return F.regexp_replace(s, pattern, zeros + "$1-$3-$4" + rest).try_cast(kind)


def parse_date(x: ColumnOrName) -> Column:
    """Text -> DATE, unparsable -> NULL. The whole text must be a day, or a day
    and a valid time. Years before 1 (``-44-03-15``, ``(BC)``) or after 9999
    and the words ``epoch`` and ``infinity`` are NULL."""
    s = _c(x).cast("string")
    return F.when(s.rlike(_PLAIN_DAY), s.try_cast("date")).when(s.rlike(_ANY), _read(s, _ANY, "date"))


def parse_timestamp(x: ColumnOrName) -> Column:
    """Text -> zone-less TIMESTAMP, unparsable -> NULL; as :func:`parse_date`,
    but a day alone has no white space after it, and years before 10 are NULL
    too. Offsets and zones are not applied; 24:00:00 is the next day's start."""
    s = _c(x).cast("string")
    return (F.when(s.rlike(_PLAIN_TIME), s.try_cast("timestamp_ntz"))
            .when(s.rlike(_SECOND), _read(s, _SECOND, "timestamp_ntz", " $5:$6:$7$8"))
            .when(s.rlike(_MINUTE), _read(s, _MINUTE, "timestamp_ntz", " $5:$6:00"))
            .when(s.rlike(_END), F.date_add(_read(s, _END, "date"), 1).cast("timestamp_ntz"))
            .when(s.rlike(_ALONE), _read(s, _ALONE, "timestamp_ntz")))


def seconds_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Number of whole-second boundaries crossed from ``start`` to ``end``.

    ``timestampdiff(SECOND)`` counts elapsed whole seconds (0.9 s -> 1.1 s
    gives 0); the warehouse counts boundaries (gives 1). Epoch seconds of
    each side, then subtract. NULL if either side is NULL.
    """
    return (F.unix_seconds(_c(end).cast("timestamp"))
            - F.unix_seconds(_c(start).cast("timestamp")))


def hours_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    return seconds_between(start, end).cast("double") / F.lit(3600.0)


def date_key(d: ColumnOrName) -> Column:
    """DATE -> INT yyyymmdd (arithmetic, no string formatting)."""
    c = _c(d)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def week_start(d: ColumnOrName) -> Column:
    """Monday of the ISO week, as DATE."""
    return F.trunc(_c(d), "week")


def tenure_days(hire: ColumnOrName, as_of: ColumnOrName | None = None) -> Column:
    ref = F.current_date() if as_of is None else _c(as_of)
    return F.when(_c(hire).isNotNull(), F.datediff(ref, _c(hire)).cast("long"))


def volumetric_weight(weight: ColumnOrName, length: ColumnOrName,
                      width: ColumnOrName, height: ColumnOrName) -> Column:
    """Chargeable weight: max(actual, l*w*h // 6)."""
    vol = F.floor((_c(length) * _c(width) * _c(height)) / F.lit(6)).cast("long")
    return F.greatest(_c(weight).cast("long"), vol)


def add_hours(ts: ColumnOrName, hours: ColumnOrName, minutes: ColumnOrName | int = 0) -> Column:
    h = _c(hours) if not isinstance(hours, int) else F.lit(hours)
    m = _c(minutes) if not isinstance(minutes, int) else F.lit(minutes)
    return _c(ts) + F.make_dt_interval(F.lit(0), h.cast("int"), m.cast("int"), F.lit(0))
