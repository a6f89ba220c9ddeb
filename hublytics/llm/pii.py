"""Personal data in texts (DataFrame functions only; no shuffle).

Regular expressions propose spans, validators confirm them (Luhn for cards,
mod-97 for IBANs of a country's length, ranges and digit counts for the rest) and words near a span
raise its score. The kinds ``email``, ``ip``, ``card`` and ``phone`` are the
base: every confirmed one is a span, whatever its score. ``iban`` and ``ssn``
are spans when their score reaches ``MIN_SCORE``; an ``ssn`` has no checksum,
so only context brings it there.

How it runs: Spark's regex functions give a pattern's matches and the pieces
between them, but no positions. Positions are running sums of the lengths of
pieces and matches, taken in blocks of BLOCK matches, so a text with very many
matches costs its number of matches, not its square. Patterns are written
with possessive repeats where that cannot change a match, which keeps them
linear and free of recursion on very long texts. Context is the CONTEXT
characters of the text on both sides, put together from the neighbouring pieces
and matches; in a list (matches with no letter between them) a match's context
holds for those after it. Everything is one pass over the text column.

Positions are code points, end exclusive. Defined cases: null text is empty
and has no spans; ties in position keep the order of ``KINDS``; repeated rows
are treated alike; further columns stay as they are; an empty table gives no
rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hublytics.llm.common import text_or_empty

BLOCK = 256
CONTEXT = 40
MIN_SCORE = 0.5
CONTEXT_BONUS = 0.25

_LOCAL = r"[A-Za-z0-9._%+-]"
_LABEL = r"[A-Za-z0-9-]"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str      # proposes
    confirm: str      # SQL condition on x.m (match), x.before, x.after
    score: float      # of a confirmed match without context
    context: str      # words, lower case, that raise the score
    base: bool = True
    needs: str = ""   # a character without which there is no match
    least: int = 1    # characters of the shortest match


def _digits(keep: str = "x.m") -> str:
    return f"regexp_replace({keep}, '[^0-9]', '')"


_LUHN = (f"aggregate(transform(split(reverse({_digits()}), ''), "
         "(d, i) -> if(i % 2 = 1, if(int(d) > 4, 2 * int(d) - 9, 2 * int(d)), int(d))), 0, (s, d) -> s + d) % 10 = 0")
# the number is read digit by digit; letters count as 10 .. 35
_COMPACT = "replace(x.m, ' ', '')"
_MOD97 = (f"aggregate(split(concat(substr({_COMPACT}, 5), left({_COMPACT}, 4)), ''), 0, "
          "(s, c) -> if(c < 'A', (s * 10 + int(ascii(c)) - 48) % 97, (s * 100 + int(ascii(c)) - 55) % 97)) = 1")

#: fixed values: length of an IBAN by country
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC"}


def iban_pattern(ahead: str = "(?=[A-Z]{2}[0-9]{2})") -> str:
    """Numbers of a known country end where its length ends, so a word behind
    them is no part; then any two letters and as many as there can be.
    ``ahead`` saves trying every country at every place."""
    known = "|".join(f"(?:{'|'.join(names.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, names in IBAN_LENGTHS.items())
    return f"{ahead}(?:{known}|[A-Z]{{2}}[0-9]{{2}}(?:[A-Z0-9]{{11,30}}|(?: [A-Z0-9]{{4}}){{2,7}}(?: [A-Z0-9]{{1,3}})?))"


KINDS = [
    # a match starts at a run's first character, or where the match before it ended
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++", "true", 0.7,
         "mail|contact|write to|send", needs="@", least=5),
    Kind("ip", r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", rf"x.m rlike r'^{_OCTET}(?:\.{_OCTET}){{3}}$'", 0.5,
         "\\\\bip\\\\b|address|host|server|login", needs=".", least=7),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++",
         f"length(x.m) >= 14 and length({_digits()}) between 14 and 19 and {_LUHN}", 0.7,
         "card|visa|master|credit|payment|account", least=2),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_digits()}) between 10 and 15", 0.5,
         "phone|\\\\btel|call|mobile|\\\\bfax", needs="+", least=4),
    Kind("iban", iban_pattern(),
         f"not x.before rlike '[A-Za-z0-9]$' and not coalesce(x.after, '') rlike '^[A-Za-z0-9]' and {_MOD97}", 0.7, "iban|account|bank|\\\\bbic\\\\b|swift", base=False, least=15),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
         "not x.before rlike '[0-9-]$' and not coalesce(x.after, '') rlike '^[0-9-]' and not x.m rlike '^(000|666|9)|-00-|-0000$'", 0.3,
         "\\\\bssn\\\\b|social security", base=False, needs="-", least=11),
]


def _in_context(i: int, k: Kind) -> str:
    """SQL: the ``__z`` array of kind i with ``hit``, whether a context word is
    near, and ``listed``, whether only separators are before the match."""
    some = -(-CONTEXT // k.least)  # so many matches fill the context
    before = (f"if(x.gap < {CONTEXT} and j > 0, right(concat(array_join(flatten(transform(slice(__z{i}, greatest(j - {some - 1}, 1), "
              f"least(j, {some})), y -> array(y.before, y.m))), ''), x.before), {CONTEXT}), x.before)")
    after = (f"if(length(x.after) < {CONTEXT}, left(concat(x.after, array_join(flatten(transform(slice(__z{i}, j + 2, {some}), "
             f"y -> array(y.m, y.after))), '')), {CONTEXT}), coalesce(x.after, ''))")
    return f"""transform(__z{i}, (x, j) -> struct(x.m as m, x.gap as gap, x.before as before, x.after as after,
        concat({before}, ' ', {after}) rlike '(?i){k.context}' as hit,
        x.gap <= {CONTEXT} and not x.before rlike '\\\\p{{L}}' as listed))"""


def _located(i: int) -> str:
    """SQL: array of (start, m, before, after, near) of kind i from its ``__y`` array."""
    item = "struct<start:int,m:string,before:string,after:string,near:boolean>"
    near = "x.hit or (a.near and x.listed)"
    one = f"struct(a.pos + x.gap as start, x.m as m, x.before as before, x.after as after, {near} as near)"
    return f"""flatten(aggregate(
        transform(sequence(0, (size(__y{i}) - 1) div {BLOCK}), b -> slice(__y{i}, b * {BLOCK} + 1, {BLOCK})),
        struct(0 as pos, false as near, cast(array() as array<array<{item}>>) as out),
        (acc, block) -> aggregate(
            filter(block, x -> x.m is not null),
            struct(acc.pos as pos, acc.near as near, cast(array() as array<{item}>) as out),
            (a, x) -> struct(a.pos + x.gap + length(x.m) as pos, {near} as near, concat(a.out, array({one})) as out),
            a -> struct(a.pos as pos, a.near as near, concat(acc.out, array(a.out)) as out)),
        acc -> acc.out))"""


def _spans(i: int, k: Kind) -> str:
    span = (f"struct(x.start as start, {i} as kind_no, x.start + length(x.m) as end, '{k.name}' as kind, x.m as text, "
            f"if(x.near, {k.score + CONTEXT_BONUS}D, {k.score}D) as score)")
    found = f"transform(filter(__at{i}, x -> {k.confirm}), x -> {span})"
    return found if k.base else f"filter({found}, s -> s.score >= {MIN_SCORE}D)"


def find(docs: DataFrame, text: str = "text", out: str = "pii", kinds: list[Kind] = KINDS) -> DataFrame:
    """``docs`` with ``out``: array of (start, kind_no, end, kind, text, score)
    ordered by start, then kind."""
    cols = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(*cols, text_or_empty(f"`{text}`").alias("__t"))
    cut = {}
    for i, k in enumerate(kinds):
        maybe = F.contains(F.col("__t"), F.lit(k.needs)) if k.needs else F.lit(True)
        cut[f"__m{i}"] = F.when(maybe, F.regexp_extract_all("__t", F.lit(k.pattern), F.lit(0)))
        cut[f"__p{i}"] = F.when(maybe, F.split("__t", k.pattern, -1))
    rows = rows.withColumns(cut)
    # pieces are used several times from here on: Spark keeps them as computed columns
    rows = rows.withColumns({f"__z{i}": F.expr(
        f"""if(size(__m{i}) > 0, zip_with(
              zip_with(__m{i}, __p{i}, (m, p) -> struct(m as m, length(p) as gap, right(p, {CONTEXT}) as before)),
              slice(__p{i}, 2, size(__p{i})),
              (a, q) -> struct(a.m as m, a.gap as gap, a.before as before, left(q, {CONTEXT}) as after)), array())""")
        for i in range(len(kinds))})
    rows = rows.withColumns({f"__y{i}": F.expr(f"if(size(__z{i}) > 0, {_in_context(i, k)}, array())")
                             for i, k in enumerate(kinds)})
    rows = rows.withColumns({f"__at{i}": F.expr(f"if(size(__y{i}) > 0, {_located(i)}, array())")
                             for i in range(len(kinds))})
    spans = F.array_sort(F.concat(*[F.expr(_spans(i, k)) for i, k in enumerate(kinds)]))
    return rows.select(*cols, spans.alias(out))


def redact(docs: DataFrame, text: str = "text", kinds: list[Kind] = KINDS) -> DataFrame:
    """``docs`` with every span of :func:`find` replaced by its kind in angle
    brackets; of overlapping spans the first is named, the union is removed."""
    rows = find(docs, text, "__pii", kinds)
    body = f"coalesce(`{text}`, '')"
    put = F.expr(f"""aggregate(__pii, struct(1 as pos, cast(array() as array<string>) as out),
        (a, s) -> struct(greatest(a.pos, s.end + 1) as pos,
                         if(s.start + 1 >= a.pos,
                            concat(a.out, array(substr({body}, a.pos, s.start + 1 - a.pos), concat('<', s.kind, '>'))),
                            a.out) as out),
        a -> concat(array_join(a.out, ''), substr({body}, a.pos)))""")
    return rows.withColumn(text, F.when(F.size("__pii") > 0, put).otherwise(F.col(f"`{text}`"))).drop("__pii")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores (of the
    spans, in their order)."""
    rows = find(docs.select("doc_id", "text")).select("doc_id", "pii")
    listed = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = [k.name for k in KINDS if k.base]
    count = lambda name: F.size(F.filter("pii", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")
    return rows.select(
        "doc_id", *[count(n) for n in base],
        F.sha2(listed(F.filter("pii", lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("pii")).alias("spans"),
        F.array_join(F.transform("pii", lambda s: F.format_string("%.2f", s["score"])), ",").alias("scores"))
