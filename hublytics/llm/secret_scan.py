"""Secrets in texts: base patterns and assignment-aware lexing.

The base kinds are patterns over the whole text: ``assign`` (a telling name,
an assignment mark, a value of six or more characters), ``access`` (an access
key id) and ``hex`` (long runs of hex digits).

The method reads a text as source or configuration: lines with an assignment
mark are lexed into strings, names, marks and comments and parsed into
name-literal pairs (``name = "a" + "b"``, ``name: value``, ``"name": "value"``,
``name := other``). Names stand for the literals last assigned to them, so a
literal reaches a sensitive name through constants and concatenations too, also
over line ends after an open bracket, a joining mark or YAML's block mark. The
literals that reach a target are scored by how sensitive the target's name is
and by how random the joined value looks; white space and placeholder words lower
the score of a quoted literal, references to values elsewhere score nothing.
Literals that reach MIN_SCORE are spans of kind ``literal``, where the text
stands, without its quotes.

How it runs: one pass over the texts without a shuffle; texts are lexed only
if a sensitive name occurs in them.

Positions are code points, end exclusive. Defined cases: null text is empty
and has no spans; a constant is looked up among the assignments above it, so
references never run in a circle; equal positions keep the order assign,
access, hex, literal; repeated rows are treated alike; columns besides doc_id
and text are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hublytics.llm.common import slices

MIN_SCORE = 0.6
MIN_LENGTH = 6
KINDS = ("assign", "access", "hex", "literal")


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: fixed values: the names of the base kind ``assign``
ASSIGN_NAMES = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = re.compile("(" + "|".join(re.sub("[a-z]", lambda m: _either(m[0]), n) for n in ASSIGN_NAMES)
                    + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_HINTS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# runs of fewer digits are no match of the contract: only runs of enough digits are looked for
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")

#: how telling a target's name is, by its parts (whole words of it, or several in a row; the largest counts)
SENSITIVE = {"passwords": 0.6, "secrets": 0.6, "credentials": 0.55, "password": 0.6, "passwd": 0.6, "passphrase": 0.6, "pwd": 0.5, "secret": 0.6, "token": 0.55, "apikey": 0.6,
             "privatekey": 0.6, "accesskey": 0.6, "credential": 0.55, "signingkey": 0.6, "encryptionkey": 0.6,
             "auth": 0.4, "authorization": 0.4, "bearer": 0.5, "connectionstring": 0.5, "key": 0.3, "salt": 0.35, "pass": 0.35}
#: words that also count at the end of a longer one (``dbpassword``); ordinary words do not end in them
ENDINGS = ("password", "passwd", "passphrase", "secret", "token", "apikey", "privatekey", "accesskey", "credential", "credentials")
SENSITIVE_HINT = re.compile(r"pass|pwd|secret|token|key|credential|auth|bearer|connection|salt")
#: what a placeholder consists of; the whole literal, or how it starts
_FILLER = (r"password|passphrase|passwd|pass|secret|token|please|replace|change|insert|example|sample|default|redacted|undefined|hidden|dummy"
           r"|empty|enter|none|null|true|false|fake|test|todo|some|your|here|this|that|with|value|the|key|api|my|me|it")
PLACEHOLDER = re.compile(rf"(?i)(?:x+|0+|[\W_]+|{_FILLER})++")
PLACEHOLDER_START = re.compile(rf"(?i)<|\$\{{|\{{\{{|%\(|\$[A-Z_]+$|(?:{_FILLER})[\W_a-z]*$")
#: a literal that only refers to a value kept elsewhere
REFERENCE = re.compile(r"\$\{[^}]*\}|\{\{[^}]*\}\}|%\([^)]*\)s|\$[A-Z_]+")
SCHEME = re.compile(r"(?i)(?:bearer|basic|token)\s+(?=\S)")
#: what a literal's score loses as a whole placeholder, for a start like one, for white space inside
ALL_FILLER, SOME_FILLER, SPACED = 0.4, 0.1, 0.15
#: characters of a value's start that are looked at for how it starts, and for filler written in parts
HEAD = 256

_TOKEN = re.compile(r"""
    (?P<space>[ \t]+)
  | (?P<comment>(?:\#|//|--[ ]).*)
  | (?P<string>(?:\"\"\"(?:\\.|[^\\])*?\"\"\")|(?:'''(?:\\.|[^\\])*?''')|"(?:\\.|[^"\\\n])*"|'(?:\\.|[^'\\\n])*'|`(?:\\.|[^`\\\n])*`)
  | (?P<mark>:=|=>|[=!<>]=|[=:])
  | (?P<plus>\+|\.\.(?!\.))
  | (?P<name>[A-Za-z_$][A-Za-z0-9_$]*(?:[.-][A-Za-z0-9_$]+)*)
  | (?P<other>.)
""", re.X)
_ASSIGNS = {"=", ":", ":=", "=>"}
_BARE = re.compile(r"[^\s#,;'\"]+")
_OPENING = re.compile(r"[a-zA-Z]{0,2}$")
#: what may stand between the parts of a value: on a line, and where it runs over line ends
_GAP = re.compile(r"(?:[ \t]|\\\r?\n)*+")
_WIDE_GAP = re.compile(r"(?:\s|\\\r?\n|(?:\#|//)[^\n]*)*+")
_NAMED = re.compile(r"[ \t]*(?::=|=>|=(?!=)|:)")
#: the head of a YAML block value; the indent of a line's key
_BLOCK = re.compile(r"[ \t]*[|>][-+0-9]{0,2}[ \t]*(?:\#[^\n]*)?\r?\n")
_INDENT = re.compile(r" *(?:- +)*")


_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def _weight(name: str) -> float:
    """By the words of the name's last part: cut at case and separators and
    compared whole, alone and joined with those after them."""
    words = [w.lower() for w in _PART.findall(re.split(r"[.\[\]]", name)[-1])]
    best = 0.0
    for i in range(len(words)):
        joined = ""
        for w in words[i: i + 3]:
            joined += w
            best = max(best, SENSITIVE.get(joined, 0.0))
        best = max([best, *(SENSITIVE[e] for e in ENDINGS if words[i].endswith(e))])
    return best


def _randomness(counts: dict[str, int]) -> float:
    """0 .. 0.4: entropy a character and the mix of character classes."""
    n = sum(counts.values())
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    mixed = sum(any(re.match(p, c) for c in counts) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(0.25, max(0.0, (entropy - 1.5) * 0.125)) + 0.05 * (mixed - 1)


def _without_scheme(literal: str) -> str:
    return SCHEME.sub("", literal, count=1) if SCHEME.match(literal) else literal


def _penalty(v: _Value) -> float:
    head, counts = v.head, v.counts
    if v.reference:
        return 1.0
    scheme = SCHEME.match(head)
    head = _without_scheme(head)
    # a value joined of parts is filler if each part is, or if together they read so
    lost = ALL_FILLER if v.filler or v.size <= HEAD and PLACEHOLDER.fullmatch(head) else 0.0
    if not lost and PLACEHOLDER_START.match(head):
        lost = SOME_FILLER
    spaces = sum(n for c, n in counts.items() if c.isspace()) - sum(c.isspace() for c in (scheme[0] if scheme else ""))
    return lost + (SPACED if spaces > 0 else 0.0)


Literal = tuple[int, int, bool]  # start, end, quoted


def pairs(text: str) -> Iterator[tuple[str, list[Literal | str]]]:
    """(target name, value) in order of the text; a value is a list of
    literals and of names that stand for earlier values."""
    line_start, size = 0, len(text)
    while line_start < size:
        line_end = text.find("\n", line_start)
        line_end = size if line_end < 0 else line_end
        if text.find("=", line_start, line_end) < 0 and text.find(":", line_start, line_end) < 0:
            line_start = line_end + 1
            continue
        before: list[tuple[str, int, int]] = []  # tokens since the last value
        at = line_start
        while at < line_end:
            m = _TOKEN.match(text, at)
            if m is None:
                break
            kind, at = m.lastgroup, m.end()
            if kind == "comment":
                at = line_end
            elif kind == "mark" and m[0] in _ASSIGNS and before and before[-1][0] in ("name", "string"):
                what, lo, hi = before[-1]
                # "name: type = value" in source: the value belongs to the name before the colon
                typed = m[0] == "=" and len(before) > 2 and before[-2][0] == ":" and before[-3][0] == "name"
                what, lo, hi = before[-3] if typed else (what, lo, hi)
                name = text[lo:hi].strip("\"'`")
                block = _BLOCK.match(text, at) if m[0] == ":" else None
                value, end = _block(text, line_start, block.end()) if block else _value(text, at, line_end)
                typed = _NAMED.match(text, end, line_end) if m[0] == ":" and isinstance(value[:1] and value[0], str) else None
                if typed and typed[0].strip() == "=":  # "name: type", its value follows
                    before += [(":", m.start(), m.end()), ("name", m.end(), end)]
                    at = end
                    continue
                at = end
                if value:
                    yield name, value
                    before = []
                else:
                    before.append((m[0], m.start(), m.end()))
            elif kind != "space":
                before.append((m[0] if kind == "mark" else kind, m.start(), m.end()))
        # a value may have run over line ends
        line_start = line_end + 1 if at <= line_end else at + (text[at: at + 1] == "\n")


def _block(text: str, line_start: int, at: int) -> tuple[list[Literal | str], int]:
    """The lines from ``at`` on that are indented more than the key of the line."""
    indent = _INDENT.match(text, line_start).end() - line_start
    parts: list[Literal | str] = []
    end = at - 1
    while at < len(text):
        stop = text.find("\n", at)
        stop = len(text) if stop < 0 else stop
        line = text[at:stop]
        body = line.strip()
        if body:
            lead = len(line) - len(line.lstrip())
            if lead <= indent:
                break
            parts.append((at + lead, at + lead + len(body), True))
            end = stop
        at = stop + 1
    return parts, end


def _value(text: str, at: int, line_end: int) -> tuple[list[Literal | str], int]:
    """The parts joined by + from ``at`` on, and where they end. After an open
    bracket or a joining mark a value goes on over line ends; in a bracket
    strings are joined without a mark."""
    parts: list[Literal | str] = []
    depth, joined = 0, False
    while True:
        start = at
        while True:
            at = (_WIDE_GAP if depth or joined else _GAP).match(text, at).end()
            if text[at: at + 1] != "(":
                break
            depth, at = depth + 1, at + 1
        if at > line_end:
            line_end = text.find("\n", at)
            line_end = len(text) if line_end < 0 else line_end
            m = _TOKEN.match(text, at)
            if m is None or m.lastgroup in ("name", "string") and _NAMED.match(text, m.end()):
                return parts, start  # the next assignment
        m = _TOKEN.match(text, at) if at < line_end else None
        if m is None:
            return parts, min(at, line_end)
        if m.lastgroup == "name" and _OPENING.match(m[0]) and text[m.end(): m.end() + 1] in ("'", '"'):
            m = _TOKEN.match(text, m.end())  # a string's prefix
            if m is None or m.lastgroup != "string":
                return parts, at
        if m.lastgroup == "string":
            quote = 3 if m[0][:3] in ('"""', "'''") else 1
            parts.append((m.start() + quote, m.end() - quote, True))
            at = m.end()
        elif m.lastgroup in ("name", "other"):
            bare = _BARE.match(text, at, line_end)
            if bare is None:
                return parts, at
            if m.lastgroup == "name" and m.end() == bare.end():
                parts.append(m[0])  # a constant if it is known, else a bare literal
            parts.append((bare.start(), bare.end(), False))
            at = bare.end()
        else:
            return parts, at
        if at > line_end:  # a string that runs over line ends
            line_end = text.find("\n", at)
            line_end = len(text) if line_end < 0 else line_end
        after, string = at, m.lastgroup == "string"
        while True:
            after = (_WIDE_GAP if depth else _GAP).match(text, after).end()
            if not depth or text[after: after + 1] != ")":
                break
            depth, after = depth - 1, after + 1
        rest = _TOKEN.match(text, after)
        joined = rest is not None and rest.lastgroup == "plus"
        if joined:
            at = rest.end()
        elif not (depth and string and rest is not None and rest.lastgroup == "string"):
            return parts, at
        if at > line_end:
            line_end = text.find("\n", at)
            line_end = len(text) if line_end < 0 else line_end


class _Value:
    """What a name stands for: its own literals and the values it is made of,
    each once. Counts of its characters are sums, so a value costs what is new."""

    __slots__ = ("own", "made_of", "counts", "size", "head", "quoted", "best", "filler", "reference")

    def __init__(self, text: str, own: list[Literal], made_of: list[_Value], order: list[Literal | _Value]):
        self.own, self.made_of, self.best = own, made_of, None
        self.counts: Counter[str] = Counter()
        for a, b, _ in own:
            self.counts.update(text[a:b])
        for v in made_of:
            self.counts.update(v.counts)
        self.size = sum(self.counts.values())
        while self.size > 1 << 40:  # only the proportions count
            self.counts = Counter({c: max(1, n >> 20) for c, n in self.counts.items()})
            self.size = sum(self.counts.values())
        self.head = ""
        for p in order:
            if len(self.head) >= HEAD:
                break
            self.head = (self.head + (p.head if isinstance(p, _Value) else text[p[0]: min(p[1], p[0] + HEAD)]))[:HEAD]
        self.quoted = all(q for *_, q in own) and all(v.quoted for v in made_of)
        # whole literals, whatever their length
        self.filler = all(PLACEHOLDER.fullmatch(_without_scheme(text[a:b])) for a, b, _ in own) and all(v.filler for v in made_of)
        self.reference = (len(own) == 1 and not made_of and REFERENCE.fullmatch(_without_scheme(text[own[0][0]: own[0][1]])) is not None
                          or not own and len(made_of) == 1 and made_of[0].reference)


def literals(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, target, score) of the literals that reach a sensitive name."""
    known: dict[str, _Value] = {}
    values: list[_Value] = []
    for name, value in pairs(text):
        order: list[Literal | _Value] = []
        refers = False
        for p in value:
            if isinstance(p, str):
                refers = p in known
                if refers:
                    order.append(known[p])
            elif refers:
                refers = False  # the same word, already replaced by what it stands for
            else:
                order.append(p)
        own = [p for p in order if not isinstance(p, _Value)]
        made_of = list({id(p): p for p in order if isinstance(p, _Value)}.values())
        v = known[name] = _Value(text, own, made_of, order)
        values.append(v)
        weight = _weight(name)
        if not weight or v.size < MIN_LENGTH:
            continue
        if not v.quoted and (all(c.isalpha() for c in v.counts) or not any(c in "0123456789" for c in v.counts)):
            continue  # a bare word of prose or a call, not a value
        lost = _penalty(v)
        if lost and not v.quoted:
            continue
        score = min(1.0, weight + _randomness(v.counts)) - lost
        if score >= MIN_SCORE:
            v.best = (score, -len(values), name)
    # a value is made of earlier ones only: from the last to the first, each hands its score down
    found: dict[tuple[int, int], tuple[float, int, str]] = {}
    for v in reversed(values):
        if v.best is None:
            continue
        for w in v.made_of:
            w.best = v.best if w.best is None else max(w.best, v.best)
        for a, b, _ in v.own:
            if b > a:
                found[a, b] = max(found.get((a, b), v.best), v.best)
    return [(a, b, name, score) for (a, b), (score, _, name) in sorted(found.items())]


def spans(text: str) -> list[tuple[int, int, str, str, float]]:
    """(start, end, kind, name, score), ordered by start, then kind."""
    low = text.lower()
    out: list[tuple[int, int, int, str, float]] = []
    if any(h in low for h in ASSIGN_HINTS):
        out += [(m.start(), 0, m.end(), m[1], 1.0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), "", 1.0) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "", 1.0) for m in HEX.finditer(text)]
    if SENSITIVE_HINT.search(low):
        out += [(a, 3, b, name, score) for a, b, name, score in literals(text)]
    return [(a, b, KINDS[k], name, score) for a, k, b, name, score in sorted(out)]


_SPAN = "array<struct<start:int,end:int,kind:string,name:string,score:double>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()),
                               ("name", pa.string()), ("score", pa.float64())]))
    for b in slices(batches):
        found = [[dict(zip(("start", "end", "kind", "name", "score"), s, strict=True)) for s in spans(t.as_py() or "")]
                 for t in b.column(1)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind)], ["doc_id", "secrets"])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and secrets (array of start, end, kind, name, score) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_scan, f"doc_id {kind}, secrets {_SPAN}")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    listed = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = KINDS[:3]
    count = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return scan(docs).select(
        "doc_id", *[count(k) for k in base],
        F.sha2(listed(F.filter("secrets", lambda s: s["kind"].isin(*base))).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"))
