"""Secret scan by assignment-aware lexing.

Base rules find fixed shapes (`assign`, `access`, `hex`). Beyond them, source and configuration syntax is lexed into
name-literal pairs: ``name = "x"``, ``"name": "x"``, ``name: x``, ``name := 'x'``, ``--name x``, ``<name>x</name>``, ``c["name"] = "x"``,
``setName("x")``, ``put("name", "x")``, ``name = call("x")``, ``name:`` with ``x`` alone on the next, deeper line, and ``scheme://user:x@host``. A literal bound to a name is carried along when that name is assigned to another one or joined with ``+``,
and a literal is reported (`lit`) when one of the names that it reaches is a sensitive one and its own shape is
plausible for a secret. Names and literals may have any length; a literal ends with its line. What is in a quoted literal is lexed too, with
names of its own. What a base rule covers already is not reported again.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm import scratch
from pagewright.llm.text import releasing

KINDS = ("assign", "access", "hex", "lit")
#: The base rules.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
HEX = re.compile(rb"[0-9a-f]{24,}")
NAMES = (b"passw", b"secret", b"token", b"apikey", b"api_key")

# No length is bounded: a class is repeated possessively up to the quote, tag or delimiter that it leaves out, so each kind of text is read once.
_NAME = rb"[A-Za-z_$][A-Za-z0-9_$.-]*+"
_LITERAL = rb"\"(?!\")[^\"\\\r\n]*+(?:\\.[^\"\\\r\n]*+)*+\"|'(?!')[^'\\\r\n]*+(?:\\.[^'\\\r\n]*+)*+'|`[^`\r\n]++`"
PAIR = re.compile(
    rb"(?:(?P<q>[\"'])|(?<![A-Za-z0-9_$.-])[0-9.-]*+)(?P<name>" + _NAME + rb")(?(q)(?P=q))[\x20\t]*+(?::=|=>|=(?!=)|:(?![:/]))[\x20\t]*+(?P<value>(?:[bru]{1,2}(?=[\"'])|)(?:" + _LITERAL + rb")(?:[\x20\t]*+\+[\x20\t]*+(?:" + _LITERAL + rb"|" + _NAME + rb"))*+|[^\s\"'`,;(){}\[\]<>|]++)"
)
FLAG = re.compile(rb"(?<![\w-])--(?P<name>" + _NAME + rb")[\x20=](?P<value>" + _LITERAL + rb"|[^\s\"'`-][^\s\"'`]{5,}+)")
TAG = re.compile(rb"<(?P<name>" + _NAME + rb")>[\x20\t]*+(?P<value>[^<>\s]{6,}+)[\x20\t]*+</(?P=name)>")
URL = re.compile(rb"[a-z][a-z0-9+.-]{1,15}://[^\s:/@\"']++:(?P<value>[^\s:/@\"']{6,}+)@")
_TIGHT = rb"\"[^\"\\\s]++\"|'[^'\\\s]++'"
SUBSCRIPT = re.compile(rb"\[[\x20\t]*+(?P<q>[\"'])(?P<name>" + _NAME + rb")(?P=q)[\x20\t]*+\][\x20\t]*+(?::=|=>|=(?!=))[\x20\t]*+(?P<value>" + _LITERAL + rb"|" + _NAME + rb")")
SETTER = re.compile(rb"(?<![A-Za-z0-9_$])(?:set|with|put|add)_?+(?P<name>[A-Za-z][A-Za-z0-9_]*+)\([\x20\t]*+(?P<value>" + _TIGHT + rb"|" + _NAME + rb")[\x20\t]*+\)")
PUT = re.compile(rb"\([\x20\t]*+(?P<q>[\"'])(?P<name>" + _NAME + rb")(?P=q)[\x20\t]*+,[\x20\t]*+(?P<value>" + _TIGHT + rb"|" + _NAME + rb")[\x20\t]*+\)")
BLOCK = re.compile(
    rb"(?m)^(?P<indent>[\x20\t]*+)(?P<q>[\"']?)(?P<name>" + _NAME + rb")(?P=q)[\x20\t]*+:[\x20\t]*+(?:[|>][+-]?+[\x20\t]*+)?+\r?\n(?P=indent)[\x20\t]++(?P<value>(?:" + _TIGHT + rb"|[^\s\"'`,;:(){}\[\]<>|]++)(?=[\x20\t]*+\r?$))"
)
#: Arguments of a call that a name is assigned.
ARGUMENTS = re.compile(rb"\((?P<value>[\x20\t]*+(?:" + _TIGHT + rb"|" + _NAME + rb")(?:[\x20\t]*+,[\x20\t]*+(?:" + _TIGHT + rb"|" + _NAME + rb"))*+)[\x20\t]*+\)")
_CONSTANT = re.compile(rb"[A-Z][A-Z0-9_]*+$")
PART = re.compile(_LITERAL + rb"|" + _NAME)
_WORDS = re.compile(rb"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")

#: How far each word of a name speaks for a secret.
SENSITIVE = {
    b"password": 1.0, b"passwords": 1.0, b"secrets": 1.0, b"tokens": 0.3, b"keys": 0.4, b"passwd": 1.0, b"passphrase": 1.0, b"pwd": 0.9, b"pass": 0.8, b"secret": 1.0, b"token": 0.9, b"apikey": 1.0, b"credential": 0.9,
    b"credentials": 0.9, b"bearer": 0.8, b"private": 0.5, b"api": 0.4, b"access": 0.4, b"auth": 0.6, b"signing": 0.5, b"encryption": 0.5, b"client": 0.1, b"key": 0.4,
}
HARMLESS = {b"public", b"length", b"name", b"type", b"count", b"file", b"path", b"url", b"id", b"field", b"policy", b"expiry", b"min", b"max", b"tokenizer"}
PLACEHOLDER = re.compile(rb"(?i)^(?:x+|\*+|\.+|-+|null|none|nil|true|false|undefined|change_?me|placeholder|example.*|your[_-].*|test|todo|password|secret|token|\$\{.*\}|\$[A-Z_]+|%\(?.*|<.*>|\{\{.*\}\})$")


def sensitivity(name: bytes) -> float:
    words = [w.lower() for w in _WORDS.findall(name)]
    if any(w in HARMLESS for w in words[-1:]):
        return 0.0
    return min(1.0, sum(SENSITIVE.get(w, 0.0) for w in words))


def plausibility(literal: bytes, quoted: bool) -> float:
    """From 0 to 1: long, varied literals of more than one kind of character; bare ones need a digit."""
    n = len(literal)
    if n < 8 or PLACEHOLDER.match(literal) or b"://" in literal or b" " in literal and n < 16:
        return 0.0
    kinds = sum(bool(re.search(p, literal)) for p in (rb"[a-z]", rb"[A-Z]", rb"\d", rb"[^\w\s]"))
    if not quoted and not (re.search(rb"\d", literal) and kinds > 1):
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(literal).values())
    return min(1.0, entropy / 3) * (1.0 if kinds > 1 else 0.6)


def _unquoted(value: bytes, at: int) -> tuple[int, int, bool]:
    if value[:1] in b"\"'`" and len(value) > 1:
        return at + 1, at + len(value) - 1, True
    return at, at + len(value), False


def _bind(raw: bytes, found, events: list[tuple[bytes, list[tuple[int, int, bool]], list[int]]]) -> None:
    """Adds the assignments ``found``: name, literals, and the events that it refers to. What is inside a pair's quotes follows, with names of its own."""
    bound: dict[bytes, int] = {}
    inside: list[tuple[int, int]] = []
    for m in found:
        value, at = m["value"], m.start("value")
        own: list[tuple[int, int, bool]] = []
        refs: list[int] = []
        parts = list(PART.finditer(value)) if b'"' in value or b"'" in value or b"`" in value else []
        quoted = [(at + x.start(), at + x.end()) for x in parts if x[0][:1] in b"\"'`"]
        if m.re is PAIR:
            inside += [(a + 1, b - 1) for a, b in quoted]
        if value[:1] in b"\"'`":
            own += [_unquoted(raw[a:b], a) for a, b in quoted]
            refs += [bound[x[0]] for x in parts if x[0] in bound]
        elif m.re is PAIR and (call := ARGUMENTS.match(raw, m.end())):
            # What a call is given may be what it returns; a quoted argument that looks like the name of a setting does not count.
            for x in PART.finditer(raw, *call.span("value")):
                if x[0][:1] not in b"\"'`":
                    refs += [bound[x[0]]] if x[0] in bound else []
                elif not _CONSTANT.match(x[0][1:-1]):
                    own.append((x.start() + 1, x.end() - 1, False))
        elif value in bound:
            refs.append(bound[value])
        elif m.re in (SUBSCRIPT, SETTER, PUT):
            pass  # a name that nothing is known of
        else:
            refs += [bound[x] for x in value.split(b"+") if x in bound] if b"+" in value else []
            own += [] if refs else [_unquoted(value, at)]
        bound[m["name"]] = len(events)
        events.append((m["name"], own, refs))
    for a, b in inside:
        _bind(raw, PAIR.finditer(raw, a, b), events)


def literals(raw: bytes, least: float = 0.5) -> list[tuple[int, int]]:
    """Byte spans of the literals that reach a sensitive name, in order."""
    if not any(x in raw for x in (b"=", b":", b"--", b"</", b"(")):
        return []
    kinds = [FLAG, TAG, PAIR, *([SUBSCRIPT] if b"[" in raw else []), *([SETTER, PUT] if b"(" in raw else []), *([BLOCK] if b":" in raw and b"\n" in raw else [])]
    # Every assignment is an event; a name stands for the event that bound it last. Weights flow back from later events to those that they
    # refer to, in one pass.
    events: list[tuple[bytes, list[tuple[int, int, bool]], list[int]]] = []
    _bind(raw, sorted((m for p in kinds for m in p.finditer(raw)), key=lambda m: m.start("name")), events)
    weights = [sensitivity(name) for name, _, _ in events]
    reached: dict[tuple[int, int, bool], float] = {}
    for e in range(len(events) - 1, -1, -1):
        _, own, refs = events[e]
        for r in refs:
            weights[r] = max(weights[r], weights[e])
        for span in own if weights[e] else ():
            reached[span] = max(reached.get(span, 0.0), weights[e])
    for m in URL.finditer(raw) if b"://" in raw else ():
        reached[(*m.span("value"), True)] = 1.0
    return sorted({(a, b) for (a, b, q), weight in reached.items() if weight * plausibility(raw[a:b], q) >= least})


def base_spans(raw: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes, by start and then by kind."""
    low, found = raw.lower(), []
    if any(n in low for n in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(raw) if len(m[2]) >= 6]
    if b"AKIA" in raw:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(raw)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(raw)]
    return sorted(found)


def spans(raw: bytes) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and all spans, as (start, kind, end) in code points."""
    base = base_spans(raw)
    more = [(a, 3, b) for a, b in literals(raw) if not any(s <= a and b <= e for s, _, e in base)]
    every = sorted(base + more)
    if every and not raw.isascii():
        at, last, chars = {}, 0, 0
        for x in sorted({p for s, _, e in every for p in (s, e)}):
            chars += len(raw[last:x].decode("utf-8", "replace"))
            last, at[x] = x, chars
        base, every = ([(at[s], k, at[e]) for s, k, e in found] for found in (base, every))
    return base, every


def _told(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_lit``.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then in the order of ``KINDS``. A null text
    counts as empty and has none. Rows are judged one by one, so repeated rows give repeated results; other columns
    are ignored.
    """
    scratch.modest(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64())] + [(c, pa.int64()) for c in ("n_assign", "n_access", "n_hex")] + [("base_sha256", pa.string()), ("spans", pa.string()), ("n_lit", pa.int64())])

    def scan(batches):
        for b in batches:
            rows = []
            for text in b.column(1):
                base, every = spans(text.as_py() or b"")
                n = Counter(k for _, k, _ in every)
                rows.append((n[0], n[1], n[2], hashlib.sha256(_told(base).encode()).hexdigest(), _told(every), n[3]))
            cols = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t.type) for c, t in zip(cols, list(schema)[1:], strict=True))], schema=schema)

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return read.mapInArrow(releasing(scan), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_lit long")
