"""JSON from untrusted answers: nothing is repaired, and no nesting, however deep, ends a job."""

from __future__ import annotations

import json
import re
from typing import Any

#: Brackets that a value may have open at once.
DEPTH = 128
_MARK = re.compile(r'\\.|["{}\[\]]', re.S)


class NotJson(ValueError):
    """``kind`` is ``empty``, ``too deep``, ``truncated`` or ``malformed``."""

    def __init__(self, kind: str):
        super().__init__(f"{kind} JSON")
        self.kind = kind


def nesting(text: str) -> tuple[int, bool]:
    """How many brackets are open at most, and whether one or a string is still open at the end. One pass, with a count in place of a stack."""
    depth = most = 0
    inside = False
    for m in _MARK.finditer(text):
        c = m[0]
        if c == '"':
            inside = not inside
        elif not inside and c in "{[":
            depth += 1
            most = max(most, depth)
        elif not inside and c in "}]":
            depth -= 1
    return most, inside or depth > 0


def structure(text: str) -> str:
    """What is wrong with a text that is no JSON."""
    if not text.strip():
        return "empty"
    most, still_open = nesting(text)
    return "too deep" if most > DEPTH else "truncated" if still_open else "malformed"


def loads(text: str) -> Any:
    """The value of a whole text."""
    # As few brackets as that are not nested deeper; what is no text is refused by the search.
    few = isinstance(text, str) and text.count("{") + text.count("[") <= DEPTH
    if not few and nesting(text)[0] > DEPTH:
        raise NotJson("too deep")
    try:
        return json.loads(text)
    except ValueError:
        raise NotJson(structure(text)) from None


def within(text: str) -> Any:
    """The value of a text that is JSON, or that has one value alone within prose."""
    try:
        return loads(text)
    except NotJson as e:
        kind = e.kind
    start = re.search(r"[{\[]", text)
    if start is None:
        raise NotJson(kind)
    rest = text[start.start() :]
    if nesting(rest)[0] > DEPTH:
        raise NotJson("too deep")
    try:
        value, end = json.JSONDecoder().raw_decode(rest)
    except ValueError:
        raise NotJson(structure(rest)) from None
    if re.search(r"[{\[]", rest[end:]):
        raise NotJson(structure(text))
    return value
