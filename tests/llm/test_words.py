"""Kernels: words, hashes and slices against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from pagewright.llm.text import ALNUM, SPACED, texts, whole

TEXTS = st.lists(st.one_of(st.none(), st.text("aB 1.\n\té,'", max_size=30)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 12))
def test_words_match_regular_expressions(rows, most):
    for table, pattern, lower in ((SPACED, rb"[^\x20\x09-\x0D]+", False), (ALNUM, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True)):
        got = []
        for part in texts(pa.array(rows, pa.string()), lower=lower, most=most):
            w = part.words(table)
            got += [[w.word(i) for i in range(a, b)] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        low = [(t or "").encode() for t in rows]
        assert got == [re.findall(pattern, t.lower() if lower else t) for t in low]


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(1, 4))
def test_equal_runs_have_equal_hashes(rows, k):
    seen: dict[tuple, int] = {}
    for part in texts(pa.array(rows, pa.string()), most=40):
        w = part.words()
        of = w.hashes()
        at, h = w.runs(k, of)
        for p, x in zip(at, h, strict=True):
            run = tuple(w.word(i) for i in range(p, p + k))
            assert seen.setdefault(run, int(x)) == int(x) == int(whole(of[p : p + k])[0])
    assert len(set(seen.values())) == len(seen)


def test_no_collisions_among_many_words():
    words = [f"w{i}" for i in range(200_000)]
    h = next(texts(pa.array([" ".join(words)]))).words().hashes()
    assert len(np.unique(h)) == len(words)
