"""Periodic runs of words by a suffix automaton.

A run is a stretch of consecutive words with smallest period q that is at least ``max(LEAST, TIMES * q)`` words long and that no neighbouring word extends. The suffix automaton of a stretch of
words has a state for each class of factors that end at the same places. Its states are visited from the longest to the shortest, and the ordered set of a state's end positions is merged into that of
its suffix link, the smaller set into the larger. Two neighbours i < j in the merged set that the merge has brought together, and that are no further apart than the state's factors are long, seed a
square: the j - i words up to j repeat those up to i. Each square is extended as far as its period holds. A run of period q holds a square whose two halves meet as neighbours at their longest common suffix,
as its root is primitive, so no run is lost.

An automaton is built only where there can be a run at all, which costs no run: its words make up a stretch in which every five consecutive words occur again, in the same document, no further away than a
quarter of the stretch.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm import scratch
from pagewright.llm.substring import kept
from pagewright.llm.text import U, Words, mix, releasing, texts

TIMES, LEAST = 4, 6
#: Of a run's words, every so many consecutive ones occur again one period on.
GRAM = 5
#: Positions in one block of an ordered set.
BLOCK = 512
RUNS = "array<struct<start:int,length:int,period:int>>"
OUT = f"doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, runs {RUNS}"
_RUNS = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("period", pa.int32())]))
_ARROW = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_runs", "start", "length", "period", "exponent_milli")), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()), ("runs", _RUNS)])


class Ends:
    """An ordered set of positions, in blocks of bounded size."""

    __slots__ = ("blocks", "heads", "size")

    def __init__(self, first: int):
        self.blocks, self.heads, self.size = [[first]], [first], 1

    def put(self, x: int) -> tuple[int, int]:
        """Adds ``x``; the positions before and after it (-1: none)."""
        k = max(0, bisect_right(self.heads, x) - 1)
        block = self.blocks[k]
        at = bisect_left(block, x)
        before = block[at - 1] if at else -1
        after = block[at] if at < len(block) else self.heads[k + 1] if k + 1 < len(self.heads) else -1
        block.insert(at, x)
        self.size += 1
        if not at:
            self.heads[k] = x
        if len(block) > 2 * BLOCK:
            self.blocks[k : k + 1] = [block[:BLOCK], block[BLOCK:]]
            self.heads.insert(k + 1, block[BLOCK])
        return before, after


def automaton(word: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Length and suffix link of each state, and the state of each prefix."""
    length, link, to = [0], [-1], [{}]
    prefix, last = [], 0
    for i, c in enumerate(word):
        now = len(length)
        length.append(i + 1)
        to.append({})
        link.append(0)
        at = last
        while at >= 0 and c not in to[at]:
            to[at][c] = now
            at = link[at]
        if at >= 0:
            old = to[at][c]
            if length[old] > length[at] + 1:
                short = len(length)
                length.append(length[at] + 1)
                to.append(to[old].copy())
                link.append(link[old])
                link[old] = link[now] = short
                while at >= 0 and to[at].get(c) == old:
                    to[at][c] = short
                    at = link[at]
            else:
                link[now] = old
        prefix.append(now)
        last = now
    return length, link, prefix


def seeds(word: list[int]):
    """Pairs (j, d) such that the ``d`` words up to place ``j`` repeat those before them; of every run one at least."""
    length, link, prefix = automaton(word)
    sets: list[Ends | None] = [None] * len(length)
    for i, state in enumerate(prefix):
        sets[state] = Ends(i)
    for state in np.argsort(-np.array(length), kind="stable")[:-1].tolist():
        up, own = link[state], sets[state]
        sets[state] = None
        if not up or own is None:
            continue
        other = sets[up]
        if other is None:
            sets[up] = own
            continue
        small, large = (own, other) if own.size < other.size else (other, own)
        sets[up], most = large, length[up]
        for block in small.blocks:
            for x in block:
                before, after = large.put(x)
                if before >= 0 and x - before <= most:
                    yield x, x - before
                if 0 <= after <= x + most:
                    yield after, after - x


def _same(a: np.ndarray, d: int, at: int, step: int) -> int:
    """How many places from ``at`` on, in steps of 1 or -1, have the same word ``d`` places later."""
    n, size = 0, 16
    while True:
        if step > 0:
            here, there = a[at + n : at + n + size], a[at + n + d : at + n + d + size]
            here = here[: len(there)]
        else:
            low = max(0, at - n - size + 1)
            here, there = a[low : max(low, at - n + 1)][::-1], a[low + d : max(low, at - n + 1) + d][::-1]
        wrong = np.flatnonzero(here != there)
        if len(wrong):
            return n + int(wrong[0])
        n += len(here)
        if len(here) < size:
            return n
        size *= 4


def runs_of(word: list[int], times: int = TIMES, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of numbers, by start and period."""
    a = np.array(word, np.int64)
    known: dict[int, tuple[list[int], list[int]]] = {}
    found: dict[tuple[int, int], int] = {}
    for j, d in seeds(word):
        if times * d > len(word):
            continue
        starts, ends = known.setdefault(d, ([], []))
        k = bisect_right(starts, j - 2 * d + 1) - 1
        if k >= 0 and j <= ends[k]:
            continue
        start = j - 2 * d + 1 - _same(a, d, j - 2 * d, -1)
        end = j + _same(a, d, j - d + 1, 1)
        k = bisect_left(starts, start)
        starts.insert(k, start)
        ends.insert(k, end)
        if end - start + 1 >= max(least, times * d):
            # A multiple of a run's period holds as far as the period itself.
            place = (start, end - start + 1)
            found[place] = min(d, found.get(place, d))
    return sorted((start, size, d) for (start, size), d in found.items())


def stretches(words: Words, of: np.ndarray, times: int = TIMES) -> list[tuple[int, int]]:
    """From and to (places of words) of all stretches that can hold a run; ``of`` are the words' hashes. Runs have at least ``max(6, times * period)`` words."""
    at, h = words.runs(GRAM, of)
    if not len(at):
        return []
    doc = words.doc[at]
    key = mix(h ^ mix(doc.astype(U) + U(1)))
    order = np.argsort(key, kind="stable")
    gap = np.where(key[order][1:] == key[order][:-1], np.diff(at[order]), np.iinfo(np.int64).max)
    near = np.full(len(at), np.iinfo(np.int64).max)
    near[order[1:]] = gap
    near[order[:-1]] = np.minimum(near[order[:-1]], gap)
    live = np.flatnonzero(near < len(of))
    while len(live):
        new = np.concatenate([[True], (np.diff(at[live]) > 1) | (np.diff(doc[live]) > 0)])
        edge = np.flatnonzero(new)
        size = np.diff(np.append(edge, len(live))) + GRAM - 1
        stays = times * near[live] <= np.repeat(size, np.diff(np.append(edge, len(live))))
        if stays.all():
            start = at[live[edge]]
            return list(zip(start.tolist(), (start + size).tolist(), strict=True))
        live = live[stays]
    return []


def repeated_from(doc_id: int, n: int) -> tuple[int, int]:
    """From which word on, and with which period, the text of a document of this id is made to repeat itself; (n, 1) if it is left as it is."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return n, 1
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _rows(words: Words, ids: list, planted: bool, times: int, least: int):
    """The result's columns but for the id, for each text of a slice."""
    of, place = words.hashes(), None
    if planted:
        place = np.arange(len(words))
        changed = {}
        for i, (doc_id, first, n) in enumerate(zip(ids, words.first[:-1].tolist(), words.counts.tolist(), strict=True)):
            a, p = repeated_from(doc_id, n) if doc_id is not None else (n, 1)
            if a < n:
                place[first + a : first + n] = first + a + np.arange(n - a) % p
                changed[i] = True
        of = of[place]
    found: dict[int, list[tuple[int, int, int]]] = {}
    gone = np.zeros(len(words), bool)
    for start, end in stretches(words, of, times):
        numbers: dict[bytes, int] = {}
        own = [numbers.setdefault(words.word(w), len(numbers)) for w in (place[start:end].tolist() if planted else range(start, end))]
        doc = int(words.doc[start])
        for s, size, period in runs_of(own, times, least):
            found.setdefault(doc, []).append((start + s - int(words.first[doc]), size, period))
            gone[start + s + period : start + s + size] = True
    digests = kept(words, gone)[2]
    for i in changed if planted else ():
        stay = np.flatnonzero(~gone[words.first[i] : words.first[i + 1]]) + words.first[i]
        digests[i] = hashlib.sha256(b" ".join([words.word(w) for w in place[stay].tolist()])).hexdigest()
    for i, digest in enumerate(digests):
        runs = sorted(found.get(i, ()), key=lambda r: (r[0], r[2]))
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        told = hashlib.sha256("".join(f"{s},{size},{period}\n" for s, size, period in runs).encode()).hexdigest()
        yield (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, told, digest, [{"start": s, "length": size, "period": period} for s, size, period in runs])


def find_runs(docs: DataFrame, planted: bool = False, times: int = TIMES, least: int = LEAST) -> DataFrame:
    """One row per input row: ``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256, runs``.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. Words are what lies between ASCII white space, and two are the same if their bytes are. Of all runs (see the module) the one of the greatest length for its period is told,
    ties by start and period; four nulls where there is none, as in a null, empty or short text. ``runs`` has all of them by start and period, and ``runs_sha256`` is the digest of their list. ``collapsed_sha256`` is that
    of the words that stay, joined by single spaces, when of each run the first period stays only. With ``planted`` a tenth of the documents, chosen by their ids, are first made to repeat
    themselves from some word on; a document without an id is left as it is. Rows are judged one by one, so repeated ones have the same result. Nothing is shuffled; a task holds some 2 MB of text, or one longer text, and
    some 700 bytes for each word of one stretch that repeats itself.
    """
    if times < TIMES or least < LEAST:
        raise ValueError(f"runs of at least {LEAST} words and {TIMES} periods are found")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scratch.modest(docs.sparkSession)

    def find(batches):
        for b in batches:
            ids = b.column(0).to_pylist()
            for part in texts(b.column(1)):
                words = part.words()
                own = ids[part.first : part.first + len(words.counts)]
                cols = list(zip(*_rows(words, own, planted, times, least), strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([own, *cols], _ARROW, strict=True)], schema=_ARROW)

    return docs.mapInArrow(releasing(find), OUT)
