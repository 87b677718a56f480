"""Vectorised kernels over Arrow string columns: bytes, words, and hashes of words and of word sequences.

All of them work on slices of a column, so memory is bounded by ``SLICE`` bytes of text plus the longest text.
"""

from __future__ import annotations

import ctypes
import functools
import gc
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 2 << 20
U = np.uint64

_every = np.arange(256)
LOWER = np.where((_every >= 65) & (_every <= 90), _every + 32, _every).astype(np.uint8)
#: Words that ASCII white space ends.
SPACED = ~((_every == 32) | ((_every >= 9) & (_every <= 13)))
#: Words of digits, letters and whatever lies beyond ASCII.
ALNUM = (_every >= 128) | ((_every >= 48) & (_every <= 57)) | ((_every >= 97) & (_every <= 122))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (splitmix64's last steps)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: Odd multipliers and starting values of two independent families of hashes.
_MULT = [(U(0x9E3779B97F4A7C15), U(0xD1342543DE82EF95)), (U(0x2545F4914F6CDD1D), U(0x5851F42D4C957F2D))]
_START = [U(0x369DEA0F31A53F85), U(0x8CB92BA72F3D8DD7)]
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], U)
#: Words of more bytes are hashed one by one.
LONG = 64


def _eight(packed: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, from bytes held as 64-bit words."""
    i, s = at >> 3, ((at & 7) << 3).astype(U)
    return packed[i] >> s | packed[i + 1] << U(1) << (U(63) - s)


def _paired(a: np.ndarray, b: np.ndarray, side: int) -> np.ndarray:
    """The hash of two things one after the other from theirs. It is not linear, so no pattern of repeated letters or words makes two runs alike."""
    x, y = _MULT[side]
    return mix(a * x + b * y + _START[side])


def _of_runs(of: np.ndarray, k: int, side: int) -> np.ndarray:
    """The hash of every run of ``k`` of the words whose hashes are given: runs of powers of two are doubled, and those that make up ``k`` are paired."""
    n, at, size, power, out = len(of) - k + 1, k, 1, of, None
    while size <= k:
        if k & size:
            at -= size
            piece = power[at : at + n]
            out = piece if out is None else _paired(piece, out, side)
        if 2 * size <= k:
            power = _paired(power[:-size], power[size:], side)
        size *= 2
    return mix(out ^ U(k))


@dataclass
class Texts:
    """Some texts: their UTF-8 bytes, and where each begins; the last offset is the end."""

    first: int
    buf: np.ndarray
    offs: np.ndarray

    def words(self, table: np.ndarray = SPACED) -> Words:
        return Words(self, table)

    def bytes_of(self, i: int) -> bytes:
        return self.buf[self.offs[i] : self.offs[i + 1]].tobytes()


class Words:
    """Places of the words, each of which lies in one text, and hashes of them."""

    def __init__(self, texts: Texts, table: np.ndarray):
        self.texts, buf, offs = texts, texts.buf, texts.offs
        inside = table[buf]
        begin, end = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        seams = offs[:-1][offs[:-1] < len(buf)]
        begin[seams] = inside[seams]
        seams = offs[1:][offs[1:] > 0] - 1
        end[seams] = inside[seams]
        self.starts, self.ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
        #: The first word of each text; the last entry is the number of words.
        self.first = np.searchsorted(self.starts, offs)

    def __len__(self) -> int:
        return len(self.starts)

    @cached_property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @cached_property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, side: int = 0) -> np.ndarray:
        """A 64-bit hash of each word: its length and its bytes, eight at a time, are folded in one after the other."""
        buf, n = self.texts.buf, self.ends - self.starts
        packed = np.zeros(len(buf) // 8 + 3, U)
        packed.view(np.uint8)[: len(buf)] = buf
        h = mix(n.astype(U) * _MULT[side][0] + _START[side])
        h = mix(h ^ (_eight(packed, self.starts) & _KEEP[np.minimum(n, 8)]))
        live = np.flatnonzero((n > 8) & (n <= LONG))
        done = 8
        while len(live):
            block = _eight(packed, self.starts[live] + done) & _KEEP[np.minimum(n[live] - done, 8)]
            h[live] = mix(h[live] * _MULT[side][1] ^ block)
            done += 8
            live = live[n[live] > done]
        for i in np.flatnonzero(n > LONG).tolist():
            h[i] = int.from_bytes(hashlib.blake2b(self.word(i), digest_size=8, salt=bytes([side])).digest(), "little")
        return h

    def runs(self, k: int, of: np.ndarray, side: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Where each run of ``k`` words of one text begins, and its hash from the words' hashes ``of``."""
        n = len(of)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, U)
        at = np.flatnonzero(self.doc[: n - k + 1] == self.doc[k - 1 :])
        return at, _of_runs(of, k, side)[at]

    def word(self, i: int) -> bytes:
        return self.texts.buf[self.starts[i] : self.ends[i]].tobytes()


def whole(of: np.ndarray, side: int = 0) -> np.ndarray:
    """The hash of the run of all the words whose hashes are given, as ``Words.runs`` has it."""
    return _of_runs(of, len(of), side)


def same_bytes(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray, size: np.ndarray) -> bool:
    """Whether the ranges of ``a`` that begin at ``at`` hold the same bytes as those of ``b`` that begin at ``bt``."""
    before = np.cumsum(size) - size
    place = np.arange(int(size.sum()))
    return bool(np.array_equal(a[place + np.repeat(at - before, size)], b[place + np.repeat(bt - before, size)]))


def texts(column: pa.Array | pa.ChunkedArray, lower: bool = False, most: int = SLICE) -> Iterator[Texts]:
    """The column in slices of about ``most`` bytes; null counts as empty. A longer text is a slice of its own."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, "right")) - 1)
        buf = data[offs[i] : offs[j]]
        yield Texts(i, LOWER[buf] if lower else buf, offs[i : j + 1] - offs[i])
        i = j


def release() -> None:
    """Hands memory that this process no longer uses back to the system; workers are reused by later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not every system has it
        pass


#: What a worker keeps from one partition to the next of the same operator, by name.
_HELD: dict[str, object] = {}


def held(name: str, make: Callable[[], object]) -> object:
    """What an earlier partition of the operator of this name made in this worker, or what ``make`` makes now."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = make()
    return _HELD[name]


def releasing(over_partition: Callable, keeps: str | None = None) -> Callable:
    """A function over a partition's batches that releases memory when the partition is done, and whatever other operators have left in the worker."""

    @functools.wraps(over_partition)
    def run(batches):
        for name in [n for n in _HELD if n != keeps]:
            del _HELD[name]
        try:
            yield from over_partition(batches)
        finally:
            release()

    return run
