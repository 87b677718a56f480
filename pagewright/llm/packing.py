"""Best-fit packing of tokenised documents into sequences, by hierarchical residual packing.

Every task packs its own pieces by best fit, longest first, at most ``LOCAL`` at a time. Bins that are nearly full are emitted. The others become items of a node that
takes those of ``FANOUT`` such leaves, packs them by best fit again, emits what is nearly full now, and so on up to one root.

Bins of one fill are alike, so a node needs only to know how many bins of each fill it gets: at most ``capacity`` numbers a child, however many bins there are. It packs
runs of equal bins at once and tells which ranks of which fill go where; the pieces follow by a join. So every bin is handed on until it is nearly full or the root is
done, and no node grows with the input.

Tokens: every distinct run of characters that the tokenizer certainly treats on its own is encoded once for each worker and looked up after that.
"""

from __future__ import annotations

import itertools
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagewright.llm import scratch
from pagewright.llm.text import SPACED, Texts, U, Words, held, releasing, same_bytes, texts

CAPACITY = 2048
SLACK = 16
FANOUT = 8
LOCAL = 1 << 17
END = 0
CACHED_UNITS = 800_000
LEARNED = 4096
#: Bytes of text that are encoded at once, which bounds the arrays that place and compare their units.
SLICE = 1 << 21

_code = np.arange(256)
#: 1 letter, 2 digit, 3 visible ASCII sign other than an apostrophe, 0 whatever must not be cut off from its neighbours.
KIND = np.zeros(256, np.uint8)
KIND[(_code >= 33) & (_code <= 126) & (_code != 39)] = 3
KIND[((_code >= 97) & (_code <= 122)) | ((_code >= 65) & (_code <= 90))] = 1
KIND[(_code >= 48) & (_code <= 57)] = 2


class Units(Words):
    """Runs of characters that a tokenizer for words encodes independently of what surrounds them."""

    def __init__(self, part: Texts):
        super().__init__(part, SPACED)
        kind = KIND[part.buf]
        cut = (kind[1:] > 0) & (kind[:-1] > 0) & ((kind[1:] != kind[:-1]) | (kind[1:] == 2))
        seam = np.zeros(len(part.buf) + 1, bool)
        seam[part.offs] = True
        cut &= ~seam[1:-1]
        inner = np.flatnonzero(cut) + 1
        self.starts, self.ends = np.sort(np.concatenate([self.starts, inner])), np.sort(np.concatenate([self.ends, inner]))
        self.first = np.searchsorted(self.starts, part.offs)


class Encoder:
    """Token ids of whole texts with a tokenizer file that drops white space, lower-cases and splits letters, digits and signs."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks = re.compile(b"|".join(map(re.escape, self.special))) if self.special else None
        self._reset()

    def _reset(self) -> None:
        self.keys, self.at = np.zeros(0, U), np.zeros(0, np.int64)
        self.start, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.raw, self.begin = np.zeros(0, np.uint8), np.zeros(0, np.int64)

    def plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn(self, units: Units, keys: np.ndarray, first: np.ndarray) -> None:
        raw = units.texts.buf.tobytes()
        words = [raw[a:b] for a, b in zip(units.starts[first].tolist(), units.ends[first].tolist(), strict=True)]
        sizes, flat = [], [self.flat]
        for i in range(0, len(words), LEARNED):
            ids = [x.ids for x in self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words[i : i + LEARNED]], add_special_tokens=False)]
            sizes += map(len, ids)
            flat.append(np.fromiter(itertools.chain.from_iterable(ids), np.uint32))
        size = np.array(sizes, np.int64)
        begin = units.ends[first] - units.starts[first]
        self.at = np.concatenate([self.at, len(self.start) + np.arange(len(keys))])
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
        self.begin = np.concatenate([self.begin, len(self.raw) + np.cumsum(begin) - begin])
        self.flat = np.concatenate(flat)
        self.raw = np.concatenate([self.raw, np.frombuffer(b"".join(words), np.uint8)])
        self.size = np.concatenate([self.size, size])
        self.keys = np.concatenate([self.keys, keys])
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.at = self.keys[order], self.at[order]

    def _one_by_one(self, part: Texts) -> tuple[np.ndarray, np.ndarray]:
        each = [np.append(self.plain(part.bytes_of(i).decode("utf-8", "replace")), END).astype(np.uint32) for i in range(len(part.offs) - 1)]
        return np.concatenate(each), np.concatenate([[0], np.cumsum([len(x) for x in each])])

    def encode(self, part: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids, with ``END`` after each text, and where each text's begin; the last entry is the end.

        Units are looked up by hash and compared byte by byte with what the cache holds; where two differ, the texts are encoded one by one.
        """
        if self.marks and self.marks.search(part.buf.tobytes().lower()):
            return self._one_by_one(part)
        units = Units(part)
        keys, first, back = np.unique(units.hashes(), return_index=True, return_inverse=True)
        if len(self.keys) > CACHED_UNITS:
            self._reset()
        j = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        new = self.keys[j] != keys if len(self.keys) else np.ones(len(keys), bool)
        if new.any():
            self._learn(units, keys[new], first[new])
            j = np.searchsorted(self.keys, keys)
        at = self.at[j][back] if len(keys) else np.zeros(0, np.int64)
        if not same_bytes(part.buf, units.starts, self.raw, self.begin[at], units.ends - units.starts):
            return self._one_by_one(part)
        size = self.size[at]
        total = np.concatenate([[0], np.cumsum(size)])
        out = np.full(total[-1] + len(part.offs) - 1, END, np.uint32)
        doc = np.repeat(np.arange(len(part.offs) - 1), np.diff(units.first))
        put = np.arange(total[-1]) + np.repeat(doc, size)
        out[put] = self.flat[np.arange(total[-1]) + np.repeat(self.start[at] - total[:-1], size)]
        return out, total[units.first] + np.arange(len(part.offs))


_PIECE = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``. ``tokenizer`` is the file's content."""
    scratch.modest(docs.sparkSession)
    spec = scratch.broadcast(docs.sparkSession, tokenizer)
    schema = pa.schema(_PIECE + [("ids", pa.list_(pa.int32()))] * with_ids)

    name = f"encoder {zlib.crc32(tokenizer.encode())}"

    def cut(batches):
        encoder = held(name, lambda: Encoder(spec.value))
        for b in batches:
            names = b.column(0).to_pylist()
            for part in texts(b.column(1), most=SLICE):
                ids, offs = encoder.encode(part)
                ids = ids.astype("<u4")
                rows = []
                for i, (a, e) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)):
                    for k, s in enumerate(range(a, e, capacity)):
                        own = ids[s : min(s + capacity, e)]
                        rows.append((names[part.first + i], k, s - a, len(own), zlib.crc32(own.tobytes()), *([own.tolist()] * with_ids)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(releasing(cut, keeps=name), "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """The bin and the offset of each item, taken in the order given, and the fill of each bin.

    An item goes to the fullest bin that still has room for it; bins by their room, and a bit set of the rooms there are.
    """
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins, offsets, fill = 0, [], [], []
    for n in sizes:
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            b = len(fill)
            fill.append(0)
            room = capacity
        bins.append(b)
        offsets.append(fill[b])
        fill[b] += n
        if room > n:
            by_room[room - n].append(b)
            rooms |= 1 << (room - n)
    return bins, offsets, fill


def best_fit_counts(counts: list[tuple[int, int]], capacity: int) -> list[tuple[int, int, list[tuple[int, int, int, int]]]]:
    """Best fit of many equal items at once: ``counts`` are (size, how many). Gives runs of equal bins: how many, their fill, and their parts.

    A part (size, rank, m, offset) says that the run's first bin has the items of that size from this rank on, ``m`` of them from this offset on, the next bin the ``m``
    items after these, and so on. Every item goes to the fullest bin that still has room for it, longest items first.
    """
    by_room: list[list[tuple[int, int, list]]] = [[] for _ in range(capacity + 1)]
    rooms, full = 0, []
    for size, left in sorted(counts, reverse=True):
        rank = 0
        while left:
            fits = rooms >> size
            room = size + (fits & -fits).bit_length() - 1 if fits else capacity
            n, fill, parts = by_room[room].pop() if fits else (left, 0, [])
            if fits and not by_room[room]:
                rooms ^= 1 << room
            m = min(left, room // size)
            used = min(n, left // m)
            if fits and used < n:
                by_room[room].append((n - used, fill, [(s, r + used * k, k, o) for s, r, k, o in parts]))
                rooms |= 1 << room
            run = (used, fill + m * size, [*parts, (size, rank, m, fill)])
            rank, left, room = rank + used * m, left - used * m, room - m * size
            if room:
                by_room[room].append(run)
                rooms |= 1 << room
            else:
                full.append(run)
    return full + [run for runs in by_room for run in runs]


_OF_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, "
_PACKED = _OF_PIECE + "node long, fill long, rank long, offset long, done boolean"
_STATE = [("node", pa.int64()), ("fill", pa.int64()), ("rank", pa.int64()), ("offset", pa.int64()), ("done", pa.bool_())]
_MOVES = "parent long, fill long, a long, b long, m long, at long, new_fill long, new_rank long, done boolean"


def _named(level: int, node: int, bins):
    """Numbers of emitted bins tell level, node and place, so they are unique."""
    return (level << 58) | (node << 28) | bins


def _leaf(table: pa.Table, node: int, capacity: int, slack: int) -> pa.Table:
    """Packs pieces by best fit. A bin that stays open is known by its node, fill and rank among those of this fill."""
    size = table.column("length").to_numpy()
    order = np.argsort(-size, kind="stable")
    of, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
    of[order], offset[order], fill = best_fit(size[order].tolist(), capacity)
    fill = np.array(fill, np.int64)
    done = fill >= capacity - slack
    by_fill = np.argsort(fill, kind="stable")
    rank = np.zeros(len(fill), np.int64)
    rank[by_fill] = np.arange(len(fill)) - np.searchsorted(fill[by_fill], fill[by_fill])
    rank = np.where(done, _named(0, node, np.arange(len(fill))), rank)
    state = [np.full(len(size), node), fill[of], rank[of], offset, done[of]]
    return pa.Table.from_arrays([*(table.column(c).combine_chunks() for c, _ in _PIECE), *map(pa.array, state)], schema=pa.schema(_PIECE + _STATE))


def _merging(level: int, capacity: int, slack: int, last: bool):
    """What a node does with the bins of its children: runs of ranks of one fill, and the fill and ranks of the bins that they go to."""

    def merge(key, table):
        parent = key[0].as_py()
        runs = best_fit_counts(list(zip(table.column("fill").to_pylist(), table.column("n").to_pylist(), strict=True)), capacity)
        ranks: dict[int, int] = {}
        rows, emitted = [], 0
        for n, fill, parts in runs:
            done = last or fill >= capacity - slack
            rank = _named(level, parent, emitted) if done else ranks.get(fill, 0)
            if done:
                emitted += n
            else:
                ranks[fill] = rank + n
            rows += [(parent, size, at, at + n * m, m, offset, fill, rank, done) for size, at, m, offset in parts]
        cols = list(zip(*rows, strict=True))
        names = [c.split()[0] for c in _MOVES.split(", ")]
        return pa.table({c: pa.array(v, pa.bool_() if c == "done" else pa.int64()) for c, v in zip(names, cols, strict=True)})

    return merge


def pack(items: DataFrame, capacity: int = CAPACITY, slack: int = SLACK, fanout: int = FANOUT, local: int = LOCAL) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces of at most ``capacity`` tokens (``doc_id, piece, start, length, ids_crc32``).

    A sequence's pieces lie one after the other from 0. Repeated rows are packed each on its own; a null id is packed as any other; no rows give none.
    """
    partitions = max(1, items.rdd.getNumPartitions())

    def leaves(batches):
        from pyspark import TaskContext

        held, rows, node = [], 0, TaskContext.get().partitionId()
        for b in batches:
            for i in range(0, b.num_rows, local):
                part = b.slice(i, local)
                if held and rows + part.num_rows > local:
                    yield from _leaf(pa.concat_tables(held).combine_chunks(), node, capacity, slack).to_batches()
                    held, rows, node = [], 0, node + partitions
                held.append(pa.Table.from_batches([part]))
                rows += part.num_rows
        if held:
            yield from _leaf(pa.concat_tables(held).combine_chunks(), node, capacity, slack).to_batches()

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    packed = scratch.table(items.select(*columns).mapInArrow(releasing(leaves), _PACKED), "packed-0")
    done, left = packed.where("done"), packed.where("not done")
    counts = left.groupBy("node", "fill").agg((F.max("rank") + 1).alias("n"))
    nodes, level = (packed.agg(F.max("node")).first()[0] or 0) + 1, 0
    while True:
        level, last = level + 1, nodes <= fanout
        counts = counts.withColumn("parent", F.floor(F.col("node") / fanout))
        before = Window.partitionBy("parent", "fill").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
        counts = scratch.table(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), f"fills-{level}")
        sums = counts.groupBy("parent", "fill").agg(F.sum("n").alias("n"))
        moves = scratch.table(sums.groupBy("parent").applyInArrow(_merging(level, capacity, slack, last), _MOVES), f"moves-{level}")
        placed = left.join(counts.select("node", "fill", "before", "parent"), ["node", "fill"]).withColumn("rank", F.col("rank") + F.col("before"))
        moved = placed.join(moves.withColumnsRenamed({"done": "ready"}), ["parent", "fill"]).where("rank >= a and rank < b").withColumn("k", F.col("rank") - F.col("a"))
        moved = moved.select(
            *columns, F.col("parent").alias("node"), F.col("new_fill").alias("fill"), (F.col("new_rank") + F.floor(F.col("k") / F.col("m"))).alias("rank"),
            (F.col("offset") + F.col("at") + F.col("k") % F.col("m") * F.col("fill")).alias("offset"), F.col("ready").alias("done"),
        )
        packed = scratch.table(moved, f"packed-{level}")
        done, left = done.unionByName(packed.where("done")), packed.where("not done")
        if last:
            break
        counts = left.groupBy("node", "fill").agg((F.max("rank") + 1).alias("n"))
        nodes = -(-nodes // fanout)
    return done.select(*columns, F.col("rank").alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenises ``docs`` (``doc_id, text``; other columns are ignored) and packs them: one row per piece.

    A null or empty text is the end token alone. Only a document longer than ``capacity`` is cut, into pieces of that
    length of which the last may be shorter.
    """
    return pack(scratch.table(pieces(docs, tokenizer, capacity), "pieces"), capacity)
