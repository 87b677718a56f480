"""Substring deduplication by fixed-block anchors.

Blocks of half a window (ten words) that start at every tenth word of a document are the reference index; every run of ten words is a
probe. A hit is extended to the left and to the right, word by word, as long as the runs of ten words keep occurring elsewhere. A stretch that comes out shorter than a window is
dropped. A window of twenty words that also occurs elsewhere holds one of its document's blocks whole, and each of its runs of ten occurs elsewhere too,
so the stretches hold all that can repeat. Their windows are then compared as a whole: equal ones (96-bit digests of the words) meet in their bucket, which keeps the
first occurrence, by document and place; every other occurrence is removed. Neighbouring windows make up the maximal repeats, which are the result's ``removed`` runs.

Both exchanges are packed (see ``exchange``): a chunk of documents asks about its distinct runs and gets bits back.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm import exchange as X
from pagewright.llm import scratch
from pagewright.llm.text import U, Texts, Words, texts

WINDOW = 20
OUT = "doc_id long, more long, n_words long, n_removed long, kept_sha256 string, removed array<struct<start:int,end:int>>"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("more", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("removed", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
)
PROBE, WHOLE = 1, 2


class Chunk:
    """The words of a chunk's documents, slice by slice, with hashes of blocks and of windows."""

    def __init__(self, table: pa.Table, window: int):
        self.table, self.window, self.block = X.in_order(table), window, window // 2
        self.slices: list[Words] = [part.words() for part in texts(self.table.column("text"))]
        self.block_at, self.block_hash, self.aligned, self.at, self.hash, self.proof = ([] for _ in range(6))
        base = 0
        for words in self.slices:
            one, two = words.hashes(0), words.hashes(1)
            at, h = words.runs(self.block, one)
            self.block_at.append(at + base)
            self.block_hash.append(h)
            self.aligned.append((at - words.first[words.doc[at]]) % self.block == 0)
            at, h = words.runs(window, one)
            self.at.append(at + base)
            self.hash.append(h)
            self.proof.append(words.runs(window, two, 1)[1].astype(np.uint32))
            base += len(words)
        self.n = base
        self.block_at, self.block_hash, self.aligned, self.at, self.hash, self.proof = (
            np.concatenate([*x, np.zeros(0, t)]) for x, t in ((self.block_at, np.int64), (self.block_hash, U), (self.aligned, bool), (self.at, np.int64), (self.hash, U), (self.proof, np.uint32))
        )

    def probes(self, buckets: int) -> list[tuple[int, int, int, bytes]]:
        key, back, uses = np.unique(X.placed(self.block_hash, buckets), return_inverse=True, return_counts=True)
        index = np.zeros(len(key), bool)
        index[back[self.aligned]] = True
        prints = key.astype(np.uint32)
        chunk = self.table.column("chunk")[0].as_py()
        return [(k, chunk, PROBE, prints[a:b].tobytes() + X.bits(index[a:b]) + X.bits(uses[a:b] > 1)) for k, a, b in X.bucket_bounds(key >> U(32), buckets)]

    def stretches(self, again: np.ndarray, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last run (places of words) of every stretch of runs that all occur ``again``, one after the other in one document, with an anchor's ``hit`` among them."""
        good = np.flatnonzero(again)
        if not len(good):
            return good, good
        place = self.block_at[good]
        new = np.concatenate([[True], (np.diff(good) > 1) | (np.diff(place) > 1)])
        edge = np.flatnonzero(new)
        last = np.append(edge[1:], len(good)) - 1
        anchored = np.add.reduceat(hit[good].astype(np.int64), edge) > 0
        return place[edge][anchored], place[last][anchored]

    def candidates(self, answers: dict[int, bytes], buckets: int) -> np.ndarray:
        """Which of the windows lie in a stretch: indices into ``at``."""
        key, back = np.unique(X.placed(self.block_hash, buckets), return_inverse=True)
        again, hit = np.zeros(len(key), bool), np.zeros(len(key), bool)
        for k, a, b in X.bucket_bounds(key >> U(32), buckets):
            if k in answers:
                m = (b - a + 7) // 8
                again[a:b], hit[a:b] = X.unbits(answers[k][:m], b - a), X.unbits(answers[k][m:], b - a)
        first, last = self.stretches(again[back], hit[back])
        end = last + self.block - self.window + 1
        long = end > first
        step = np.zeros(self.n + 1, np.int32)
        np.add.at(step, first[long], 1)
        np.add.at(step, end[long], -1)
        return np.flatnonzero(step.cumsum()[self.at] > 0)

    def distinct(self, which: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The first of each distinct candidate window, in the order of bucket and digest; the bucket of each; and the number of each candidate's window."""
        h, proof = self.hash[which], self.proof[which]
        bucket = (h >> U(32)) % U(buckets)
        order = np.lexsort((np.arange(len(which)), proof, h, bucket))
        h, proof = h[order], proof[order]
        new = np.ones(len(order), bool)
        new[1:] = (h[1:] != h[:-1]) | (proof[1:] != proof[:-1])
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        return which[order[new]], bucket[order[new]], number

    def wholes(self, which: np.ndarray, buckets: int) -> list[tuple[int, int, int, bytes]]:
        first, bucket, _ = self.distinct(which, buckets)
        ids = self.table.column("doc_id").fill_null(np.iinfo(np.int64).max).to_numpy()
        doc = np.concatenate([np.repeat(np.arange(len(w.counts)) + w.texts.first, w.counts) for w in self.slices] + [np.zeros(0, np.int64)])
        owner = ids[doc[self.at[first]]] if len(first) else np.zeros(0, np.int64)
        chunk = self.table.column("chunk")[0].as_py()
        planes = lambda x: x.view(np.uint8).reshape(len(x), -1).T.tobytes()  # noqa: E731  bytes of one rank side by side compress better
        return [(k, chunk, WHOLE, self.hash[first[a:b]].tobytes() + self.proof[first[a:b]].tobytes() + planes(owner[a:b])) for k, a, b in X.bucket_bounds(bucket, buckets)]

    def removed(self, which: np.ndarray, answers: dict[int, bytes], buckets: int) -> np.ndarray:
        """Which words are removed."""
        first, bucket, number = self.distinct(which, buckets)
        here = np.zeros(len(first), bool)
        for k, a, b in X.bucket_bounds(bucket, buckets):
            if k in answers:
                here[a:b] = X.unbits(answers[k], b - a)
        stays = here[number] & (first[number] == which)
        step = np.zeros(self.n + 1, np.int64)
        at = self.at[which[~stays]]
        np.add.at(step, at, 1)
        np.add.at(step, at + self.window, -1)
        return step[:-1].cumsum() > 0

    def result(self, gone: np.ndarray) -> pa.Table:
        cols: list[list] = [[] for _ in range(4)]
        base = 0
        for words in self.slices:
            own = gone[base : base + len(words)]
            for c, v in zip(cols, kept(words, own), strict=True):
                c += v
            base += len(words)
        return pa.Table.from_arrays([*(self.table.column(c).combine_chunks() for c in ("doc_id", "more")), *(pa.array(c, f.type) for c, f in zip(cols, list(_ARROW)[2:], strict=True))], schema=_ARROW)


def kept(words: Words, gone: np.ndarray) -> tuple[list, list, list, list]:
    """For each text its words, how many are removed, the digest of the rest joined by single spaces, and the removed runs."""
    part: Texts = words.texts
    buf = part.buf.copy()
    step = np.zeros(len(buf) + 2, np.int32)
    stay = ~gone
    # A kept word stays with one space after it, if anything follows it in its text.
    ends = words.ends[stay]
    last = part.offs[1:][words.doc[stay]]
    after = ends < last
    buf[ends[after]] = 32
    np.add.at(step, words.starts[stay], 1)
    np.add.at(step, ends + after, -1)
    mask = step[: len(buf)].cumsum() > 0
    out, place = buf[mask], np.concatenate([[0], np.cumsum(mask)])[part.offs]
    total = np.concatenate([[0], np.cumsum(gone)])[words.first]
    n_removed = np.diff(total).tolist()
    digests, runs = [], []
    for i, (a, b) in enumerate(zip(place[:-1].tolist(), place[1:].tolist(), strict=True)):
        text = out[a:b].tobytes()
        digests.append(hashlib.sha256(text[:-1] if text[-1:] == b" " else text).hexdigest())
        if n_removed[i]:
            own = np.concatenate([[False], gone[words.first[i] : words.first[i + 1]], [False]]).astype(np.int8)
            edge = np.flatnonzero(np.diff(own)).tolist()
            runs.append([{"start": s, "end": e} for s, e in zip(edge[::2], edge[1::2], strict=True)])
        else:
            runs.append([])
    return words.counts.tolist(), n_removed, digests, runs


def _answer_probes(table: pa.Table) -> pa.Table:
    raw = table.column("payload").to_pylist()
    n = [_entries(len(x)) for x in raw]
    prints = np.concatenate([np.frombuffer(x, np.uint32, k) for x, k in zip(raw, n, strict=True)])
    flags = [np.frombuffer(x, np.uint8, offset=4 * k) for x, k in zip(raw, n, strict=True)]
    index = np.concatenate([X.unbits(f[: len(f) // 2].tobytes(), k) for f, k in zip(flags, n, strict=True)])
    multi = np.concatenate([X.unbits(f[len(f) // 2 :].tobytes(), k) for f, k in zip(flags, n, strict=True)])
    _, back, uses = np.unique(prints, return_inverse=True, return_counts=True)
    again, hit = uses > 1, np.zeros(len(uses), bool)
    again[back[multi]] = True
    hit[back[index]] = True
    again, hit = again[back], (again & hit)[back]
    cut = np.cumsum([0, *n])
    bucket, chunk = table.column("bucket").to_pylist(), table.column("chunk").to_pylist()
    return X.rows([(bucket[i], chunk[i], PROBE, X.bits(again[a:b]) + X.bits(hit[a:b])) for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if again[a:b].any()])


def _entries(size: int) -> int:
    """How many fingerprints of four bytes, with two bits each packed apart, take ``size`` bytes."""
    n = 4 * size // 17
    while 4 * n + 2 * ((n + 7) // 8) > size:
        n -= 1
    while 4 * (n + 1) + 2 * ((n + 8) // 8) <= size:
        n += 1
    return n


def _answer_wholes(table: pa.Table) -> pa.Table:
    raw = table.column("payload").to_pylist()
    chunk, bucket = np.array(table.column("chunk").to_pylist()), table.column("bucket").to_pylist()
    n = np.array([len(x) // 20 for x in raw])
    h = np.concatenate([np.frombuffer(x, U, k) for x, k in zip(raw, n, strict=True)])
    proof = np.concatenate([np.frombuffer(x, np.uint32, k, 8 * k) for x, k in zip(raw, n, strict=True)])
    owner = np.concatenate([np.ascontiguousarray(np.frombuffer(x, np.uint8, 8 * k, 12 * k).reshape(8, k).T).view(np.int64).ravel() for x, k in zip(raw, n, strict=True)])
    order = np.lexsort((np.repeat(chunk, n), owner, proof, h))
    first = np.zeros(len(order), bool)
    a, b = h[order], proof[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first[order[new]] = True
    cut = np.cumsum([0, *n])
    return X.rows([(bucket[i], int(chunk[i]), WHOLE, X.bits(first[s:e])) for i, (s, e) in enumerate(zip(cut[:-1], cut[1:], strict=True))])


def _answers(table: pa.Table, kind: int) -> dict[int, bytes]:
    own = zip(table.column("bucket").to_pylist(), table.column("kind").to_pylist(), table.column("payload").to_pylist(), strict=True)
    return {k: x for k, t, x in own if t == kind}


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept_sha256, removed``.

    Words are what lies between ASCII white space. A word is removed where a window of ``window`` words that covers it also
    starts earlier: in a document of smaller id, or earlier in its own. ``removed`` are the removed runs of words, end exclusive. A null
    text has no words; a document of fewer than ``window`` words keeps them all. A null id comes after all others; of
    rows with one id and one text the others repeat the first. Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scratch.modest(docs.sparkSession)
    chunks, buckets = X.sized(docs)
    dealt = X.chunked(X.singled(docs), chunks)

    @X.releasing
    def ask(table):
        return X.rows(Chunk(table, window).probes(buckets))

    @X.releasing
    def ask_whole(key, table, answers):
        if not table.num_rows:
            return X.rows([])
        chunk = Chunk(table, window)
        return X.rows(chunk.wholes(chunk.candidates(_answers(answers, PROBE), buckets), buckets))

    @X.releasing
    def finish(key, table, answers):
        if not table.num_rows:
            return _ARROW.empty_table()
        chunk = Chunk(table, window)
        which = chunk.candidates(_answers(answers, PROBE), buckets)
        return chunk.result(chunk.removed(which, _answers(answers, WHOLE), buckets))

    probes = dealt.groupBy("chunk").applyInArrow(ask, X.ROWS).groupBy("bucket").applyInArrow(_answer_probes, X.ROWS)
    wholes = dealt.groupBy("chunk").cogroup(probes.groupBy("chunk")).applyInArrow(ask_whole, X.ROWS).groupBy("bucket").applyInArrow(_answer_wholes, X.ROWS)
    found = X.again(dealt.groupBy("chunk").cogroup(probes.unionByName(wholes).groupBy("chunk")).applyInArrow(finish, OUT))
    # A repeated row starts nothing earlier than its first one, so all its words go where it has a window at all.
    empty = (F.col("copy") > 0) & (F.col("n_words") >= window)
    every = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    return found.select(
        "doc_id", "n_words", F.when(empty, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(empty, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"), F.when(empty, every).otherwise(F.col("removed")).alias("removed"),
    )
