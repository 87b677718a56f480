"""Benchmark decontamination: a prefix-filtered set join with exact verification.

Each benchmark item becomes windows of ``window`` words (an item of fewer words is one window). Words' shingles are
ordered by how rare they are in all documents. A window must be contained whole, so the necessary prefix of its
shingles has length one: its rarest shingle. Documents are probed for those prefix shingles and joined to the windows by them; a hit at word p of a
shingle at place o of a window is kept only where the window fits (positional bound p - o >= 0, length bound
p - o + window <= words) and where the document's words there are those of the window.

Windows, their shingles, counts and prefixes are tables, of any number. What tasks get of them is a sieve of at most 2**``SIEVE_BITS`` bits, whatever the
benchmark's size, which only saves rows: what passes it is joined by the whole hash, so a sieve that is full costs time and changes nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.llm import scratch
from pagewright.llm.text import ALNUM, U, Words, releasing, texts, whole

SHINGLE = 5
SIEVE_BITS = 26
#: Distinct shingles that a task holds before it passes its counts on.
HELD = 1 << 20
SPANS = "array<struct<start:int,end:int>>"


def _windows(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """``item_id, words, k, shingles`` of every window: its words with single spaces, their number, and the hashes of its shingles in order."""

    def cut(batches):
        for b in batches:
            names = b.column(0).to_pylist()
            for part in texts(b.column(1), lower=True):
                words = part.words(ALNUM)
                of = words.hashes()
                places, full = words.runs(shingle, of)
                cols: list[list] = [[] for _ in range(4)]
                for i, (a, e) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
                    if a == e:
                        continue
                    own = [words.word(w) for w in range(a, e)]
                    k = min(window, len(own))
                    size = min(shingle, k)
                    hashes = full if size == shingle else whole(of[a:e])
                    at = int(np.searchsorted(places, a)) if size == shingle else 0
                    for s in range(len(own) - k + 1):
                        row = (names[part.first + i], b" ".join(own[s : s + k]).decode("utf-8", "replace"), k, hashes[at + s : at + s + k - size + 1].view(np.int64))
                        for c, v in zip(cols, row, strict=True):
                            c.append(v)
                types = (pa.string(), pa.string(), pa.int32(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["item_id", "words", "k", "shingles"])

    return items.mapInArrow(releasing(cut), "item_id string, words string, k int, shingles array<long>")


def _sieve(hashes: DataFrame, bits: int) -> np.ndarray:
    """A bit for the leading bits of each hash (column ``h``), as 64-bit words."""
    place = F.shiftrightunsigned("h", 64 - bits)
    rows = hashes.select(F.shiftright(place, 6).alias("i"), F.expr("shiftleft(1L, cast(shiftrightunsigned(h, %d) & 63 as int))" % (64 - bits)).alias("b"))
    table = rows.groupBy("i").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(max(1, (1 << bits) >> 6), U)
    out[table["i"].to_numpy()] = table["b"].to_numpy().view(U)
    return out


def _passing(words: Words, of: np.ndarray, lengths: list[int], sieve: np.ndarray, bits: int):
    """Place and hash of the shingles of these lengths that the sieve lets through."""
    for k in lengths:
        at, h = words.runs(k, of)
        place = h >> U(64 - bits)
        may = np.flatnonzero((sieve[place >> U(6)] >> (place & U(63))) & U(1))
        yield at[may], h[may]


def _counted(docs: DataFrame, sieve, lengths: list[int], bits: int) -> DataFrame:
    """``h, uses``: how often each shingle that the sieve lets through is in all documents."""

    def count(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def squeeze() -> None:
            keys, at = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
            held[:] = [(keys, np.bincount(at, np.concatenate([n for _, n in held])).astype(np.int64))]

        def told():
            for h, n in held:
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "uses"])
            held.clear()

        for b in batches:
            for part in texts(b.column(0), lower=True):
                words = part.words(ALNUM)
                found = [h for _, h in _passing(words, words.hashes(), lengths, sieve.value, bits)]
                held.append(np.unique(np.concatenate([*found, np.zeros(0, U)]), return_counts=True))
                squeeze()
                if len(held[0][0]) > HELD:
                    yield from told()
        yield from told()

    return docs.select("text").mapInArrow(releasing(count), "h long, uses long").groupBy("h").agg(F.sum("uses").alias("uses"))


def _probed(docs: DataFrame, sieve, lengths: list[int], bits: int, window: int) -> DataFrame:
    """``h1, h2, p, h, before, around``: where a shingle begins that the sieve lets through, and the words around it, of which ``before`` come before it."""

    def probe(batches):
        for b in batches:
            for part in texts(b.column(2), lower=True):
                words = part.words(ALNUM)
                cols: list[list] = [[] for _ in range(5)]
                for at, h in _passing(words, words.hashes(), lengths, sieve.value, bits):
                    doc = words.doc[at]
                    low, high = words.first[doc], words.first[doc + 1]
                    start, end = np.maximum(low, at - window + 1), np.minimum(high, at + window)
                    around = [b" ".join(words.word(w) for w in range(s, e)).decode("utf-8", "replace") for s, e in zip(start.tolist(), end.tolist(), strict=True)]
                    for c, v in zip(cols, (doc + part.first, at - low, h.view(np.int64), at - start, around), strict=True):
                        c.append(v)
                if cols[0]:
                    doc, p, h, before = (np.concatenate(c) for c in cols[:4])
                    around = pa.array([x for c in cols[4] for x in c], pa.string())
                    doc = pa.array(doc)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(doc), b.column(1).take(doc), pa.array(p, pa.int64()), pa.array(h), pa.array(before, pa.int64()), around], names=["h1", "h2", "p", "h", "before", "around"])

    return docs.select("h1", "h2", "text").mapInArrow(releasing(probe), "h1 long, h2 long, p long, h long, before long, around string")


def _summed(batches):
    """Of each text: the hit words, the maximal hit runs, its items in order, and their digest."""
    for b in batches:
        cols: list[list] = [[] for _ in range(4)]
        for found, items in zip(b.column("found").to_pylist(), b.column("items").to_pylist(), strict=True):
            runs = np.array([(x["s"], x["e"]) for x in found], np.int64)
            runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
            reach = np.maximum.accumulate(runs[:, 1])
            new = np.flatnonzero(np.concatenate([[True], runs[1:, 0] >= reach[:-1]]))
            # Runs that touch are one maximal run.
            start, end = runs[new, 0], reach[np.append(new[1:] - 1, len(runs) - 1)]
            cut = np.concatenate([[True], start[1:] > end[:-1]])
            start, end = start[cut], end[np.append(np.flatnonzero(cut)[1:] - 1, len(end) - 1)]
            items = sorted(items)
            row = (int((end - start).sum()), hashlib.sha256(",".join(items).encode()).hexdigest(), items, [{"start": s, "end": e} for s, e in zip(start.tolist(), end.tolist(), strict=True)])
            for c, v in zip(cols, row, strict=True):
                c.append(v)
        types = (pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
        arrays = [b.column("h1"), b.column("h2"), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))]
        yield pa.RecordBatch.from_arrays(arrays, names=["h1", "h2", "n_hit", "items_sha256", "item_ids", "spans"])


def _occurrences(docs: DataFrame, items: DataFrame, window: int, shingle: int, bits: int) -> DataFrame:
    """``h1, h2, n_hit, items_sha256, item_ids, spans`` of each distinct text in which a window occurs."""
    spark = docs.sparkSession
    windows = scratch.table(_windows(items, window, shingle), "windows")
    distinct = windows.dropDuplicates(["words"]).select("words", "k", "shingles")
    lengths = sorted(r[0] for r in windows.select(F.least("k", F.lit(shingle))).distinct().collect())
    wanted = windows.select(F.explode("shingles").alias("h"))
    counts = scratch.table(_counted(docs, scratch.broadcast(spark, _sieve(wanted, bits)), lengths, bits), "shingles")
    each = distinct.select("words", "k", F.posexplode("shingles").alias("o", "h")).join(counts, "h", "left")
    rarest = F.min(F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), "h", "o", "k")).alias("x")
    prefix = scratch.table(each.groupBy("words").agg(rarest).select("words", "x.h", "x.o", "x.k"), "prefixes")
    probed = scratch.table(_probed(docs, scratch.broadcast(spark, _sieve(prefix, bits)), lengths, bits, window), "probed")
    here = F.array_join(F.slice(F.split("around", " "), F.col("before") - F.col("o") + 1, F.col("k")), " ")
    fits = F.when(F.col("before") >= F.col("o"), here) == F.col("words")
    hits = scratch.table(probed.join(prefix, "h").where(fits).select("h1", "h2", (F.col("p") - F.col("o")).alias("s"), (F.col("p") - F.col("o") + F.col("k")).alias("e"), "words").distinct(), "hits")
    found = hits.select("h1", "h2", "s", "e").distinct().groupBy("h1", "h2").agg(F.collect_list(F.struct("s", "e")).alias("found"))
    owners = hits.select("h1", "h2", "words").distinct().join(windows.select("words", "item_id").distinct(), "words")
    named = owners.groupBy("h1", "h2").agg(F.collect_set("item_id").alias("items"))
    schema = f"h1 long, h2 long, n_hit long, items_sha256 string, item_ids array<string>, spans {SPANS}"
    return scratch.table(found.join(named, ["h1", "h2"]).mapInArrow(releasing(_summed), schema), "contamination")


def _counting(docs: DataFrame, carry: bool) -> DataFrame:
    """``doc_id, h1, h2, n_words`` of every row, and its ``row``, from which the text is taken then."""

    def count(batches):
        for b in batches:
            text = b.column(3).field("text") if carry else b.column(3)
            n = [part.words(ALNUM).counts for part in texts(text, lower=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(np.concatenate([*n, np.zeros(0, np.int64)])), *b.columns[3:][:carry]], names=["doc_id", "h1", "h2", "n_words", "row"][: 4 + carry])

    columns = [T.StructField(c, T.LongType()) for c in ("doc_id", "h1", "h2", "n_words")]
    return docs.mapInArrow(releasing(count), T.StructType(columns + ([docs.schema["row"]] if carry else [])))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 13, shingle: int = SHINGLE, carry: bool = False, sieve_bits: int = SIEVE_BITS) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, item_ids, spans``.

    ``docs`` has ``doc_id`` and ``text``, ``items`` has ``item_id`` and ``text``; other columns are ignored. A null or
    empty text has no words, is never hit and holds no item; an item without words, or without an id, is never found. Repeated rows, and rows of one id and different
    texts, are judged each on its own; rows of one ``item_id`` are one item. ``spans`` are the maximal hit runs of words, end exclusive. A document is contaminated
    when at least a twentieth of its words are hit. With ``carry`` the result also has ``row``, a struct of the document's columns. Without items or documents
    nothing is hit.
    """
    scratch.modest(docs.sparkSession)
    hashes: list[Column] = [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("decontamination"), "text").alias("h2")]
    row = [F.struct(*[docs[c] for c in docs.columns]).alias("row")] if carry else []
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), *row)
    keyed = docs.where("text is not null").select("text", *hashes)
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text").where("item_id is not null and text is not null")
    hit = _occurrences(keyed, items, window, shingle, sieve_bits)
    # Only a text's hashes and the number of its words go on, and its row where it is asked for.
    read = _counting(docs.select("doc_id", *hashes, "row" if carry else "text"), carry)
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return read.join(hit, ["h1", "h2"], "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.when(F.col("item_ids").isNull(), F.lit(0)).otherwise(F.size("item_ids")).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.coalesce("spans", F.array().cast(SPANS)).alias("spans"),
        *(["row"] if carry else []),
    )
