"""N-gram Jaccard join by T-occurrence search.

1. Packed exchange (see ``exchange``): chunks of documents ask how many documents have each of their shingles. A document links
   only if at least three quarters of its shingles occur elsewhere; all others are done.
2. What remains is reduced to distinct sets. Sets that are likely to be near copies (one least hash of their shingles) meet in blocks first, so that a family of
   copies is one class before anything is compared pair by pair.
3. A set's shingles are ordered by how rare they are; sets that can reach the overlap share one of their rarest shingles, the prefix. Each prefix shingle whose
   sets are not all of one class yet is searched. Sets that such shingles join to few others are searched with them in one task. Where they join many, a shingle of
   few sets shares tasks of bounded size with others, and one of more sets is dealt into blocks by class and by step of size, of which only those meet that can hold a
   link between two classes.
4. Every task searches with DivideSkip: a set's short inverted lists are merged as sorted runs, what reaches the overlap less the number of long lists is
   looked up in those by binary search, one list after the other, and given up as soon as it can't reach the overlap. Sets of one class are not compared,
   so a family gives a tree, not all pairs.
5. Components of the links found are the result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm import exchange as X
from pagewright.llm import scratch
from pagewright.llm.components import components
from pagewright.llm.text import U, Words, mix, texts, whole

SHINGLE = 5
PERCENT = 75
BLOCK = 1024
#: What merging an entry of a list costs against looking one up, as DivideSkip weighs them.
MERGE_COST = 0.0085
#: How many long lists are looked up at once.
PROBED = 64
_SETS = "doc_id long, more long, n long, s1 long, s2 long, alone int, tokens binary"
_SETS_ARROW = pa.schema([("doc_id", pa.int64()), ("more", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("alone", pa.int32()), ("tokens", pa.binary())])


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """What a set of ``n`` must share with any set that it links to."""
    return -(-percent * n // 100)


def pair_overlap(n: int, m: int, percent: int = PERCENT) -> int:
    return -(-percent * (n + m) // (100 + percent))


def shingle_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The text and the hash of every distinct shingle of every text, by text and hash. Of fewer than ``k`` words all are one shingle."""
    of = words.hashes()
    at, h = words.runs(k, of)
    doc = words.doc[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < k))
    if len(short):
        doc = np.concatenate([doc, short])
        h = np.concatenate([h, *(whole(of[words.first[d] : words.first[d + 1]]) for d in short)])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[new], h[new]


class Chunk:
    def __init__(self, table: pa.Table, k: int):
        self.table = X.in_order(table)
        doc, h = [np.zeros(0, np.int64)], [np.zeros(0, U)]
        for part in texts(self.table.column("text"), lower=True):
            d, s = shingle_sets(part.words(), k)
            doc.append(d + part.first)
            h.append(s)
        self.doc, self.hash = np.concatenate(doc), np.concatenate(h)

    def ask(self, buckets: int) -> list[tuple[int, int, int, bytes]]:
        key, uses = np.unique(X.placed(self.hash, buckets), return_counts=True)
        prints, chunk = key.astype(np.uint32), self.table.column("chunk")[0].as_py()
        return [(k, chunk, b - a, prints[a:b].tobytes() + np.minimum(uses[a:b], 255).astype(np.uint8).tobytes()) for k, a, b in X.bucket_bounds(key >> U(32), buckets)]

    def sets(self, answers: pa.Table, buckets: int, percent: int) -> pa.Table:
        """Every document with its number of shingles; those that may link with their shingles too, the rarest first, and how many of them no other has."""
        key, back = np.unique(X.placed(self.hash, buckets), return_inverse=True)
        uses, told = np.ones(len(key), np.int64), dict(zip(answers.column("bucket").to_pylist(), answers.column("payload").to_pylist(), strict=True))
        for k, a, b in X.bucket_bounds(key >> U(32), buckets):
            if k in told:
                m = (b - a + 7) // 8
                own = np.ones(b - a, np.int64)
                own[X.unbits(told[k][:m], b - a)] = np.frombuffer(told[k], np.uint16, offset=m)
                uses[a:b] = own
        uses = uses[back]
        first = np.searchsorted(self.doc, np.arange(self.table.num_rows + 1))
        again = np.concatenate([[0], np.cumsum(uses > 1)])[first]
        out: list[list] = [[] for _ in range(5)]
        for n, a, b, shared in zip(np.diff(first).tolist(), first[:-1].tolist(), first[1:].tolist(), np.diff(again).tolist(), strict=True):
            found = (None, None, None, None)
            if n and shared >= least_overlap(n, percent):
                h = self.hash[a:b]
                name = np.frombuffer(hashlib.sha256(h.tobytes()).digest()[:16], np.int64).tolist()
                found = (*name, n - shared, h[np.lexsort((h, uses[a:b]))].tobytes())
            for c, v in zip(out, (n, *found), strict=True):
                c.append(v)
        return pa.Table.from_arrays([*(self.table.column(c).combine_chunks() for c in ("doc_id", "more")), *(pa.array(c, f.type) for c, f in zip(out, list(_SETS_ARROW)[2:], strict=True))], schema=_SETS_ARROW)


def _count(table: pa.Table) -> pa.Table:
    raw, n = table.column("payload").to_pylist(), table.column("kind").to_numpy()
    prints = np.concatenate([np.frombuffer(x, np.uint32, k) for x, k in zip(raw, n, strict=True)])
    own = np.concatenate([np.frombuffer(x, np.uint8, k, 4 * k) for x, k in zip(raw, n, strict=True)])
    _, back = np.unique(prints, return_inverse=True)
    uses = np.minimum(np.bincount(back, own), 65535).astype(np.uint16)[back]
    cut = np.cumsum([0, *n])
    bucket, chunk = table.column("bucket").to_pylist(), table.column("chunk").to_pylist()
    found = []
    for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
        many = uses[a:b] > 1
        if many.any():
            found.append((bucket[i], chunk[i], 0, X.bits(many) + uses[a:b][many].tobytes()))
    return X.rows(found)


class Index:
    """Inverted lists over some sets, each an array of distinct hashes; sets are known by their places."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets, self.size = sets, np.array([len(s) for s in sets])
        token = np.concatenate([*sets, np.zeros(0, U)])
        owner = np.repeat(np.arange(len(sets)), self.size)
        self.tokens, back = np.unique(token, return_inverse=True)
        order = np.argsort(back, kind="stable")
        self.lists, self.first = owner[order], np.concatenate([[0], np.cumsum(np.bincount(back, minlength=len(self.tokens)))])
        #: Every list's entries with the list's number before them: one sorted array to look up in.
        self.entries = back[order] * len(sets) + self.lists
        cut = np.cumsum(self.size)[:-1] if len(sets) else []
        self.ranks = np.split(back, cut) if len(sets) else []

    def search(self, x: int, wanted, percent: int = PERCENT) -> list[int]:
        """Places of sets that link with set ``x``, in order; ``wanted(places)`` tells which of them are of interest."""
        n, ranks = len(self.sets[x]), self.ranks[x]
        least = least_overlap(n, percent)
        length = self.first[ranks + 1] - self.first[ranks]
        order = np.argsort(length, kind="stable")
        ranks, length = ranks[order], length[order]
        long_lists = min(least - 1, int(least / (MERGE_COST * np.log2(int(length[-1]) + 1) + 1)))
        short, size, probed = ranks[: n - long_lists], length[: n - long_lists], ranks[n - long_lists :]
        # A stable sort of sorted runs merges them.
        merged = np.sort(self.lists[np.arange(int(size.sum())) + np.repeat(self.first[short] - np.cumsum(size) + size, size)], kind="stable")
        edge = np.flatnonzero(np.diff(merged, prepend=-1))
        found, count = merged[edge], np.diff(np.append(edge, len(merged)))
        m = self.size[found]
        need = -(-percent * (n + m) // (100 + percent))
        ok = (found != x) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (count + len(probed) >= need)
        found, count, need = found[ok], count[ok], need[ok]
        ok = wanted(found)
        found, count, need = found[ok], count[ok], need[ok]
        for k in range(0, len(probed), PROBED):
            if not len(found):
                break
            asked = probed[k : k + PROBED, None] * len(self.sets) + found
            at = np.minimum(np.searchsorted(self.entries, asked), len(self.entries) - 1)
            count = count + (self.entries[at] == asked).sum(0)
            may = count + max(0, len(probed) - k - PROBED) >= need
            found, count, need = found[may], count[may], need[may]
        return found[count >= need].tolist()


def links_within(sets: list[np.ndarray], label: np.ndarray | None = None, side: np.ndarray | None = None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that join all that links join, but for what ``label`` has joined already; with ``side``, only links between sets of different sides."""
    _, label = np.unique(np.arange(len(sets)) if label is None else label, return_inverse=True)
    index, found, left = Index(sets), [], int(label.max()) if len(sets) else 0
    for x in range(len(sets)):
        if not left:
            break
        for y in index.search(x, lambda y, x=x: (label[y] != label[x]) & (True if side is None else side[y] != side[x]), percent):
            a, b = label[x], label[y]
            if a != b:
                label[label == max(a, b)] = min(a, b)
                found.append((x, y))
                left -= 1
    return found


def _searching(percent: int):
    def search(table):
        table = table.sort_by([("doc_id", "ascending"), ("side", "ascending")])
        ids = table.column("doc_id").to_pylist()
        sets = [np.frombuffer(x, U) for x in table.column("tokens").to_pylist()]
        side = table.column("side").to_numpy()
        found = links_within(sets, table.column("label").to_numpy(), None if len(np.unique(side)) < 2 else side, percent)
        return pa.table({"u": pa.array([ids[x] for x, _ in found], pa.int64()), "v": pa.array([ids[y] for _, y in found], pa.int64())})

    return search


def _prefixes(percent: int):
    """``token, id, n``: the prefix shingles of each set that another document has too, and its size."""

    def prefix(batches):
        for b in batches:
            sets = [np.frombuffer(x, np.int64) for x in b.column(1).to_pylist()]
            n = np.array([len(x) for x in sets], np.int64)
            alone = b.column(2).to_numpy()
            own = n - np.array([least_overlap(k, percent) for k in n.tolist()], np.int64) + 1
            token = np.concatenate([*(x[a:k] for x, a, k in zip(sets, alone.tolist(), own.tolist(), strict=True)), np.zeros(0, np.int64)])
            own = np.maximum(own - alone, 0)
            yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(np.repeat(b.column(0).to_numpy(), own)), pa.array(np.repeat(n, own))], names=["token", "id", "n"])

    return prefix


def _least(turn: int):
    """``id, least``: the least of a set's shingles in an order of the turn's own."""

    def least(batches):
        for b in batches:
            found = [int(mix(np.frombuffer(x, U) + U(turn)).min()) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(found, U).view(np.int64))], names=["id", "least"])

    return least


def _classes(held: DataFrame, links: DataFrame) -> DataFrame:
    """``id, label`` of every set: the least of those that links join it to, or itself."""
    joined = scratch.table(components(links), "joined")
    return held.select(F.col("doc_id").alias("id")).join(joined, F.col("id") == joined["node"], "left").select("id", F.coalesce("component", "id").alias("label"))


def _likely(held: DataFrame, percent: int, turn: int) -> tuple[DataFrame, bool]:
    """Links among sets of one least hash, in blocks of bounded size, and whether sets of one hash were too many for one block."""
    least = scratch.table(held.select("doc_id", "tokens").mapInArrow(_least(turn), "id long, least long"), "least")
    bins = max(1, -(-least.count() // (BLOCK // 2)))
    least = least.withColumn("bin", F.pmod("least", F.lit(bins)))
    large = scratch.table(least.groupBy("bin").count().where(F.col("count") > BLOCK).select("bin", F.ceil(2 * F.col("count") / BLOCK).alias("blocks")), "large")
    placed = least.join(large, "bin", "left").select(F.col("id").alias("doc_id"), F.xxhash64("bin", F.pmod(F.xxhash64("id"), F.coalesce("blocks", F.lit(1)))).alias("group"))
    tasks = held.join(placed, "doc_id").select("group", "doc_id", "tokens", F.col("doc_id").alias("label"), F.lit(0).alias("side"))
    return scratch.table(tasks.groupBy("group").applyInArrow(_searching(percent), "u long, v long"), "likely"), not large.isEmpty()


def _families(held: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Classes of sets that are likely near copies (``id, label``), and the links that make them.

    They are only a start; the search by prefixes leaves none out. Where a family takes more than one block, one set of each class goes on to another turn, so a family of
    any size becomes one class, or few, in as many turns as its size has powers of a block's.
    """
    left, links, turn, before = held, None, 0, None
    while True:
        found, more = _likely(left, percent, turn)
        links = found if links is None else links.unionByName(found)
        labels = scratch.table(_classes(held, links), "labels")
        firsts = labels.where("id = label").select(F.col("id").alias("first"))
        now = firsts.count()
        if not more or now == before:
            return labels, links
        left, turn, before = scratch.table(held.join(firsts, held["doc_id"] == firsts["first"], "left_semi"), "firsts"), turn + 1, now


def _searched(held: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """All links between sets of different labels that no chain of the links returned replaces."""
    prefix = held.select("doc_id", "tokens", "alone").mapInArrow(_prefixes(percent), "token long, id long, n long").join(labels, "id")
    prefix = scratch.table(prefix, "prefix")
    # The shingles of one passage are in the same sets, told by the number and 128 bits of them: one of those shingles stands for all.
    members = [F.bit_xor(F.xxhash64("id")).alias("m1"), F.bit_xor(F.xxhash64(F.lit("set"), "id")).alias("m2")]
    sizes = prefix.groupBy("token").agg(F.count("*").alias("sets"), F.min("label").alias("a"), F.max("label").alias("b"), F.min("id").alias("lead"), *members).where("a <> b")
    sizes = scratch.table(sizes.groupBy("sets", "m1", "m2").agg(F.min("token").alias("token"), F.min("lead").alias("lead")).select("token", "sets", "lead"), "open")
    rows = scratch.table(prefix.join(sizes, "token"), "candidates")
    # Sets that such shingles join to few others are searched once, with all of them.
    near = scratch.table(components(rows.select(F.col("id").alias("u"), F.col("lead").alias("v"))), "near")
    bins = max(1, -(-near.count() // (BLOCK // 2)))
    small = scratch.table(near.groupBy("component").count().where(F.col("count") <= 2 * BLOCK).select("component"), "small")
    whole = scratch.table(near.join(small, "component").select(F.col("node").alias("id"), F.pmod(F.xxhash64("component"), F.lit(bins)).alias("group")), "whole")
    together = whole.join(labels, "id").select("group", "id", "label", F.lit(0).alias("side"))
    rows = scratch.table(rows.join(whole, "id", "left_anti"), "rest")
    # Of the others, shingles of few sets share tasks: a set goes to as many as its shingles are dealt to.
    few, many = rows.where(F.col("sets") <= BLOCK // 2), rows.where(F.col("sets") > BLOCK // 2)
    bins = max(1, -(-few.count() // (BLOCK // 2)))
    dealt = few.select((-1 - F.pmod(F.xxhash64("token"), F.lit(bins))).alias("group"), "id", "label", F.lit(0).alias("side")).distinct()
    # A shingle of many sets: blocks by class, where it is a large one, and step of size; sets link only within a step or with the next.
    step = F.floor(F.log("n") / F.log(F.lit(100 / percent))).cast("int")
    many = many.withColumn("step", step)
    big = many.groupBy("token", "label").count().where(F.col("count") >= BLOCK // 2).select("token", "label", F.col("label").alias("own"))
    many = scratch.table(many.join(big, ["token", "label"], "left"), "many")
    parts = scratch.table(many.groupBy("token", "own", "step").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")), "parts")
    blocks = parts.select("token", "own", "step", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    name = F.concat_ws(":", F.coalesce(F.col("own").cast("string"), F.lit("mixed")), "step", "block")
    blocks = blocks.withColumn("name", name)
    a, b = blocks.alias("a"), blocks.alias("b")
    meets = (F.col("a.token") == F.col("b.token")) & (F.col("a.name") <= F.col("b.name")) & (F.abs(F.col("a.step") - F.col("b.step")) <= 1) & ~F.coalesce(F.col("a.own") == F.col("b.own"), F.lit(False))
    pairs = a.join(b, meets).select(F.col("a.token").alias("token"), F.xxhash64("a.token", "a.name", "b.name").alias("group"), F.col("a.name").alias("one"), F.col("b.name").alias("two"))
    one, two = (F.struct(F.col(c).alias("name"), F.lit(k).alias("side")) for k, c in enumerate(("one", "two")))
    sides = pairs.select("token", "group", F.explode(F.when(F.col("one") == F.col("two"), F.array(one)).otherwise(F.array(one, two))).alias("x"))
    sides = scratch.table(sides.select("token", "group", "x.*"), "sides")
    placed = many.join(parts, [many["token"] == parts["token"], many["own"].eqNullSafe(parts["own"]), many["step"] == parts["step"]]).select(
        many["token"], many["own"], many["step"], many["id"], many["label"], F.pmod(F.xxhash64("id"), "blocks").alias("block")
    )
    apart = placed.withColumn("name", name).join(sides, ["token", "name"]).select("group", "id", "label", "side")
    tasks = scratch.table(together.unionByName(dealt).unionByName(apart), "tasks")
    given = tasks.join(held, tasks["id"] == held["doc_id"]).select("group", "doc_id", "tokens", "label", "side")
    return scratch.table(given.groupBy("group").applyInArrow(_searching(percent), "u long, v long"), "links")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    A-Z are lower-cased; words are what lies between ASCII white space. A text's set are its distinct shingles of ``shingle`` words, or
    all its words as one where there are fewer; without words it is empty and links with nothing. Two documents link when
    the intersection of their sets is at least ``percent`` hundredths of the union. ``component_id`` is the smallest id
    reachable over links. A null text counts as empty; a null id links with nothing and has a null component; rows of one id
    are one node. Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scratch.modest(docs.sparkSession)
    chunks, buckets = X.sized(docs)
    dealt = X.chunked(X.singled(docs), chunks)

    @X.releasing
    def ask(table):
        return X.rows(Chunk(table, shingle).ask(buckets))

    @X.releasing
    def sets(key, table, answers):
        return Chunk(table, shingle).sets(answers, buckets, percent) if table.num_rows else _SETS_ARROW.empty_table()

    counts = dealt.groupBy("chunk").applyInArrow(ask, X.ROWS).groupBy("bucket").applyInArrow(_count, X.ROWS)
    found = scratch.table(dealt.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(sets, _SETS), "sets")

    same = ["s1", "s2"]
    linked = found.where("tokens is not null and doc_id is not null")
    classes = scratch.table(linked.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.sum(F.col("more") + 1).alias("uses")), "classes")
    reps = linked.join(classes.select(*same, F.col("rep").alias("doc_id")), [*same, "doc_id"], "left_semi").dropDuplicates(["doc_id", *same]).select("doc_id", "tokens", "alone")

    held = scratch.table(reps, "reps")
    labels, likely = _families(held, percent)
    links = _searched(held, labels, percent).unionByName(likely)
    joined = scratch.table(components(links), "components")

    byclass = scratch.table(classes.join(joined, classes["rep"] == joined["node"], "left").where("uses > 1 or component is not null").select(*same, F.coalesce("component", "rep").alias("component")), "named")
    component = F.when(F.col("doc_id").isNotNull(), F.least(F.col("component"), F.col("doc_id"))).alias("component_id")
    may = found.where("tokens is not null").join(byclass, same, "left").select("doc_id", "more", F.col("n").alias("n_shingles"), component)
    return X.again(may.unionByName(found.where("tokens is null").select("doc_id", "more", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))).drop("copy")
