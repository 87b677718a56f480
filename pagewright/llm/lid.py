"""Language identification by prediction by partial matching (PPM).

For each language a tree of byte contexts of up to three bytes holds frozen counts. A byte that a context has seen costs
-log2(c / (n + q)) bits, where n is how often the context occurs and q how many bytes have followed it; otherwise
an escape of -log2(q / (n + q)) bits leads to the context that is one byte shorter, down to eight bits for any byte.
A context that a language has not seen is skipped at no cost. Nothing is excluded after an escape. Code lengths are
whole multiples of 2**-16 bits, so sums are exact in any order. The language that codes a text in the fewest bits wins.

Training counts every run of four bytes of all learning rows; the counts are a written table of any size. Scoring takes the model in blocks that are
sent to all tasks one after the other. A block holds the runs whose two middle bytes are among its own (and with them all contexts and shorter runs
that these need), so a byte is scored in exactly one block and the sums of all blocks are the code lengths under the whole model. Blocks are dealt
so that each has at most ``BLOCK_CELLS`` runs times languages; one block is all there is until a corpus has more.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.llm import scratch
from pagewright.llm.text import Texts, releasing, texts

ORDER = 3
#: Runs times languages of a block of the model, of four bytes each. No pair of middle bytes has more than 65,536 runs.
BLOCK_CELLS = 1 << 24
BITS = 1 << 16
UNKNOWN = "und"
SLICE = 1 << 19
#: Distinct runs that a task holds before it passes its counts on.
HELD_RUNS = 1 << 21


def runs_of(part: Texts) -> np.ndarray:
    """For each byte, it and the three before it in its text (zeros before the first), as one number."""
    buf, starts = part.buf.astype(np.uint32), part.offs[:-1]
    key = buf.copy()
    for j in range(1, ORDER + 1):
        past = np.zeros_like(buf)
        past[j:] = buf[:-j] if j < len(buf) else past[j:]
        for i in range(j):
            at = starts + i
            past[at[at < len(buf)]] = 0
        key |= past << np.uint32(8 * j)
    return key


class Lookup:
    """Indices of known 32-bit keys: two hashed tables that hold almost all of them, and a sorted rest."""

    def __init__(self, keys: np.ndarray, weight: np.ndarray):
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.tables, left = [], np.argsort(weight, kind="stable")
        for mult in (0x9E3779B1, 0x85EBCA6B):
            slot = np.full(1 << self.bits, -1, np.int32)
            at = self._at(keys[left], mult)
            slot[at] = left  # the last, most frequent, stays
            self.tables.append((mult, slot, np.where(slot >= 0, keys[slot], 0).astype(np.uint32)))
            left = left[slot[at] != left]
        self.order = left[np.argsort(keys[left])]
        self.rest = keys[self.order]

    def _at(self, q: np.ndarray, mult: int) -> np.ndarray:
        return (q * np.uint32(mult)) >> np.uint32(32 - min(self.bits, 32))

    def find(self, q: np.ndarray) -> np.ndarray:
        found, todo = np.full(len(q), -1, np.int32), None
        for mult, slot, held in self.tables:
            ask = q if todo is None else q[todo]
            at = self._at(ask, mult)
            got = np.where(held[at] == ask, slot[at], -1)
            if todo is None:
                found = got
                todo = np.flatnonzero(got < 0)
            else:
                found[todo] = got
                todo = todo[got < 0]
        if len(self.rest) and len(todo):
            j = np.minimum(np.searchsorted(self.rest, q[todo]), len(self.rest) - 1)
            found[todo] = np.where(self.rest[j] == q[todo], self.order[j], -1)
        return found


@dataclass
class Model:
    """A block of the model; ``block`` tells for each pair of middle bytes which block has its runs, and ``own`` which one this is."""

    langs: list[str]
    block: np.ndarray | None = None
    own: int = 0
    levels: list[tuple[Lookup, np.ndarray, Lookup | None, np.ndarray]] = field(default_factory=list)

    def cost(self, key: np.ndarray, order: int) -> np.ndarray:
        """Code lengths of the last byte of each key after the ``order`` bytes before it: a row of one for each language."""
        if order < 0:
            return np.full((len(key), len(self.langs)), 8 * BITS, np.int32)
        known, table, contexts, escapes = self.levels[order]
        at = known.find(key)
        out = table[at]
        miss = np.flatnonzero(at < 0)
        if len(miss):
            q = key[miss]
            out[miss] = self.escape(q, order) + self.cost(q & np.uint32((1 << (8 * order)) - 1 if order else 0), order - 1)
        return out

    def escape(self, key: np.ndarray, order: int) -> np.ndarray:
        _, _, contexts, escapes = self.levels[order]
        at = contexts.find(key >> np.uint32(8))
        return np.where(at[:, None] >= 0, escapes[at], 0)


def middle(key: np.ndarray) -> np.ndarray:
    """The two middle bytes of each run of four."""
    return (key >> np.uint32(8)) & np.uint32(0xFFFF)


def build(langs: list[str], lang: np.ndarray, key: np.ndarray, n: np.ndarray, short: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> Model:
    """A block from counts ``n`` of runs ``key`` (four bytes) in language number ``lang``; ``short`` are those of the last two bytes of all runs of the model."""
    model = Model(langs)
    short = short or (lang, key & np.uint32(0xFFFF), n)
    for order in range(ORDER + 1):
        lang_of, runs, times = short if order < 2 else (lang, key, n)
        cut = (runs & np.uint32((1 << (8 * (order + 1))) - 1)) if order < ORDER else runs
        keys, at = np.unique(cut, return_inverse=True)
        count = np.zeros((len(keys), len(langs)), np.int64)
        np.add.at(count, (at, lang_of), times)
        contexts, of = np.unique(keys >> np.uint32(8), return_inverse=True)
        total, kinds = (np.zeros((len(contexts), len(langs)), np.int64) for _ in range(2))
        np.add.at(total, of, count)
        np.add.at(kinds, of, count > 0)
        bits = lambda p: np.rint(-np.log2(p) * BITS).astype(np.int32)
        escapes = np.where(total > 0, bits(np.maximum(kinds, 1) / np.maximum(total + kinds, 1)), 0).astype(np.int32)
        lower = model.cost(keys & np.uint32((1 << (8 * order)) - 1 if order else 0), order - 1)
        own = bits(np.maximum(count, 1) / np.maximum(total + kinds, 1)[of])
        table = np.where(count > 0, own, escapes[of] + lower).astype(np.int32)
        model.levels.append((Lookup(keys, count.sum(1)), table, Lookup(contexts, total.sum(1)), escapes))
    return model


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of learning; a null id is."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


@dataclass
class Trained:
    """Exact counts (``lang, key, n``), the languages in order, and the block of each pair of middle bytes."""

    counts: DataFrame
    langs: list[str]
    block: np.ndarray
    blocks: int
    short: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def part(self, own: int) -> Model:
        """One block of the model."""
        if not self.langs:
            return Model([])
        if self.short is None:
            pair = F.col("key").bitwiseAND(0xFFFF).alias("key")
            self.short = self._arrays(self.counts.groupBy("lang", pair).agg(F.sum("n").alias("n")))
        mine = self.counts
        if self.blocks > 1:
            pairs = [(int(p),) for p in np.flatnonzero(self.block == own)]
            pairs = self.counts.sparkSession.createDataFrame(pairs, "pair long")
            mine = mine.join(pairs, F.shiftright("key", 8).bitwiseAND(0xFFFF) == F.col("pair"), "left_semi")
        model = build(self.langs, *self._arrays(mine), short=self.short)
        model.block, model.own = (self.block if self.blocks > 1 else None), own
        return model

    def _arrays(self, counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        table = counts.select("lang", "key", "n").toArrow()
        number = {x: i for i, x in enumerate(self.langs)}
        lang = table["lang"].combine_chunks().dictionary_encode()
        at = np.array([number[x] for x in lang.dictionary.to_pylist()] or [0], np.int64)[lang.indices.to_numpy()]
        return at, table["key"].to_numpy().astype(np.uint32), table["n"].to_numpy()


def train(rows: DataFrame, lang_col: str = "lang", text_col: str = "text", block_cells: int = BLOCK_CELLS) -> Trained:
    """A model of every non-null language of the rows, learned from all of their texts. With no such rows it has no language."""
    scratch.modest(rows.sparkSession)
    schema = pa.schema([("lang", pa.string()), ("key", pa.int64()), ("n", pa.int64())])

    def count(batches):
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def squeeze(lang: str) -> None:
            keys, at = np.unique(np.concatenate([k for k, _ in held[lang]]), return_inverse=True)
            held[lang] = [(keys, np.bincount(at, np.concatenate([n for _, n in held[lang]])).astype(np.int64))]

        def told():
            for lang in held:
                squeeze(lang)
                keys, n = held[lang][0]
                for i in range(0, len(keys), 1 << 16):
                    k = keys[i : i + (1 << 16)].astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k), pa.array(n[i : i + (1 << 16)])], schema=schema)
            held.clear()

        for b in batches:
            table = pa.Table.from_batches([b])
            for lang in b.column(0).unique().to_pylist():
                own = table.filter(pa.compute.equal(table.column(0), lang)).column(1)
                for part in texts(own, lower=True, most=SLICE):
                    held.setdefault(lang, []).append(np.unique(runs_of(part), return_counts=True))
                    if len(held[lang]) > 16:
                        squeeze(lang)
            if sum(len(k) for runs in held.values() for k, _ in runs) > HELD_RUNS:
                yield from told()
        yield from told()

    known = rows.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    counts = known.mapInArrow(releasing(count), "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    counts = scratch.table(counts, "runs")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    sizes = counts.select(F.shiftright("key", 8).bitwiseAND(0xFFFF).alias("pair"), "key").distinct().groupBy("pair").count().orderBy("pair").toArrow()
    block, own, room = np.zeros(1 << 16, np.int32), 0, block_cells
    for pair, n in zip(sizes["pair"].to_pylist(), sizes["count"].to_pylist(), strict=True):
        if n * len(langs) > room and room < block_cells:
            own, room = own + 1, block_cells
        block[pair], room = own, room - n * len(langs)
    return Trained(counts, langs, block, own + 1)


def scores(model: Model, part: Texts) -> np.ndarray:
    """Code lengths of each text under each language, in multiples of 1 / BITS, as far as they are in this block."""
    size = np.diff(part.offs)
    total = np.zeros((len(size), len(model.langs)), np.int64)
    full = np.flatnonzero(size)
    if len(full) and model.langs:
        key = runs_of(part)
        if model.block is None:
            total[full] = np.add.reduceat(model.cost(key, ORDER), part.offs[:-1][full], axis=0, dtype=np.int64)
        else:
            mine = np.flatnonzero(model.block[middle(key)] == model.own)
            doc = np.repeat(np.arange(len(size)), size)[mine]
            at = np.flatnonzero(np.diff(doc, prepend=-1))
            if len(mine):
                total[doc[at]] = np.add.reduceat(model.cost(key[mine], ORDER), at, axis=0, dtype=np.int64)
    return total


_ADDED = [("lang_pred", pa.string()), ("score", pa.float64()), ("bits_per_byte", pa.float64())]


def judged(langs: list[str], total: np.ndarray, size: np.ndarray, letter: np.ndarray) -> list[pa.Array]:
    """Language, share of the posterior and bits a byte of texts, from their code lengths and sizes."""
    n = len(size)
    if not langs:
        return [pa.array([UNKNOWN] * n, pa.string()), pa.array(np.zeros(n)), pa.array(np.zeros(n))]
    best = total.argmin(1)
    least = total[np.arange(n), best]
    share = 1 / np.exp2(np.maximum((least[:, None] - total) / BITS, -1000)).sum(1)
    return [pa.array([langs[k] if g else UNKNOWN for k, g in zip(best.tolist(), letter.tolist(), strict=True)], pa.string()), pa.array(np.where(letter, share, 0.0)), pa.array(least / BITS / np.maximum(size, 1))]


def identify(docs: DataFrame, trained: Trained, text_col: str = "text") -> DataFrame:
    """One row per input row: ``row`` (a struct of all its columns), ``lang_pred``, ``score``, ``bits_per_byte``.

    ``lang_pred`` is a language of the model; `und` where the text is null, empty or has no letter, or where the model knows
    no language; ties go to the language that sorts first. ``score`` is the language's share of the posterior, 0 for
    `und`. ``bits_per_byte`` is its code length, 0 for an empty text. Whole texts are read, however long; repeated
    rows are judged one by one.
    """
    spark, langs = docs.sparkSession, trained.langs
    scratch.modest(spark)
    text = F.col("row").getField(text_col)
    read = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row")).select("row", text.alias("text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    slices = SLICE // max(1, len(langs) // 8)
    schema = T.StructType([read.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits_per_byte", T.DoubleType())])

    def batch(row: pa.Array, *of) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([row, *judged(langs, *of)], names=["row", *(k for k, _ in _ADDED)])

    if trained.blocks == 1:
        known = scratch.broadcast(spark, trained.part(0))

        def judge(batches):
            model = known.value
            for b in batches:
                letter = b.column("letter").to_numpy(zero_copy_only=False)
                for part in texts(b.column("text"), lower=True, most=slices):
                    n = len(part.offs) - 1
                    yield batch(b.column("row").slice(part.first, n), scores(model, part), np.diff(part.offs), letter[part.first : part.first + n])

        return read.mapInArrow(releasing(judge), schema)

    # Rows are known by two hashes of their texts; equal texts have equal sums.
    key = [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("lid"), "text").alias("h2")]
    sums = None
    for own in range(trained.blocks):
        known = scratch.broadcast(spark, trained.part(own))

        def add(batches, known=known):
            model = known.value
            for b in batches:
                for part in texts(b.column(2), lower=True, most=slices):
                    n = len(part.offs) - 1
                    yield pa.RecordBatch.from_arrays([*(b.column(k).slice(part.first, n) for k in (0, 1)), pa.array(list(scores(model, part)), pa.list_(pa.int64()))], names=["h1", "h2", "sums"])

        found = read.where("text is not null").select(*key, "text").mapInArrow(releasing(add), "h1 long, h2 long, sums array<long>").dropDuplicates(["h1", "h2"])
        found = scratch.table(found, "block")
        known.unpersist()
        sums = found if sums is None else sums.unionByName(found)
    each = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(len(langs))]
    whole = scratch.table(sums.groupBy("h1", "h2").agg(*each).select("h1", "h2", F.array(*[F.col(f"s{i}") for i in range(len(langs))]).alias("sums")), "sums")
    joined = read.select("row", "letter", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"), *key).join(whole, ["h1", "h2"], "left").select("row", "letter", "size", "sums")

    def finish(batches):
        for b in batches:
            total = np.array([x or [0] * len(langs) for x in b.column("sums").to_pylist()], np.int64).reshape(b.num_rows, len(langs))
            yield batch(b.column("row"), total, b.column("size").to_numpy(), b.column("letter").to_numpy(zero_copy_only=False))

    return joined.mapInArrow(releasing(finish), schema)


def train_on(docs: DataFrame, block_cells: int = BLOCK_CELLS) -> Trained:
    """A model of the rows that are not held out."""
    return train(docs.where(~held_out(F.col("doc_id"))), block_cells=block_cells)


def accepted(found: DataFrame) -> Column:
    """Whether a row of ``identify`` is in one of the languages: it has letters, and its language codes it in fewer bits than plain bytes take."""
    return (found["lang_pred"] != UNKNOWN) & (found["bits_per_byte"] < 8)
