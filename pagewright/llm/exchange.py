"""Packed exchange of hashes between chunks of documents and buckets of hashes.

Documents are dealt into chunks of about ``CHUNK_BYTES`` of text. A chunk asks about its distinct 64-bit hashes: one row for each bucket,
with the hashes of that bucket as a sorted array. A bucket answers every row that it got with one bit (or number) for each hash of the row, in the
same order. So a value that is in every document costs one entry for each chunk, whatever the number of documents, and no task
holds more than one chunk's texts or one bucket's hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm import scratch
from pagewright.llm.text import U, release

CHUNK_BYTES = 1 << 20
BUCKET_BYTES = 4 << 20
EVERY = 2
ROWS = "bucket int, chunk int, kind int, payload binary"
SCHEMA = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("kind", pa.int32()), ("payload", pa.binary())])


def sized(docs: DataFrame) -> tuple[int, int]:
    """How many chunks and buckets the texts need."""
    total = docs.agg(F.sum(F.octet_length("text") + 16).alias("n")).first()["n"] or 0
    return max(64, -(-total // CHUNK_BYTES)), max(64, -(-total // BUCKET_BYTES))


def singled(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id, text``) with one row of each set of repeated rows and ``more``, how many others it has.

    Repeated rows would all go to one chunk, however many there are. Usually there are none, and then the rows are only counted, by their hashes.
    """
    key = ["doc_id", "h1", "h2"]
    hashed = docs.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit("row"), "text")})
    sets = scratch.table(hashed.groupBy(*key).agg((F.count("*") - 1).alias("more")).where("more > 0").select(F.col("doc_id").alias("id"), F.col("h1").alias("g1"), F.col("h2").alias("g2"), "more"), "repeated")
    none = F.lit(0).cast("long").alias("more")
    if sets.isEmpty():
        return docs.select("doc_id", "text", none)
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))
    ones = hashed.join(sets, same).dropDuplicates(key).select("doc_id", "text", "more")
    return hashed.join(sets, same, "left_anti").select("doc_id", "text", none).unionByName(ones)


def again(found: DataFrame) -> DataFrame:
    """Every result as often as its row was there, numbered from 0 by ``copy``."""
    return found.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), "more"))).drop("more")


def chunked(docs: DataFrame, chunks: int) -> DataFrame:
    return docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int").alias("chunk"), "doc_id", "text", "more")


def placed(h: np.ndarray, buckets: int, bits: int = 32) -> np.ndarray:
    """Bucket and fingerprint of each hash in one number; a fingerprint has ``bits`` bits."""
    return ((h >> U(32)) % U(buckets)) << U(32) | (h & U((1 << bits) - 1))


def bucket_bounds(bucket: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of each bucket that occurs in the sorted array."""
    cut = np.searchsorted(bucket, np.arange(buckets + 1))
    return [(int(k), int(cut[k]), int(cut[k + 1])) for k in np.flatnonzero(np.diff(cut))]


def rows(found: list[tuple[int, int, int, bytes]]) -> pa.Table:
    cols = list(zip(*found, strict=True)) or [()] * 4
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, SCHEMA, strict=True)], schema=SCHEMA)


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unbits(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)


def releasing(f):
    """A function over groups that releases memory after every ``EVERY`` of them."""
    calls = [0]

    def done(out: pa.Table) -> pa.Table:
        calls[0] += 1
        if calls[0] % EVERY == 0:
            release()
        return out

    # Spark tells what to pass by the number of parameters.
    if f.__code__.co_argcount == 1:
        return lambda table: done(f(table))
    return lambda key, left, right: done(f(key, left, right))


def in_order(table: pa.Table) -> pa.Table:
    """A chunk's documents by id (null last) and then by text, whatever order they came in."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()
