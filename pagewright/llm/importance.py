"""Importance resampling towards a target distribution, in Spark SQL.

Every document is exploded into runs of words, each of which falls into a bucket by its CRC-32. How often a bucket occurs in all documents and in
all target texts gives its gain, the logarithm of the ratio of smoothed frequencies in thousandths. A document weighs the mean gain of its runs; with Gumbel noise of its own added, the
highest scores are a sample without replacement whose odds follow the weights.

What is broadcast is the table of gains: one row for each bucket, at most ``MOST_BUCKETS`` of them, whatever the corpus. Ranks come from one range-partitioned sort: the place of
a row within its partition, and the number of rows in the partitions before it.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagewright.llm import scratch

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
#: The table of gains is broadcast; more buckets than this are refused.
MOST_BUCKETS = 1 << 20


def _runs(words: Column, low: int, high: int) -> Column:
    """All runs of ``low`` to ``high`` consecutive words, joined by one space."""

    def of(n: int) -> Column:
        starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))

    return F.concat(*[words if n == 1 else of(n) for n in range(low, high + 1)])


def _exploded(texts: DataFrame, keys: list[str], low: int, high: int, buckets: int) -> DataFrame:
    """``keys``, ``n_words`` and one row for each run, with its ``bucket``; and one row more of each text, without a bucket, so that a text without words is not lost."""
    words = F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), ascii_uppercase, ascii_lowercase), F.lit(WORD), F.lit(0))
    split = texts.select(*keys, words.alias("words"))
    runs = F.concat(F.array(F.lit(None).cast("string")), _runs(F.col("words"), low, high))
    each = split.select(*keys, F.size("words").alias("n_words"), F.explode(runs).alias("run"))
    return each.select(*keys, "n_words", (F.crc32(F.col("run").cast("binary")) % buckets).alias("bucket"))


def gains(docs: DataFrame, target: DataFrame, low: int = 1, high: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, gain`` of every bucket, by how often it occurs in all texts of either side."""
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"between 1 and {MOST_BUCKETS} buckets")
    sides = [_exploded(side.select("text"), [], low, high, buckets).where("bucket is not null").groupBy("bucket").agg(F.count("*").alias(name)) for side, name in ((docs, "s"), (target, "t"))]
    every = docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    counted = scratch.table(every.join(sides[0], "bucket", "left").join(sides[1], "bucket", "left").fillna(0), "buckets")
    total = counted.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    s, t = (F.col(c).cast("double") for c in "st")
    ratio = (t + 1) * F.lit(float(total.s + buckets)) / ((s + 1) * F.lit(float(total.t + buckets)))
    return counted.select("bucket", F.floor(1000 * F.ln(ratio)).alias("gain"))


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the seed and the id alone; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with ``name``, their place from 1 in the order: a range-partitioned sort, places within partitions and an offset for each partition."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # The lower 33 bits of Spark's row number count a partition's rows.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = scratch.table(placed.select(F.struct("*").alias("row"), F.spark_partition_id().alias("part"), place.alias("place")), "sorted")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each partition of the sort.
    offsets = placed.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    return placed.join(F.broadcast(offsets), "part").select("row.*", (F.col("offset") + F.col("place") + 1).alias(name))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least: int = 20, low: int = 1, high: int = 1, buckets: int = BUCKETS, seed: int = 2024) -> DataFrame:
    """One row per input row: ``doc_id, n_features, weight, score, rank``; ``rank`` is null where a document is not drawn.

    ``docs`` has ``doc_id`` and ``text``, ``target`` has ``text``; other columns are ignored. Words are lower-cased runs of digits, letters and whatever lies beyond ASCII; features
    are all runs of ``low`` to ``high`` of them, repeats counted. Of the N documents of at least ``least`` words, floor(``percent`` * N / 100) are drawn: those of the highest scores, ties
    to the smaller id, a null one last, and of one id to the greater weight. A null or empty text has no features and weighs nothing; it is not drawn unless ``least`` is 0. Repeated
    rows are documents of their own, with one score, and take ranks one after the other. An empty target gives every bucket a gain by the documents alone; of no documents, none are drawn.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    target = target.select(F.col("text").cast("string").alias("text"))
    # Rows of one id are told apart by two hashes of their texts; those with both alike are counted as copies, so that no row number is needed.
    keys = ["doc_id", "h1", "h2"]
    keyed = docs.select("doc_id", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("importance"), "text").alias("h2"), "text")
    each = _exploded(keyed, keys, low, high, buckets).join(F.broadcast(gains(docs, target, low, high, buckets)), "bucket", "left")
    summed = each.groupBy(*keys).agg(F.count("bucket").alias("n"), F.sum("gain").alias("total"), F.max("n_words").alias("n_words"), F.count_if(F.col("bucket").isNull()).alias("copies"))
    weight = F.when(F.col("n") > 0, F.expr("(total - pmod(total, n)) div n")).otherwise(F.lit(0).cast("long"))
    scored = summed.select("doc_id", F.expr("n div copies").alias("n_features"), weight.alias("weight"), (F.col("n_words") >= least).alias("eligible"), F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    scored = scratch.table(scored.select("doc_id", "n_features", "weight", (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score"), "eligible"), "scored")
    drawn = percent * scored.where("eligible").count() // 100
    order = [F.col("eligible").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight").desc(), F.col("n_features").desc()]
    rank = F.when(F.col("number") <= drawn, F.col("number")).cast("long")
    return numbered(scored, order, "number").select("doc_id", "n_features", "weight", "score", rank.alias("rank"))
