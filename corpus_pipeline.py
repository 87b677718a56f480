"""Corpus pipeline: from raw documents to packed training sequences.

Every stage works on all rows that its predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagewright.llm import scratch
from pagewright.llm.decontam import decontaminate
from pagewright.llm.exact import exact_groups, normalised
from pagewright.llm.lid import accepted, identify, train_on
from pagewright.llm.ngram_join import near_duplicates
from pagewright.llm.packing import pack_documents
from pagewright.llm.queries import tokenizer_file


def _kept(docs: DataFrame, found: DataFrame, stays: Column) -> DataFrame:
    """The documents of the rows of ``found`` (with ``row``, a struct of a document's columns) that stay."""
    return found.where(stays).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in one of the languages learned from the rows that are not held out; see ``lid.accepted``.

    A null or empty text, and one without a letter, goes. Rows are judged one by one, so repeated ones stay or go together; of no documents, none stay.
    """
    scratch.settle()
    found = identify(docs, train_on(docs))
    return _kept(docs, found, accepted(found))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that of the smallest id, a null one last; null counts as empty.

    Documents are joined with the ids of those that go. Only rows of an id that has both kinds are told apart by a digest of their text; of rows repeated with one id and
    text, the one whose other columns sort first as JSON stays.
    """
    scratch.settle()
    found = scratch.table(exact_groups(docs).select("doc_id", "text_sha256", "kept"), "exact")
    by_id = found.groupBy(F.col("doc_id").alias("told_id")).agg(F.bool_or("kept").alias("some"), F.bool_and("kept").alias("all")).where("not all")
    by_id = scratch.table(by_id, "by-id")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    same_id = F.col("row").getField("doc_id").eqNullSafe(F.col("told_id"))
    left = rows.join(by_id.where("not some").select("told_id"), same_id, "left_anti")
    mixed = by_id.where("some").select("told_id")
    if not mixed.isEmpty():
        kept = found.where("kept").join(mixed, F.col("doc_id").eqNullSafe(F.col("told_id")), "left_semi").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha"))
        own = F.sha2(normalised(F.col("row").getField("text")), 256)
        some = left.join(mixed, same_id, "left_semi").withColumns({"own_id": F.col("row").getField("doc_id"), "own_sha": own})
        some = some.join(kept, F.col("own_id").eqNullSafe(F.col("kept_id")) & (F.col("own_sha") == F.col("kept_sha")), "left_semi")
        order = Window.partitionBy("own_id", "own_sha").orderBy(F.to_json("row"))
        one = some.withColumn("place", F.row_number().over(order)).where("place = 1").select("row")
        left = left.join(mixed, same_id, "left_anti").unionByName(one)
    return _kept(docs, left, F.lit(True))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id; a document without an id or without words stays, and so do all rows of an id that stays.

    Only the ids of the rows that go are joined.
    """
    scratch.settle()
    found = near_duplicates(docs)
    gone = scratch.table(found.where("component_id <> doc_id").select(F.col("doc_id").alias("gone_id")).distinct(), "near")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    return _kept(docs, rows.join(gone, F.col("row").getField("doc_id") == F.col("gone_id"), "left_anti"), F.lit(True))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are part of a benchmark window; a null or empty text has none and stays.

    Rows are judged one by one, so repeated ones stay or go together; without a benchmark all stay.
    """
    scratch.settle()
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=True)
    return _kept(docs, found, ~F.col("contaminated"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, packed into sequences; repeated rows each on their own, a null or empty text as the end token alone."""
    scratch.settle()
    return pack_documents(docs, tokenizer_file())


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", packing)]

#: Neither the language model nor the tokenizer can be expressed in SQL; tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``. A stage's tables are deleted when its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mark = scratch.written()
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
        scratch.clear(spark, mark, but=docs)
    return docs
