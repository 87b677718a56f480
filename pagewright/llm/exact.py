"""Exact deduplication by content-defined chunk recipes (DataFrame functions only).

A text is cut where its own content says so: between words of which one ends and the next begins with certain letters, in text without spaces between certain pairs of
characters, and after ideographic stops. Text without any of these is cut every ``MAX_CHUNK`` characters. A chunk's identifier is 128 bits of two hashes; the dictionary of distinct
chunks, by length and SHA-256, verifies that no two of them have one identifier, and the operator fails if they do. A document's recipe is its ordered list of
identifiers, and documents are equal when their recipes are. Texts never leave the task that read them: only digests and recipes are moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm import scratch

SPACE = r"[\x20\x09-\x0D]+"
#: What every cut comes after stands first, so that most places are passed over at once.
CUT = r"(?<=[ 3Kvw、。])(?:(?=[a-eA-E])(?<=[aeiou][kmpgd][.,!?]? )|(?<=[Zq7x][3Kvw]|[、。]))"
MAX_CHUNK = 8192


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def chunks(text: Column, cut: str = CUT, most: int = MAX_CHUNK) -> Column:
    """The text's chunks in order; their concatenation is the text. An empty text has one empty chunk."""
    pieces = lambda p: F.when(F.length(p) <= most, F.array(p)).otherwise(F.regexp_extract_all(p, F.lit(f"(?s).{{1,{most}}}"), F.lit(0)))
    return F.when(F.length(text) == 0, F.array(F.lit(""))).otherwise(F.flatten(F.transform(F.filter(F.split(text, cut), lambda p: p != ""), pieces)))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cut: str = CUT, most: int = MAX_CHUNK) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256, n_chunks``.

    Texts count as equal when they are identical after each run of ASCII white space is one space; null
    counts as empty. The smallest id of a group stays. Rows repeated with one id and one text are one group and
    only one of them is ``kept``; a null id comes after all others. ``n_chunks`` tells how many chunks a text has. Other columns are ignored; no rows give none.
    """
    read = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("t"))
    digest = lambda c: F.struct(F.xxhash64(c).alias("h"), F.length(c).alias("n"), F.unhex(F.sha2(c, 256)).alias("proof"))
    rows = scratch.table(read.select("doc_id", F.unhex(F.sha2("t", 256)).alias("sha"), F.transform(chunks(F.col("t"), cut, most), digest).alias("chunks")), "chunks")
    identifier = lambda x: F.struct(x["h"].alias("h"), F.xxhash64(x["proof"]).alias("p"))
    dictionary = rows.select(F.explode("chunks").alias("x")).select("x.*").distinct()
    twice = scratch.table(dictionary.groupBy(identifier(F.struct("h", "proof")).alias("id")).count().where("count > 1"), "unverified")
    if not twice.isEmpty():
        raise RuntimeError("two chunks have one identifier; cut the texts in another way")
    recipes = rows.select("doc_id", "sha", F.transform("chunks", identifier).alias("recipe"))
    groups = recipes.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1")
    groups = scratch.table(groups, "groups")
    told = ["doc_id", "sha", F.size("recipe").cast("long").alias("n_chunks"), "keep_id", "group_size"]
    found = scratch.table(recipes.join(groups, "recipe", "left").select(*told), "recipes")
    same = found.where("group_size is not null")
    same = same.groupBy(*same.columns).agg(F.count("*").alias("copies")).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    text = F.lower(F.hex("sha")).alias("text_sha256")
    alone = found.where("group_size is null").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), text, "n_chunks")
    return alone.unionByName(same.select("doc_id", "keep_id", "group_size", kept.alias("kept"), text, "n_chunks"))
