"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations.

A source whose target is r times its size takes floor(r) whole copies of each of its documents for certain. The fraction that is left is each document's inclusion probability p in one
further copy, unequal from source to source. Documents are ranked by Pareto's variable, the odds of a uniform number of their own divided by their inclusion odds, and those of the
lowest ranks are taken: a sample of fixed size, which is counted in words here. The document at which a source's quota ends gives only the words that are still open, so that every source meets its target
to the word however long its documents are.

No source is ever sorted as a whole. A rank is a number of ``BITS`` bits, and where a source's quota ends is found like the digits of a number: the sums of ``SLOTS`` slots tell in which slot it ends,
whose rows are looked at again, and only those that share all ``LEVELS`` digits with the end are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagewright.llm import scratch

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: A document is taken no more often than this.
MOST = 3
BITS, LEVELS, DIGIT = 48, 3, 8
SLOTS = 1 << DIGIT


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, target, whole, chance, quota`` from ``source, source_size``, one row per source.

    Sources in the order of their code points, null last, have the weights in turn and share all words by them; a target stops at ``most`` times its source's size, and the
    excess goes to the others by weight until none is above: those that stop are the first ones by size over weight. ``whole`` copies are certain, ``chance`` is the inclusion
    probability of one more, and ``quota`` the words that all of these are to have. An empty source has a target of 0.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("long")
    every = Window.partitionBy()
    ordered = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    rows = sources.withColumn("weight", weight).withColumns({"words": F.sum("source_size").over(every), "weighed": F.sum("weight").over(every)})
    rows = rows.withColumns({"stopped": F.coalesce(F.sum("source_size").over(before) * most, F.lit(0)), "gone": F.coalesce(F.sum("weight").over(before), F.lit(0))})
    # Whether the share of what those before leave would lift this source above its bound.
    stops = exact("source_size") * most * (exact("weighed") - exact("gone")) < exact("weight") * (exact("words") - exact("stopped"))
    rows = rows.withColumn("stops", stops)
    held = F.coalesce(F.sum(F.when(F.col("stops"), F.col("source_size") * most)).over(every), F.lit(0))
    left = F.coalesce(F.sum(F.when(~F.col("stops"), F.col("weight"))).over(every), F.lit(0))
    rows = rows.withColumns({"held": held, "left": left})
    target = F.when(F.col("stops"), (F.col("source_size") * most).cast("double")).otherwise((F.col("weight") * (F.col("words") - F.col("held"))).cast("double") / F.col("left").cast("double"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(F.lit(0.0))
    rows = rows.withColumn("target", target).withColumn("ratio", ratio).withColumn("whole", F.floor("ratio"))
    return rows.select("source", "source_size", "target", "whole", (F.col("ratio") - F.col("whole")).alias("chance"), F.floor(F.col("target") - F.col("whole") * F.col("source_size") + 0.5).alias("quota"))


def _rank(chance: Column, doc_id: Column, copy: Column, seed: int) -> Column:
    """Pareto's variable q, as floor(2**BITS * q / (1 + q)), which has the same order; null where nothing is left to chance."""
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), copy.cast("string")), 256)
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)
    q = (u / (1 - u)) / (chance / (1 - chance))
    return F.when(chance > 0, F.least(F.floor(q / (1 + q) * float(1 << BITS)), F.lit((1 << BITS) - 1)))


def _ends(units: DataFrame, sources: DataFrame) -> DataFrame:
    """``of, slot, last, open``: of each source the slot in which its quota ends, the unit at which it ends, and the words that this one gives.

    A source that does not go beyond its quota has no row.
    """
    same = lambda name: F.col("source").eqNullSafe(F.col(name))
    found = sources.select(F.col("source").alias("of"), "quota", F.lit(0).cast("long").alias("slot"), F.lit(0).cast("long").alias("before"))
    for level in range(LEVELS):
        shift = BITS - DIGIT * (level + 1)
        here = units.join(found, same("of") & (F.shiftright("rank", shift + DIGIT) == F.col("slot")))
        slots = here.groupBy("of", "quota", "before", F.shiftright("rank", shift).alias("slot")).agg(F.sum("size").alias("words"))
        # At most ``SLOTS`` rows of each source.
        upto = F.sum("words").over(Window.partitionBy("of").orderBy("slot"))
        first = slots.withColumn("upto", F.col("before") + upto).where("upto > quota")
        first = first.groupBy("of", "quota").agg(F.min(F.struct("slot", (F.col("upto") - F.col("words")).alias("before"))).alias("x"))
        found = scratch.table(first.select("of", "quota", "x.slot", "x.before"), "slots")
    here = units.join(found, same("of") & (F.shiftright("rank", BITS - DIGIT * LEVELS) == F.col("slot")))
    unit = F.struct("rank", "doc_id", "copy", "size")
    here = here.withColumn("upto", F.col("before") + F.sum("size").over(Window.partitionBy("of").orderBy(unit).rowsBetween(Window.unboundedPreceding, 0)))
    ends = here.where("upto > quota").groupBy("of", "slot").agg(F.min(F.struct(unit.alias("unit"), (F.col("quota") - F.col("upto") + F.col("size")).alias("open"))).alias("x"))
    return ends.select("of", "slot", F.col("x.unit").alias("last"), "x.open")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 2024) -> DataFrame:
    """One row per input row: ``doc_id, size, source_size, target, taken, source``.

    ``docs`` has ``doc_id``, ``text`` and ``source``; other columns are ignored. ``size`` is the number of words between ASCII white space, ``source_size`` that of the whole source, ``target`` its share (see
    ``targets``) and ``taken`` the words that the mix takes of the document: whole copies, at most ``most``, and of one document of a source its first words besides. A source's taken words are its target,
    rounded. The same rows and seed give the same mix, in whatever order they come. A null or empty text has no words and nothing is taken of it; null is a source of its own, the last one. Rows of one id are ranked by their number among rows of the same id, source and
    size, so repeated rows are documents of their own. Of no documents nothing is taken.
    """
    words = F.size(F.regexp_extract_all(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD), F.lit(0))).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words.alias("size"))
    # Texts are read once; from here on a document is a row of a few numbers.
    counted = scratch.table(rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows")), "sizes")
    sources = scratch.table(targets(counted.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size")), weights, most), "targets")
    named = sources.withColumnRenamed("source", "of")
    each = counted.select("doc_id", "source", "size", F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("copy"))
    units = each.join(named, F.col("source").eqNullSafe(F.col("of"))).drop("of", "quota").withColumn("rank", _rank(F.col("chance"), F.col("doc_id"), F.col("copy"), seed))
    units = scratch.table(units, "units")
    able = units.where("size > 0 and rank is not null").select("source", "doc_id", "copy", "size", "rank")
    ends = scratch.table(_ends(able, sources.where("chance > 0")), "ends")
    unit, slot = F.struct("rank", "doc_id", "copy", "size"), F.shiftright("rank", BITS - DIGIT * LEVELS)
    before = F.col("slot").isNull() | (slot < F.col("slot")) | ((slot == F.col("slot")) & (unit < F.col("last")))
    at_end = (slot == F.col("slot")) & unit.eqNullSafe(F.col("last"))
    further = F.when(F.col("rank").isNull(), 0).when(before, F.col("size")).when(at_end, F.col("open")).otherwise(0)
    ranked = units.join(ends, F.col("source").eqNullSafe(F.col("of")), "left")
    return ranked.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("whole") + further).cast("long").alias("taken"), "source")
