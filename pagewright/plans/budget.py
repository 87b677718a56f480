"""A budget of pages by outcome: documents in the order of their ids draw on one budget, and those that fail spend nothing.

What a document may take depends on what became of those before it. Documents are therefore processed in waves: a wave is every next document that fits whole even if all before it succeed, so it takes the
same pages as it would one after the other; where not even the next one fits, that one alone, as far as the budget goes. Without failures there are at most two waves. Between waves there are two numbers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def running(pages: DataFrame, park: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """``document_id, pages, upto``: documents with the sum of pages up to and including them, in order of ids.

    Documents lie in ranges of ids, sums are taken within each range, and the driver adds up one number for each range.
    """
    counted = pages.groupBy("document_id").agg(F.count("*").alias("pages"))
    ranged = park(counted.repartitionByRange("document_id").withColumn("range", F.spark_partition_id()), "ranges")
    sums = {r["range"]: r["n"] for r in ranged.groupBy("range").agg(F.sum("pages").alias("n")).collect()}
    before, upto = [], 0
    for k in sorted(sums):
        before.append((k, upto))
        upto += sums[k]
    offsets = pages.sparkSession.createDataFrame(before, "range int, before long")
    own = F.sum("pages").over(Window.partitionBy("range").orderBy("document_id"))
    return park(ranged.withColumn("own", own).join(offsets, "range").select("document_id", "pages", (F.col("own") + F.col("before")).alias("upto")), "running")


def spend(pages: DataFrame, budget: int | None, process: Callable[[DataFrame], DataFrame], park: Callable[[DataFrame, str], DataFrame]) -> int | None:
    """Hands pages (``document_id, page_number``, one row a page) to ``process`` in waves until the budget is spent, and returns what is left of it.

    ``process`` returns the ids of the documents that failed (``document_id``). Without a budget there is one wave of all pages.
    """
    if budget is None:
        process(pages)
        return None
    documents = running(pages, park)
    passed, left = 0, budget
    while left > 0:
        rest = documents.where(F.col("upto") > passed)
        wave = rest.where(F.col("upto") <= passed + left)
        last = wave.agg(F.max("upto")).first()[0]
        if last is None:
            following = rest.orderBy("upto").first()
            if following is None:
                break
            order = Window.orderBy("page_number")
            own = pages.where(F.col("document_id") == following["document_id"]).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= left).drop("_n")
            failed = process(own)
            left, passed = left if not failed.isEmpty() else 0, following["upto"]
            continue
        failed = process(pages.join(wave.select("document_id"), "document_id", "left_semi"))
        unspent = wave.join(failed.select("document_id").distinct(), "document_id", "left_semi").agg(F.sum("pages")).first()[0] or 0
        left, passed = left - (last - passed) + unspent, last
    return left
