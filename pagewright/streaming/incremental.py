"""Incremental runs: new files become page evidence batch by batch, each page replacing what it had before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagewright.operators import chunks, elements
from pagewright.sources.store import Table


def index_pages(table: Table, evidence: DataFrame, pages: DataFrame) -> None:
    """Replaces the evidence chunks of exactly the pages that were processed, pages that are now empty included."""
    scope = pages.selectExpr("document_id as source_document_id", "page_number").distinct()
    new = chunks.page_chunks(evidence)
    table.replace(new.withColumns({c: F.lit(None) for c in table.read().columns if c not in new.columns}), ["source_document_id", "page_number"], scope, sort=["source_document_id", "page_number", "ordinal"])


def follow(spark: SparkSession, path: str, schema: str, table: Table, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df, once: bool = True) -> StreamingQuery:
    """Follows a folder of Parquet pages (``document_id, page_number, native_text``) and keeps the chunk table up to date.

    A batch that is run again replaces the same scopes by the same rows, so the sink is idempotent.
    """

    def batch(df: DataFrame, _: int) -> None:
        pages = prepare(df).dropDuplicates(["document_id", "page_number"])
        index_pages(table, elements.native_elements(pages), pages)

    stream = spark.readStream.schema(schema).parquet(path)
    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
