"""Reads over the chunk store: filtered scans, substring search and exact cosine top-k; citations join the winners only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions import text as T

ORDER = ["chunk_kind", "source_document_id", "page_number", "product_record_id", "chunk_type", "ordinal", "chunk_id"]


def _limited(n: int, least: int = 1) -> int:
    if n < least:
        raise ValueError(f"limit must be at least {least}")
    return n


def get_chunks(chunks: DataFrame, *, product_record_id: str | None = None, chunk_kind: str | None = None, source_document_id: str | None = None, page_number: int | None = None) -> DataFrame:
    """Chunks that meet all the given conditions, in store order; a product implies the product tier."""
    if page_number is not None and page_number < 1:
        raise ValueError("pages count from 1")
    kind = "product" if product_record_id is not None else chunk_kind
    for name, value in (("product_record_id", product_record_id), ("chunk_kind", kind), ("source_document_id", source_document_id), ("page_number", page_number)):
        if value is not None:
            chunks = chunks.where(F.col(name) == value)
    return chunks.orderBy(*[F.col(c).asc_nulls_first() for c in ORDER])


def search_text(rows: DataFrame, query: str, limit: int = 20, text_col: str = "text", order: list[str] | None = None, chunk_kind: str | None = None) -> DataFrame:
    """The first rows whose text contains the query without ASCII case; an empty query matches everything."""
    if chunk_kind is not None:
        rows = rows.where(F.col("chunk_kind") == chunk_kind)
    return rows.where(T.contains_folded(text_col, query)).orderBy(*[F.col(c).asc_nulls_first() for c in order or ORDER]).limit(_limited(limit))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def scored(rows: DataFrame, query: list[float], vector_col: str = "embedding") -> DataFrame:
    """Adds the cosine ``score``; vectors of another length, without length or missing are left out."""
    length = math.sqrt(sum(x * x for x in query))
    if not query or not math.isfinite(length) or length == 0:
        raise ValueError("a query vector is finite and not zero")
    v, q = F.col(vector_col), F.from_json(F.lit(str([float(x) for x in query])), "array<double>")
    own = norm(v)
    return rows.where(v.isNotNull() & (F.size(v) == len(query))).withColumn("norm", own).where("norm > 0").withColumn("score", dot(v, q) / (F.col("norm") * length)).drop("norm")


def similar(rows: DataFrame, query: list[float], limit: int = 10, id_col: str = "chunk_id", vector_col: str = "embedding", chunk_kind: str | None = None) -> DataFrame:
    """The rows most like the query by exact cosine; ties by id."""
    if chunk_kind is not None:
        rows = rows.where(F.col("chunk_kind") == chunk_kind)
    return scored(rows, query, vector_col).drop(vector_col).orderBy(F.desc("score"), id_col).limit(_limited(limit))


def with_citations(winners: DataFrame, citations: DataFrame) -> DataFrame:
    """Joins citations (``chunk_id, ordinal, ...``) to the rows of a search, after its limit."""
    own = [c for c in citations.columns if c != "chunk_id"]
    # The winners are at most as many as the search's limit, so that side may be sent to every task.
    found = citations.join(F.broadcast(winners.select("chunk_id")), "chunk_id", "left_semi")
    nested = found.groupBy("chunk_id").agg(F.array_sort(F.collect_list(F.struct("ordinal", *[c for c in own if c != "ordinal"]))).alias("citations"))
    return winners.join(nested, "chunk_id", "left")
