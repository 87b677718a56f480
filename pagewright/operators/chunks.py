"""Knowledge chunks in two tiers, page evidence and products, each with citations and a content-derived id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagewright.functions import text as T

KB_VERSION = "1.1"
#: Fixed value: the first line of an identity chunk.
HEADING = "Industrial catalog product"
IDENTITY = {"manufacturer": "Manufacturer", "part_name": "Part name", "part_number": "Part number", "category": "Category", "description": "Description"}
BOX = "struct<x0:double,y0:double,x1:double,y1:double,coordinate_space:string>"
EVIDENCE = f"struct<source_document_id:string,source_path:string,page_number:int,element_id:string,text:string,confidence:double,bbox:{BOX},method:string>"
VALUE = f"struct<raw:string,normalized:string,confidence:double,normalization_method:string,evidence:array<{EVIDENCE}>>"
PARTS = ("name", "value", "unit", "category", "qualifier")
SPEC = "struct<" + ",".join(f"{c}:{VALUE}" for c in PARTS) + ">"
LISTS = ("specifications", "operating_conditions")
#: Lists of plain values.
TEXTS = ("materials", "certifications", "compatible_parts", "aliases_and_cross_references")
PRODUCT = (
    "record_id string, source_document_id string, source_path string, "
    + ", ".join(f"{c} {VALUE}" for c in IDENTITY)
    + f", specifications array<{SPEC}>, operating_conditions array<{SPEC}>, "
    + ", ".join(f"{c} array<{VALUE}>" for c in TEXTS)
    + f", other_details map<string,{VALUE}>"
)


def values() -> Column:
    """All values of a product that are there, each with its path, in the order of traversal: identity, plain lists, specifications and conditions, details."""
    at = lambda path, v: F.struct(path.alias("path"), v.alias("value"))
    some = lambda c, kind: F.coalesce(F.col(c), F.array().cast(f"array<{kind}>"))
    plain = [F.transform(some(c, VALUE), lambda v, i: at(F.concat(F.lit(f"{c}."), i.cast("string")), v)) for c in TEXTS]  # noqa: B023
    parts = lambda c, s, i: F.array(*[at(F.concat(F.lit(f"{c}."), i.cast("string"), F.lit(f".{p}")), s[p]) for p in PARTS])
    listed = [F.flatten(F.transform(some(c, SPEC), lambda s, i: parts(c, s, i))) for c in LISTS]  # noqa: B023
    details = F.transform(F.map_entries(F.coalesce("other_details", F.create_map().cast(f"map<string,{VALUE}>"))), lambda e: at(F.concat(F.lit("other_details."), e["key"]), e["value"]))
    return F.filter(F.concat(F.array(*[at(F.lit(c), F.col(c)) for c in IDENTITY]), *plain, *listed, details), lambda x: x["value"].isNotNull())


def page_chunks(elements: DataFrame, pipeline_version: str | None = None) -> DataFrame:
    """One chunk per element that is not blank, in order of sequence and id, with ordinals from 0 on each page and one citation."""
    order = Window.partitionBy("document_id", "page_number").orderBy("sequence_number", "element_id")
    path = F.concat(F.lit("pages."), F.col("page_number").cast("string"), F.lit(".elements."), F.col("sequence_number").cast("string"), F.lit(".text"))
    cited = F.struct(F.col("document_id").alias("source_document_id"), "source_path", "page_number", "element_id", F.col("text").alias("excerpt"), "confidence", F.array(path).alias("field_paths"))
    solid = elements.where(T.strip("text") != "").withColumn("ordinal", F.row_number().over(order) - 1)
    parts = [F.lit(KB_VERSION), F.lit("page_evidence"), F.col("document_id"), F.col("page_number").cast("string"), F.col("ordinal").cast("string"), F.col("text"), F.col("element_id"), path, F.lit(pipeline_version or "")]
    named = solid.withColumn("content_sha256", T.prefixed_hash(*parts))
    return named.select(
        F.concat(F.lit("kb_"), F.left("content_sha256", F.lit(32))).alias("chunk_id"), "content_sha256", F.lit("page_evidence").alias("chunk_kind"), F.lit(None).cast("string").alias("product_record_id"),
        F.col("document_id").alias("source_document_id"), "source_path", "page_number", F.lit("page_element").alias("chunk_type"), "ordinal", "text", F.array(cited).alias("citations"),
    )


def mismatches(elements: DataFrame, pages: DataFrame) -> DataFrame:
    """Elements that name a document or page which their extraction does not have."""
    return elements.join(pages.select("document_id", "page_number").distinct(), ["document_id", "page_number"], "left_anti")


def inconsistent(chunks: DataFrame) -> DataFrame:
    """``chunk_id, problem`` of chunks that contradict themselves: kind and type, kind and owner, page, ordinal, text, or a vector that is empty or not finite."""
    page, product = F.col("chunk_kind") == "page_evidence", F.col("chunk_kind") == "product"
    vector = F.col("embedding") if "embedding" in chunks.columns else F.lit(None).cast("array<double>")
    types = F.when(page, F.col("chunk_type") == "page_element").when(product, F.col("chunk_type").isin("identity", "specification", "operating_condition")).otherwise(False)
    rules = {
        "chunk_type": ~types,
        "owner": (page & (F.col("product_record_id").isNotNull() | F.col("source_document_id").isNull())) | (product & F.col("product_record_id").isNull()),
        "page_number": (page & F.coalesce(F.col("page_number") < 1, F.lit(True))) | (product & F.col("page_number").isNotNull()),
        "ordinal": F.coalesce(F.col("ordinal") < 0, F.lit(True)),
        "text": F.coalesce(T.strip("text") == "", F.lit(True)),
        "embedding": F.coalesce((F.size(vector) == 0) | F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False)),
    }
    found = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in rules.items()]))
    return chunks.select("chunk_id", F.explode(found).alias("problem"))


def duplicate_pages(pages: DataFrame) -> DataFrame:
    return pages.groupBy("document_id", "page_number").agg(F.count("*").alias("copies")).where("copies > 1")


def merge_citations(cited: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """One citation per ``key`` and source location; the first one's confidence stays, field paths are a sorted set.

    ``cited`` has the key, ``pos, field_path, source_document_id, source_path, page_number, element_id, text, confidence``.
    """
    place = ["source_document_id", "source_path", "page_number", "element_id", "text"]
    merged = cited.groupBy(*key, *place).agg(F.array_sort(F.collect_set("field_path")).alias("field_paths"), F.min_by("confidence", "pos").alias("confidence"))
    order = Window.partitionBy(*key).orderBy("page_number", F.coalesce("element_id", F.lit("")), "text", "field_paths")
    return merged.withColumn("ordinal", F.row_number().over(order) - 1)


def _shown(v: Column) -> Column:
    return T.display(v["raw"], v["normalized"])


def _cites(field: Column, v: Column) -> Column:
    return F.transform(F.coalesce(v["evidence"], F.array().cast(f"array<{EVIDENCE}>")), lambda e: F.struct(field.alias("field_path"), e.alias("e")))


def _canonical(citations: str) -> Column:
    """Citations as JSON with numbers as ``T.number`` writes them: a quoted number is the only place where those characters stand, as quotes within a text are escaped."""
    told = F.to_json(F.transform(citations, lambda c: c.withField("confidence", T.number(c["confidence"]))))
    return F.regexp_replace(told, r'"confidence":"([^"]*)"', '"confidence":$1')


def product_chunks(products: DataFrame) -> DataFrame:
    """An identity chunk for each product that has an identity value, and one for each specification and operating condition."""
    label = F.concat_ws(" | ", *[F.when(_shown(F.col(c)) != "", _shown(F.col(c))) for c in ("manufacturer", "part_name", "part_number")])
    any_value = F.coalesce(*[F.col(c)["raw"] for c in IDENTITY], *[F.col(c)["normalized"] for c in IDENTITY]).isNotNull()
    lines = F.concat_ws("\n", F.lit(HEADING), *[F.when(_shown(F.col(c)) != "", F.concat(F.lit(f"{name}: "), _shown(F.col(c)))) for c, name in IDENTITY.items()])
    cites = F.concat(*[_cites(F.lit(c), F.col(c)) for c in IDENTITY])
    base = products.withColumns({"identity_text": lines, "label": label, "identity_cites": cites})
    own = ["record_id", "source_document_id", "source_path"]
    identity = base.where(any_value).select(*own, F.lit("identity").alias("chunk_type"), F.lit(0).alias("ordinal"), F.col("identity_text").alias("text"), F.col("identity_cites").alias("cites"))

    def listed(name: str, kind: str, shown: str) -> DataFrame:
        s = F.col("s")
        rows = base.select(*own, "label", "identity_cites", F.posexplode(name).alias("ordinal", "s"))
        line = F.concat(F.lit(f"{shown}: "), _shown(s["name"]), F.lit(" = "), F.concat_ws(" ", *[F.when(_shown(s[c]) != "", _shown(s[c])) for c in ("value", "unit")]))
        text = F.concat_ws(
            "\n", F.concat(F.lit("Product: "), F.col("label")), F.regexp_replace(line, "[ =]+$", ""), *[F.when(_shown(s[c]) != "", F.concat(F.lit(f"{c.title()}: "), _shown(s[c]))) for c in ("category", "qualifier")]
        )
        path = lambda c: F.concat(F.lit(f"{name}."), F.col("ordinal").cast("string"), F.lit(f".{c}"))
        more = [_cites(path(c), s[c]) for c in ("name", "value", "unit", "category", "qualifier")]
        return rows.select(*own, F.lit(kind).alias("chunk_type"), "ordinal", text.alias("text"), F.concat("identity_cites", *more).alias("cites"))

    chunks = identity.unionByName(listed("specifications", "specification", "Specification")).unionByName(listed("operating_conditions", "operating_condition", "Operating condition"))
    key = ("record_id", "chunk_type", "ordinal")
    flat = chunks.select(*key, F.posexplode("cites").alias("pos", "c")).select(*key, "pos", "c.field_path", "c.e.*")
    merged = merge_citations(flat.withColumnRenamed("ordinal", "chunk_ordinal"), ("record_id", "chunk_type", "chunk_ordinal")).withColumnRenamed("ordinal", "n")
    cited = F.struct("n", "source_document_id", "source_path", "page_number", "element_id", F.col("text").alias("excerpt"), "confidence", "field_paths")
    lists = merged.groupBy("record_id", "chunk_type", F.col("chunk_ordinal").alias("ordinal")).agg(F.array_sort(F.collect_list(cited)).alias("cited"))
    found = chunks.drop("cites").join(lists, list(key), "left")
    citations = F.transform(F.coalesce("cited", F.array()), lambda c: F.struct(*[c[x].alias(x) for x in ("source_document_id", "source_path", "page_number", "element_id", "excerpt", "confidence", "field_paths")]))
    found = found.withColumn("citations", F.when(F.col("cited").isNotNull(), citations))
    parts = [F.lit(KB_VERSION), F.col("record_id"), F.col("chunk_type"), F.col("ordinal").cast("string"), F.col("text"), F.coalesce(_canonical("citations"), F.lit("[]"))]
    found = found.withColumn("content_sha256", T.prefixed_hash(*parts))
    return found.select(
        F.concat(F.lit("kb_"), F.left("content_sha256", F.lit(32))).alias("chunk_id"), "content_sha256", F.lit("product").alias("chunk_kind"), F.col("record_id").alias("product_record_id"), "source_document_id",
        "source_path", F.lit(None).cast("int").alias("page_number"), "chunk_type", "ordinal", "text", "citations",
    )
