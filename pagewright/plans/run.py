"""A run: pages become evidence and chunks, then guarded, hydrated, normalised and validated products, all as tables below one folder.

Tier one (page evidence) is stored before any product is admitted. What fails is a row of the result, and the run goes on.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import replace
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagewright.operators import catalog, chunks, elements, extraction, guard, hints, hydrate, ops, rules
from pagewright.plans import budget, calls, models
from pagewright.plans.config import Config
from pagewright.sources.store import Table, try_append, write_json

ELEMENT = (
    "element_id string, document_id string, page_number int, sequence_number int, element_type string, text string, extraction_method string, "
    "bbox struct<x0:double,y0:double,x1:double,y1:double,coordinate_space:string>, confidence double, model string, source_path string, raw_payload string, metadata map<string,string>"
)
CITATION = "struct<source_document_id:string,source_path:string,page_number:int,element_id:string,excerpt:string,confidence:double,field_paths:array<string>>"
CITED = f"source_document_id string, source_path string, page_number int, element_id string, text string, confidence double, bbox {chunks.BOX}, method string"
TABLES = {
    "documents": "document_id string, source_path string, pages long, page_errors long, status string, finished_at timestamp, elapsed_seconds double",
    "extractions": "document_id string, page_number int, fingerprint string, route string, requires_ocr boolean, reasons array<string>, routing string",
    "page_errors": "document_id string, page_number int, error string",
    "page_audits": extraction.AUDIT,
    "elements": ELEMENT,
    "knowledge_chunks": f"chunk_id string, content_sha256 string, chunk_kind string, product_record_id string, source_document_id string, source_path string, page_number int, chunk_type string, ordinal int, text string, citations array<{CITATION}>, embedding array<double>",
    "products": chunks.PRODUCT + ", record_confidence double, issues array<struct<code:string,path:string,severity:string>>, validation_warnings array<string>, review_status string, batch_id string, ordinal int, payload string",
    "product_specifications": "record_id string, collection_name string, ordinal int, name_raw string, name_normalized string, value_raw string, value_normalized string, unit_raw string, unit_normalized string",
    "product_evidence": f"product_record_id string, field_path string, ordinal int, {CITED}",
    "ingestion_batches": "batch_id string, document_id string, chunk long, audit string, accepted_count long, rejected_count long, status string, issues array<string>",
    "batch_products": "batch_id string, ordinal int, product_record_id string",
    "failed_chunks": "document_id string, chunk long, stage string, error string, audit string",
    "rejected_products": "rejection_id string, batch_id string, ordinal int, payload string, issues array<struct<code:string,path:string,severity:string>>",
}
#: What each table's buckets go by.
KEYS = {
    "documents": ["document_id"], "extractions": ["document_id", "page_number"], "page_errors": ["document_id", "page_number"], "page_audits": ["document_id", "page_number"], "elements": ["document_id", "page_number"],
    "knowledge_chunks": ["source_document_id"], "products": ["record_id"], "product_specifications": ["record_id"], "product_evidence": ["product_record_id"], "ingestion_batches": ["batch_id"],
    "batch_products": ["batch_id"], "failed_chunks": ["document_id"], "rejected_products": ["rejection_id"],
}
#: Steps from earlier forms of tables. The first one of chunks had neither a kind nor a page of its own.
UPGRADES = {"knowledge_chunks": [{"chunk_kind": "case when product_record_id is null then 'page_evidence' else 'product' end", "page_number": "case when product_record_id is null then citations[0].page_number end"}]}
CHUNK = ("document_id", "chunk")


class RunFailed(RuntimeError):
    pass


def tables(spark: SparkSession, root: str, buckets: int = 64) -> dict[str, Table]:
    return {name: Table(spark, f"{root}/{name}", schema, KEYS[name], buckets, UPGRADES.get(name, ())) for name, schema in TABLES.items()}


def limited(pages: DataFrame, config: Config) -> DataFrame:
    """The pages that the limits of documents let through: the first documents by id, and the first pages of each. What all may take together is in ``budget``."""
    limits = config.limits
    if limits.documents is not None:
        first = pages.select("document_id").distinct().orderBy("document_id").limit(limits.documents)
        pages = pages.join(first, "document_id", "left_semi")
    if limits.pages_per_document is not None:
        n = F.row_number().over(Window.partitionBy("document_id").orderBy("page_number"))
        pages = pages.withColumn("_n", n).where(F.col("_n") <= limits.pages_per_document).drop("_n")
    return pages


def parked(spark: SparkSession, root: str) -> Callable[[DataFrame, str], DataFrame]:
    """Writes a frame below the run's folder and reads it back, so that what it took (model calls included) is done once."""

    def park(rows: DataFrame, name: str) -> DataFrame:
        table = Table(spark, f"{root}/_{name}", rows.schema)
        found = table.read(table.write(rows))
        table.expire()
        return found

    return park


def admit(
    found: DataFrame, pages: DataFrame, config: Config, structured: Callable[[], models.StructuredModel], park: Callable[[DataFrame, str], DataFrame], blank: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Products of chunks of pages: hinted, generated, guarded, hydrated, normalised, validated, and split into accepted and rejected.

    Chunks of which all pages are certainly blank (``blank``) are skipped.
    """
    placed = ops.page_chunks(pages.select("document_id", "page_number").distinct(), config.pages_per_parse, ["document_id"], ["page_number"])
    own = found.join(placed, ["document_id", "page_number"])
    if blank is not None:
        own = own.join(extraction.blank_chunks(placed, blank), list(CHUNK), "left_anti")
    hint = park(hints.source_hints(own, CHUNK), "hints")
    answers = park(models.generate(hint, structured, CHUNK, evidence=own), "structured")
    judged = park(guard.enforce(answers.where("payload is not null").select(*CHUNK, "payload"), hint.drop("error"), own, CHUNK), "guarded")
    guarded = judged.where("error is null")
    # What fails in a chunk, and in which step, is a row; the other chunks go on.
    step = F.when(F.col("error").startswith("hints:"), "hints").otherwise("generation")
    failed = answers.where("payload is null").select(*CHUNK, step.alias("stage"), "error", "audit").unionByName(judged.where("error is not null").select(*CHUNK, F.lit("guard").alias("stage"), "error", "audit"))
    name = catalog.batch_id(F.col("document_id"), F.col("chunk").cast("string"), F.lit(elements.PIPELINE_VERSION), F.coalesce("guarded", F.lit("")))
    batches = park(guarded.select(name.alias("batch_id"), "document_id", "chunk", "audit", "guarded"), "batches")
    done = hydrate.hydrate(batches.select("document_id", F.col("batch_id").alias("batch"), F.col("guarded").alias("payload")), found).where("ordinal >= 0")
    early = F.transform("issues", lambda i: F.struct(i["code"].alias("code"), i["path"].alias("path"), i["severity"].alias("severity")))
    typed = done.withColumn("p", F.from_json("payload", chunks.PRODUCT)).select(
        "batch", "ordinal", "payload", early.alias("early"),
        catalog.record_id(F.col("document_id"), F.col("ordinal"), F.col("payload")).alias("record_id"), F.col("document_id").alias("source_document_id"), *[F.col(f"p.{c}").alias(c) for c in _fields() if c not in ("record_id", "source_document_id")],
    )
    checked = rules.validate(rules.normalize(typed), config.strict, config.mode == "live", config.low_confidence)
    checked = rules.reviewed(checked.withColumn("issues", F.concat("early", "issues")))
    checked = checked.withColumn("accepted", ~F.exists("issues", lambda i: i["severity"] == "error")).withColumnRenamed("batch", "batch_id")
    split = catalog.persist_batch(park(checked, "products"), batches.drop("guarded"))
    good = split["products"].drop("early")
    children = {"product_specifications": catalog.specifications(good), "product_evidence": catalog.evidence(good), "product_chunks": chunks.product_chunks(good)}
    return split | {"products": good} | children | {"failed": park(failed, "failed")}


def _fields() -> list[str]:
    from pyspark.sql import types

    return [f.name for f in types._parse_datatype_string(chunks.PRODUCT)]


def run(
    spark: SparkSession, pages: DataFrame, root: str, config: Config = Config(), page_model: Callable[[], models.PageModel] | None = None,
    structured: Callable[[], models.StructuredModel] | None = None, ocr_model: Callable[[], models.PageModel] | None = None, embedding: Callable[[], models.EmbeddingModel] | None = None,
) -> DataFrame:
    """Runs over pages (``document_id, page_number, native_text`` and whatever else of ``readers.PAGE_ROW``) and returns the summary row.

    Models that are not given are those of the configuration (``models.clients``). OCR takes part where there is a model for it. With ``fail_fast`` the first step with
    a failed page ends the run, when what went well has been stored. A budget of pages is spent by what its documents come to, so documents are processed in waves.

    Where the configuration asks for it, answers of models are written down as they come (``calls``) until the run's tables hold them.
    """
    began = time.time()
    made = models.clients(config)
    page_model, structured, ocr_model, embedding = page_model or made.page, structured or made.structured, ocr_model or made.ocr, embedding or made.embedding
    journal = f"{root}/_calls"
    if config.journal:
        page_model, structured, embedding = (calls.remembered(m, journal) for m in (page_model, structured, embedding))
        ocr_model = calls.remembered(ocr_model, journal) if ocr_model is not None else None
    store = tables(spark, root, config.buckets)
    pages = limited(pages, config)
    # What its source could not read has an error already; a file without pages stands as page 0.
    read = pages.withColumns({"page_number": F.coalesce("page_number", F.lit(0)), "error": F.col("error") if "error" in pages.columns else F.lit(None).cast("string")})
    unread = read.where("error is not null").select("document_id", "page_number", "error")
    every, pages = read.drop("error"), read.where("error is null").drop("error")
    twice = chunks.duplicate_pages(pages).first()
    if twice is not None:
        raise ValueError(f"page {twice['page_number']} of {twice['document_id']} is there more than once")
    scope = ["document_id", "page_number"]
    thresholds = config.routing
    if ocr_model is None:
        thresholds = replace(thresholds, verify_vision=False, verify_native=False)

    # Models must not be called again by what follows: their results are written first.
    park = parked(spark, root)
    hits = 0
    whole_run = config.limits.pages is None
    owners = every.select(*scope).limit(0)

    def extracted(taken: DataFrame) -> DataFrame:
        """Extracts and stores some pages; the documents of which every page has failed."""
        nonlocal hits, owners
        own = park(taken, "wave")
        owners = own if whole_run else park(owners.unionByName(own), "scope")
        # Without a budget there is one wave, and no page has to be joined.
        got = extraction.extract(pages if whole_run else pages.join(own, scope, "left_semi"), store["extractions"].scoped(own, scope), thresholds, page_model, ocr_model, park)
        hits += got.held.count()
        done = got.extractions.select(*scope)
        for name, rows in (("elements", got.elements), ("page_audits", got.audits), ("extractions", got.extractions)):
            store[name].replace(rows, scope, done, sort=scope)
        errors = got.errors.unionByName(unread if whole_run else unread.join(own, scope, "left_semi"))
        store["page_errors"].replace(errors, scope, own)
        evidence = _embedded(chunks.page_chunks(got.elements), config, embedding, park)
        scoped = done.select(F.col("document_id").alias("source_document_id"), "page_number").distinct()
        store["knowledge_chunks"].replace(evidence, ["source_document_id", "page_number"], scoped, sort=["chunk_kind", "source_document_id", "page_number"])
        bad = errors.select(*scope).distinct().groupBy("document_id").agg(F.count("*").alias("bad"))
        return own.groupBy("document_id").agg(F.count("*").alias("all")).join(bad, "document_id").where("bad = all").select("document_id")

    budget.spend(every.select(*scope).distinct(), config.limits.pages, extracted, park)
    every = every if whole_run else every.join(owners, scope, "left_semi")
    errors = store["page_errors"].scoped(owners, scope)
    if config.fail_fast and not errors.isEmpty():
        first = errors.orderBy(*scope).first()
        raise RunFailed(f"page {first['page_number']} of {first['document_id']}: {first['error']}")

    whole = store["elements"].scoped(owners, scope)
    blank = extraction.certified_blank(store["extractions"].scoped(owners, scope), whole, store["page_audits"].scoped(owners, scope))
    admitted = admit(whole, owners, config, structured, park, blank)
    names = {"ingestion_batches": ["batch_id"], "products": ["record_id"], "batch_products": ["batch_id", "ordinal", "product_record_id"], "rejected_products": ["rejection_id"]}
    for name, key in names.items():
        store[name].replace(admitted[name], key)
    for name, owner in (("product_specifications", "record_id"), ("product_evidence", "product_record_id")):
        store[name].replace(admitted[name], [owner], admitted["products"].select(F.col("record_id").alias(owner)), sort=[owner])
    store["failed_chunks"].replace(admitted["failed"], ["document_id"], owners.select("document_id").distinct())
    products = _embedded(admitted["product_chunks"], config, embedding, park)
    store["knowledge_chunks"].replace(products, ["source_document_id", "product_record_id"], sort=["chunk_kind", "source_document_id", "page_number"])

    issues = try_append(admitted["products"], f"{root}/products.jsonl", "products_jsonl_write_failed") + try_append(admitted["ingestion_batches"], f"{root}/batches.jsonl", "batch_jsonl_write_failed")

    failed = admitted["failed"].groupBy("document_id").agg(F.count("*").alias("failed_chunks"))
    bad = store["page_errors"].scoped(owners, scope).groupBy("document_id").agg(F.count("*").alias("page_errors"))
    source = F.max("source_path") if "source_path" in every.columns else F.max(F.lit(None).cast("string"))
    by_document = every.groupBy("document_id").agg(F.count_distinct("page_number").alias("pages"), source.alias("source_path")).join(bad, "document_id", "left").join(failed, "document_id", "left")
    status = store["ingestion_batches"].read().groupBy("document_id").agg(F.max(F.when(F.col("status") != "succeeded", 1).otherwise(0)).alias("odd"))
    told = by_document.join(status, "document_id", "left").fillna(0, ["page_errors", "failed_chunks"])
    odd = (F.col("page_errors") > 0) | (F.col("odd") == 1) | (F.col("failed_chunks") > 0)
    told = told.withColumns({"status": F.when(F.col("page_errors") == F.col("pages"), "failed").when(odd, "review").otherwise("succeeded"), "finished_at": F.current_timestamp(), "elapsed_seconds": F.lit(time.time() - began)})
    documents = park(told.select(*store["documents"].read().columns), "documents")
    store["documents"].replace(documents, ["document_id"])
    summary = ops.run_summary(documents, "status", {"pages": "pages", "page_errors": "page_errors"})
    totals = {
        "elements": whole.count(), "products": store["products"].read().count(), "rejected": store["rejected_products"].read().count(), "chunks": store["knowledge_chunks"].read().count(),
        "needs_review": store["products"].read().where("review_status = 'needs_review'").count(), "ocr_pages": store["extractions"].scoped(owners, scope).where("requires_ocr").count(),
        "blank_pages": blank.join(owners, scope, "left_semi").count(), "checkpoint_hits": hits,
    }
    told = summary.withColumns({k: F.lit(v) for k, v in totals.items()})
    for table in store.values():
        table.expire(config.versions)
    if config.journal:
        calls.forget(journal)
    write_json(spark, f"{root}/summary.json", told.first().asDict() | {"finished_at": datetime.now(UTC).isoformat(), "elapsed_seconds": round(time.time() - began, 3), "issues": issues})
    return told


def _embedded(rows: DataFrame, config: Config, embedding: Callable[[], models.EmbeddingModel], park: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Chunks with their vectors, so that queries need not make them; written once, as what replaces a scope reads its rows more than once."""
    return park(models.embed(rows, embedding), "embedded") if config.embed else rows.withColumn("embedding", F.lit(None).cast("array<double>"))
