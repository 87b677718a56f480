"""Extraction of pages: blank ones, native text, pages that a model reads, their fallback, and OCR beside them.

Pages are split by their route, each part is processed, and the parts are put together. A page's elements come from exactly one of native text, model or fallback;
those of OCR follow with sequence numbers after them. A page of which a needed model call fails has an error and no elements, and is never taken for done.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.operators import elements, routing
from pagewright.plans import models

PAGE = ["document_id", "page_number"]
#: What an audit says of a blank page and of a fallback.
BLANK = {"audit_type": "page_extraction", "event": "deterministic_blank_page", "outcome": "empty_page_extraction"}
FALLBACK = {"audit_type": "page_extraction_fallback", "event": "vlm_unsupported_content_native_fallback", "outcome": "fallback_succeeded"}
ANSWERED = {"audit_type": "model_response", "event": "answered", "outcome": "ok"}
FALLBACK_METADATA = {"vlm_fallback": "true", "vlm_failure_kind": "unsupported_assistant_content"}
AUDIT = "document_id string, page_number int, audit_type string, event string, outcome string, routing string, detail string"


@dataclass(frozen=True)
class Extracted:
    """``extractions`` and ``elements`` of pages that went well, ``errors`` of the others, ``audits``, and earlier extractions that still hold."""

    extractions: DataFrame
    elements: DataFrame
    errors: DataFrame
    audits: DataFrame
    held: DataFrame


def _audit(rows: DataFrame, kind: dict[str, str], detail: Column) -> DataFrame:
    return rows.select(*PAGE, *[F.lit(v).alias(k) for k, v in kind.items()], F.to_json("routing").alias("routing"), detail.cast("string").alias("detail"))


def extract(
    pages: DataFrame, earlier: DataFrame, thresholds: routing.Thresholds, page_model: Callable[[], models.PageModel], ocr_model: Callable[[], models.PageModel] | None,
    park: Callable[[DataFrame, str], DataFrame],
) -> Extracted:
    """Extracts the pages that have no earlier extraction of their present content. ``park`` writes a frame once, so that models are called once."""
    routed = elements.fingerprint(routing.route_pages(pages, thresholds, identifiers=False))
    todo, held = elements.pending(routed, earlier)
    todo = todo.withColumn("blank", routing.is_blank(todo) if "inventory" in todo.columns else F.lit(False))
    todo = park(todo, "pages")
    blank, rest = todo.where("blank"), todo.where("not blank")
    route = F.col("routing.route")
    native, vision = rest.where(route == routing.NATIVE), rest.where(route == routing.VISION)
    read = park(models.read_pages(vision, page_model), "answers")
    failed, good = read.where("error is not null"), read.where("error is null")
    # Only an answer that can never be used, and text that is good apart from its layout, allow for the native text.
    saved = vision.join(failed.where("unsupported").select(*PAGE, F.col("error").alias("why")), PAGE).where(elements.meaningful_native(vision, thresholds))
    told = F.create_map(*[F.lit(x) for pair in FALLBACK_METADATA.items() for x in pair])
    fallback = elements.native_elements(saved).withColumn("metadata", F.map_concat("metadata", told))
    base = elements.native_elements(native).unionByName(elements.response_elements(good)).unionByName(fallback)
    errors = failed.join(saved, PAGE, "left_anti").select(*PAGE, "error")
    audits = _audit(blank, BLANK, F.lit(None)).unionByName(_audit(saved, FALLBACK, F.col("why"))).unionByName(_audit(vision.join(good.select(*PAGE, "attempts"), PAGE), ANSWERED, F.col("attempts")))
    found = base
    if ocr_model is not None:
        verified = park(models.read_pages(rest.where("routing.requires_ocr").join(errors, PAGE, "left_anti"), ocr_model), "ocr")
        before = base.groupBy(*PAGE).agg(F.count("*").cast("int").alias("after"))
        more = elements.response_elements(verified.where("error is null").join(before, PAGE, "left"), "ocr_verification")
        errors = errors.unionByName(verified.where("error is not null").select(*PAGE, "error"))
        audits = audits.unionByName(_audit(rest.join(verified.where("error is null").select(*PAGE, "attempts"), PAGE), ANSWERED | {"event": "ocr_answered"}, F.col("attempts")))
        found = base.unionByName(more)
    errors = park(errors, "errors")
    done = todo.join(errors, PAGE, "left_anti")
    extractions = done.select(*PAGE, "fingerprint", route.alias("route"), F.col("routing.requires_ocr").alias("requires_ocr"), F.col("routing.reasons").alias("reasons"), F.to_json("routing").alias("routing"))
    return Extracted(park(extractions, "extractions"), park(found.join(errors, PAGE, "left_anti"), "elements"), errors, park(audits.join(errors, PAGE, "left_anti"), "audits"), held)


def certified_blank(extractions: DataFrame, found: DataFrame, audits: DataFrame) -> DataFrame:
    """Pages that are blank beyond doubt: no element, and exactly one audit, which is the one that a blank page gets, with the page's own routing."""
    one = audits.groupBy(*PAGE).agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in (*BLANK, "routing")])
    same = F.lit(True)
    for k, v in BLANK.items():
        same = same & (F.col(k) == v)
    fits = one.where((F.col("n") == 1) & same).select(*PAGE, "routing")
    return extractions.join(found.select(*PAGE).distinct(), PAGE, "left_anti").join(fits, [*PAGE, "routing"], "left_semi").select(*PAGE)


def blank_chunks(placed: DataFrame, blank: DataFrame, chunk: tuple[str, ...] = ("document_id", "chunk")) -> DataFrame:
    """Chunks of pages (``placed`` has their pages) of which every page is certainly blank."""
    known = placed.join(blank.select(*PAGE).distinct().withColumn("is_blank", F.lit(True)), PAGE, "left")
    return known.groupBy(*chunk).agg(F.bool_and(F.coalesce("is_blank", F.lit(False))).alias("all")).where("all").drop("all")
