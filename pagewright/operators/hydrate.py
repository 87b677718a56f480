"""Evidence hydration: references in a model's products become canonical evidence of the elements they name.

References are rows. A walk over each answer tells what it refers to, in order; the rows are joined to the elements by id, and what that leaves open by page and text; a second walk over the answer, the same as
the first, gets what each reference has found. So a task holds one answer with the elements that it cites, and never a document's.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagewright.functions.untrusted import NotJson, loads

LIMITS = {"specifications": 48, "other_details": 24}
PRODUCT_LIMIT = 32


def resolve(refs: DataFrame, elements: DataFrame, document_col: str = "document_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """References (``ref_id, document_id, element_id, page_number, text``) with the element each resolves to and how.

    By id first; else by page and exact text within the document, where exactly one element fits. ``resolution`` is ``by_id``, ``by_text``,
    ``cross_document`` or ``unknown``. Of elements with one id the last counts, by page and sequence where they have these; every reference stays one row. With ``carry`` these columns of the element
    that was found, one of another document included, come along as the struct ``element``. Both joins are by keys that spread a document's references over all tasks; a reference without an id goes by its own.
    """
    order = [F.desc_nulls_last(c) for c in ("page_number", "sequence_number", "text") if c in elements.columns]
    last = Window.partitionBy("element_id").orderBy(*order)
    elements = elements.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")
    whole = [F.struct(*carry).alias("e_row")] if carry else []
    e = elements.select(F.col("element_id").alias("e_id"), F.col("document_id").alias("e_document"), F.col("page_number").alias("e_page"), F.coalesce("text", F.lit("")).alias("e_text"), *whole)
    named = refs.withColumn("_named", F.coalesce("element_id", F.concat(F.lit("\0"), F.col("ref_id").cast("string"))))
    by_id = named.join(e, F.col("_named") == F.col("e_id"), "left")
    first = [F.first("e_row").alias("t_row")] if carry else []
    only = e.groupBy("e_document", "e_page", "e_text").agg(F.count("*").alias("n"), F.min("e_id").alias("t_id"), *first).where("n = 1").drop("n")
    open_text = F.when(F.col("e_id").isNull(), F.col("text")).otherwise(F.concat(F.lit("\0"), F.col("_named")))
    both = by_id.withColumn("_text", open_text).join(
        only.select(F.col("e_document").alias("t_document"), F.col("e_page").alias("t_page"), F.col("e_text").alias("t_text"), "t_id", *(["t_row"] if carry else [])),
        F.col("e_id").isNull() & (F.col(document_col) == F.col("t_document")) & (F.col("page_number") == F.col("t_page")) & (F.col("_text") == F.col("t_text")), "left",
    )
    how = (
        F.when(F.col("e_id").isNotNull() & (F.col("e_document") != F.col(document_col)), "cross_document")
        .when(F.col("e_id").isNotNull(), "by_id").when(F.col("t_id").isNotNull(), "by_text").otherwise("unknown")
    )
    resolved = F.when(how.isin("by_id", "by_text"), F.coalesce("e_id", "t_id"))
    rows = [F.coalesce("e_row", "t_row").alias("element")] if carry else []
    return both.select(*refs.columns, resolved.alias("resolved_id"), how.alias("resolution"), *rows)


def _issue(code: str, path: str, severity: str, message: str) -> dict:
    return {"code": code, "path": path, "severity": severity, "message": message}


#: Finds an element by a reference's id, page and text.
Find = Callable[[str | None, int | None, str], dict | None]


def index(document: str, elements: list[dict]) -> Find:
    """Finds among elements in memory: by id, else by page and text if exactly one of the document fits."""
    by_id = {e["element_id"]: e for e in elements}
    by_place: dict[tuple, list[dict]] = {}
    for e in by_id.values():
        if e.get("document_id") in (None, document):
            by_place.setdefault((e.get("page_number"), e.get("text") or ""), []).append(e)

    def find(name: str | None, page: int | None, text: str) -> dict | None:
        fits = by_place.get((page, text), []) if page is not None else []
        return by_id.get(name) or (fits[0] if len(fits) == 1 else None)

    return find


class Hydrator:
    """Hydrates products of one document. ``find`` is asked once for every reference, in order; None means that no source was supplied."""

    def __init__(self, document: str, find: Find | None, source_path: str | None = None):
        self.document, self.supplied, self.source_path = document, find is not None, source_path
        self.find = find or (lambda name, page, text: None)

    def product(self, payload: dict) -> tuple[dict, list[dict]]:
        self.issues: list[dict] = []
        for name, most in LIMITS.items():
            if isinstance(payload.get(name), list) and len(payload[name]) >= most:
                self._tell("wire_collection_limit_reached", name, "warning", f"{name} has as many entries as a model may give ({most})")
        out = self._visit(payload, ())
        if isinstance(out.get("other_details"), list):
            out["other_details"] = self._details(out["other_details"])
        elif out.get("other_details") is not None and not isinstance(out["other_details"], dict):
            self._tell("invalid_other_details_collection", "other_details", "error", "details are a list of names and values")
            out["other_details"] = {}
        out["source_document_id"] = self.document
        if self.source_path is not None:
            out["source_path"] = self.source_path
        return out, self.issues

    def _tell(self, *issue: str) -> None:
        self.issues.append(_issue(*issue))

    def _visit(self, value, path: tuple):
        if isinstance(value, list):
            return [self._visit(x, (*path, str(i))) for i, x in enumerate(value)]
        if not isinstance(value, dict):
            return value
        out = {str(k): self._visit(x, (*path, str(k))) for k, x in value.items() if k != "evidence"}
        if "evidence" in value:
            here = ".".join((*path, "evidence"))
            if isinstance(value["evidence"], list):
                found = (self._reference(x, f"{here}.{i}") for i, x in enumerate(value["evidence"]))
                out["evidence"] = [x for x in found if x is not None]
            else:
                self._tell("invalid_evidence_collection", here, "error", "evidence is a list")
                out["evidence"] = []
        return out

    def _reference(self, ref, path: str) -> dict | None:
        if isinstance(ref, str):
            ref = {"element_id": ref}
        if not isinstance(ref, dict):
            self._tell("invalid_evidence_reference", path, "error", "evidence is an element's id or an object")
            return None
        name = None if ref.get("element_id") is None else str(ref["element_id"])
        try:
            page = int(ref.get("page_number"))
        except (OverflowError, TypeError, ValueError):
            page = None
        element = self.find(name, page, str(ref.get("text") or ref.get("excerpt") or ""))
        return self._given(ref, name, path) if element is None else self._canonical(ref, element, path)

    def _canonical(self, ref: dict, e: dict, path: str) -> dict | None:
        own = e.get("document_id")
        if own is not None and own != self.document:
            self._tell("cross_document_evidence", path, "error", f"{e['element_id']} belongs to {own}")
            return None
        same = {"page_number": "page_number", "text": "text", "excerpt": "text", "document_id": "document_id", "source_document_id": "document_id", "method": "extraction_method", "extraction_method": "extraction_method"}
        for claim, truth in same.items():
            if ref.get(claim) is not None and e.get(truth) is not None and str(ref[claim]) != str(e[truth]):
                self._tell("evidence_claim_mismatch", path, "warning", f"the claimed {claim} differs from {e['element_id']}, whose value holds")
        if not e.get("text") or not isinstance(e.get("page_number"), int) or e["page_number"] < 1:
            self._tell("invalid_source_evidence", path, "error", f"{e['element_id']} has no page or text")
            return None
        found = {"source_document_id": self.document, "source_path": e.get("source_path") or self.source_path, "page_number": e["page_number"], "element_id": e["element_id"], "text": e["text"],
                 "bbox": e.get("bbox"), "confidence": e.get("confidence"), "method": e.get("extraction_method")}
        return {k: v for k, v in found.items() if v is not None}

    def _given(self, ref: dict, name: str | None, path: str) -> dict | None:
        text, page = ref.get("text") or ref.get("excerpt"), ref.get("page_number")
        whole = isinstance(text, str) and bool(text.strip()) and isinstance(page, int) and page >= 1
        if not whole:
            self._tell("unknown_evidence_reference", path, "error", f"there is no element {name!r}, and the object is incomplete")
            return None
        if self.supplied:
            self._tell("unknown_evidence_reference", path, "error", f"there is no element {name!r} in the source")
        else:
            self._tell("unverified_evidence", path, "warning", "a complete object was taken without a source")
        found = {"source_document_id": self.document, "source_path": self.source_path, "page_number": page, "element_id": name, "text": text, "confidence": ref.get("confidence"), "method": ref.get("method")}
        return {k: v for k, v in found.items() if v is not None}

    def _details(self, details: list) -> dict:
        out, seen = {}, {}
        for i, d in enumerate(details):
            path = f"other_details.{i}"
            name, value = (d.get("name"), d.get("value")) if isinstance(d, dict) else (None, None)
            if not isinstance(name, dict) or not isinstance(value, dict):
                self._tell("invalid_other_detail", path, "error", "a detail has a name and a value, both objects")
                continue
            shown = name.get("normalized") if name.get("normalized") is not None else name.get("raw")
            if not isinstance(shown, str) or not shown.strip():
                self._tell("invalid_other_detail_name", f"{path}.name", "error", "a detail's name is blank")
                continue
            base = re.sub(r"\s+", " ", unicodedata.normalize("NFKC", shown)).strip()
            seen[base] = n = seen.get(base, 0) + 1
            key = base if n == 1 else f"{base} ({n})"
            if n > 1:
                self._tell("duplicate_other_detail_name", path, "warning", f"{base!r} is there again, kept as {key!r}")
            both = [*(name.get("evidence") or []), *(value.get("evidence") or [])]
            out[key] = value | {"evidence": _distinct(both)}
        return out


def _distinct(items: list) -> list:
    seen: dict[str, object] = {}
    for x in items:
        seen.setdefault(json.dumps(x, sort_keys=True, ensure_ascii=False), x)
    return list(seen.values())


def product_entries(data) -> tuple[list, list[dict]]:
    """The products of a model's answer: an envelope, a bare list or a single product, with issues about its shape."""
    if isinstance(data, dict) and isinstance(data.get("products"), list):
        found, issues = data["products"], []
    elif isinstance(data, list):
        found, issues = data, [_issue("unversioned_product_array", "", "warning", "products without an envelope")]
    elif isinstance(data, dict) and {"part_name", "part_number", "manufacturer"} & set(data):
        found, issues = [data], [_issue("single_product_envelope", "", "warning", "one product without an envelope")]
    else:
        return [], [_issue("invalid_product_batch", "", "error", "there is no list of products")]
    if len(found) >= PRODUCT_LIMIT:
        issues.append(_issue("wire_product_limit_reached", "products", "warning", f"as many products as a model may give ({PRODUCT_LIMIT})"))
    return found, issues


OUT = "document_id string, batch string, ordinal int, payload string, issues array<struct<code:string,path:string,severity:string,message:string>>"
#: What evidence takes over from its element.
CARRIED = ("element_id", "document_id", "page_number", "text", "extraction_method", "confidence", "bbox", "source_path")
_REFS = "document_id string, batch string, ordinal int, place int, element_id string, page_number long, text string"


def _entries(payload) -> tuple[list, list[dict]]:
    """The products of an answer as text, and issues about its shape."""
    try:
        return product_entries(loads(payload))
    except (NotJson, TypeError):
        return product_entries(None)


def references(answers: DataFrame) -> DataFrame:
    """What the products of answers (``document_id, batch, payload``) refer to: one row for each reference, by the product's ``ordinal`` and the reference's ``place`` in the walk."""

    def told(frames):
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                for ordinal, p in enumerate(_entries(row["payload"])[0]):
                    seen: list[tuple] = []
                    try:
                        Hydrator(row["document_id"], lambda *ref, seen=seen: seen.append(ref)).product(p)
                    except Exception:  # noqa: BLE001, S110  the second walk meets it again and tells
                        pass
                    out += [(row["document_id"], row["batch"], ordinal, k, name, page if page is None or abs(page) < 1 << 62 else None, text) for k, (name, page, text) in enumerate(seen)]
            yield pd.DataFrame(out, columns=["document_id", "batch", "ordinal", "place", "element_id", "page_number", "text"]).astype({"page_number": "Int64"})

    return answers.mapInPandas(told, _REFS)


def hydrate(batches: DataFrame, elements: DataFrame) -> DataFrame:
    """One row per product of each answer (``document_id, payload`` and, where a document has several, ``batch``), hydrated against the elements.

    An answer without products is a row of ordinal -1 with issues. A product that cannot be prepared is a row with an issue, beside its siblings.
    """
    named = batches if "batch" in batches.columns else batches.withColumn("batch", F.lit(None).cast("string"))
    answers = named.select("document_id", "batch", "payload")
    missing = [c for c in CARRIED if c not in elements.columns]
    known = elements.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else elements
    refs = references(answers).withColumn("ref_id", F.concat_ws("\0", "document_id", F.coalesce("batch", F.lit("")), "ordinal", "place"))
    found = resolve(refs, known, carry=CARRIED).where("element is not null")
    cited = found.groupBy("document_id", "batch").agg(F.collect_list(F.struct("ordinal", "place", "element")).alias("cited"))
    cited = cited.withColumnsRenamed({"document_id": "c_document", "batch": "c_batch"})
    both = answers.join(cited, F.col("document_id").eqNullSafe(F.col("c_document")) & F.col("batch").eqNullSafe(F.col("c_batch")), "left")

    def rebuilt(frames):
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                by_place = {(c["ordinal"], c["place"]): dict(c["element"]) for c in row["cited"]} if row["cited"] is not None and not isinstance(row["cited"], float) else {}
                products, shape = _entries(row["payload"])
                for i, p in enumerate(products):
                    body, issues = _prepared(row["document_id"], p, i, by_place)
                    out.append((row["document_id"], row["batch"], i, json.dumps(body, sort_keys=True, ensure_ascii=False), shape + issues))
                if not products:
                    out.append((row["document_id"], row["batch"], -1, None, shape or [_issue("empty_product_batch", "products", "warning", "no products")]))
            yield pd.DataFrame(out, columns=["document_id", "batch", "ordinal", "payload", "issues"])

    return both.select("document_id", "batch", "payload", "cited").mapInPandas(rebuilt, OUT)


def _prepared(document: str, product, ordinal: int, by_place: dict[tuple[int, int], dict]) -> tuple[dict, list[dict]]:
    """A product with its evidence, from what each of its references has found."""
    if not isinstance(product, dict):
        return {"value": product}, [_issue("invalid_product_payload", "", "error", "a product is an object")]
    asked = iter(range(1 << 31))
    try:
        return Hydrator(document, lambda name, page, text: by_place.get((ordinal, next(asked)))).product(product)
    except Exception as e:  # noqa: BLE001  one product must not take its siblings with it
        return product, [_issue("product_preparation_failure", f"products.{ordinal}", "error", f"{type(e).__name__}: {e}")]
