"""Evidence elements: what was read on a page, as rows with content-derived ids."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types

from pagewright.functions import text as T
from pagewright.operators import routing

BOX = "struct<x0:double,y0:double,x1:double,y1:double,coordinate_space:string>"
NAMES = "element_id document_id page_number sequence_number element_type text extraction_method bbox confidence model source_path raw_payload metadata".split()
PIPELINE_VERSION = "1.1"
TAGGED = r"(?s)<x_([0-9.]+)><y_([0-9.]+)>(.*?)<x_([0-9.]+)><y_([0-9.]+)><class_([^>]+)>"


def json_text(x: Column) -> Column:
    """The text as a JSON string, in which only what JSON requires is escaped; null stays null."""
    return F.when(x.isNotNull(), F.regexp_extract(F.to_json(F.struct(x.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1))


def box_json(box: Column) -> Column:
    """A box as an array of four plain numbers with six digits, or null."""
    side = lambda c: F.format_string("%.6f", box[c])
    return F.when(box.isNull(), "null").otherwise(F.concat(F.lit("["), F.concat_ws(",", *[side(c) for c in ("x0", "y0", "x1", "y1")]), F.lit("]")))


def element_id(document: Column, page: Column, sequence: Column, kind: Column, text: Column, method: Column, box: Column, model: Column) -> Column:
    """``el_`` and 32 hexadecimal digits of a length-prefixed hash of everything that tells an element apart."""
    null = F.lit("null")
    parts = [json_text(document), page.cast("string"), sequence.cast("string"), json_text(kind), json_text(text), json_text(method), box_json(box), F.coalesce(json_text(model), null)]
    return F.concat(F.lit("el_"), F.left(T.prefixed_hash(*[F.coalesce(p, null) for p in parts]), F.lit(32)))


def clamp(confidence: Column) -> Column:
    """A confidence within 0 and 1; null where there is none, or none that is a number."""
    return F.when(confidence.isNotNull() & ~F.isnan(confidence), F.least(F.lit(1.0), F.greatest(F.lit(0.0), confidence)))


def completed(rows: DataFrame) -> DataFrame:
    """Fills in what an element lacks (type, method, box, model, payload, metadata) and gives it its id."""
    defaults = {
        "element_type": "'text'", "extraction_method": "'native_text'", "bbox": f"cast(null as {BOX})", "confidence": "cast(null as double)", "model": "cast(null as string)",
        "source_path": "cast(null as string)", "raw_payload": "cast(null as string)", "metadata": "cast(map() as map<string,string>)",
    }
    rows = rows.withColumns({c: F.expr(x) for c, x in defaults.items() if c not in rows.columns})
    own = [F.col(c) for c in ("document_id", "page_number", "sequence_number", "element_type", "text", "extraction_method", "bbox", "model")]
    return rows.withColumn("element_id", element_id(*own)).withColumn("confidence", clamp(F.col("confidence"))).select(*NAMES)


def native_elements(pages: DataFrame) -> DataFrame:
    """One element per block that is not blank, else one for the whole text if it is not; confidence 1."""
    block = "array<struct<text:string,bbox:" + BOX + ",element_type:string,metadata:map<string,string>>>"
    blocks = F.col("native_blocks").cast(block) if "native_blocks" in pages.columns else F.array().cast(block)
    solid = F.filter(F.coalesce(blocks, F.array().cast(block)), lambda b: T.strip(F.coalesce(b["text"], F.lit(""))) != "")
    whole = F.array(F.struct(F.col("native_text").alias("text"), F.lit(None).cast(BOX).alias("bbox"), F.lit("text").alias("element_type"), F.create_map().cast("map<string,string>").alias("metadata"))).cast(block)
    some = T.strip(F.coalesce("native_text", F.lit(""))) != ""
    chosen = F.when(F.size(solid) > 0, solid).when(some, whole).otherwise(F.array().cast(block))
    source = F.col("source_path") if "source_path" in pages.columns else F.lit(None).cast("string")
    rows = pages.select("document_id", "page_number", source.alias("source_path"), F.posexplode(chosen).alias("sequence_number", "b"))
    return completed(
        rows.select("document_id", "page_number", "source_path", "sequence_number", F.col("b.text").alias("text"), F.coalesce("b.element_type", F.lit("text")).alias("element_type"), F.col("b.bbox").alias("bbox"),
                    F.coalesce("b.metadata", F.create_map().cast("map<string,string>")).alias("metadata"), F.lit(1.0).alias("confidence"))
    )


def line_elements(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents as pages of lines: one element per line that is not blank, numbered from 0."""
    rows = docs.select(F.col(id_col).cast("string").alias("document_id"), F.lit(1).alias("page_number"), F.posexplode(T.lines(text_col)).alias("sequence_number", "text"))
    return completed(rows.withColumn("confidence", F.lit(1.0)))


#: An element of an answer, as the model boundary reads it.
ANSWER = types.ArrayType(
    types.StructType(
        [types.StructField("text", types.StringType()), types.StructField("element_type", types.StringType())]
        + [types.StructField("bbox", types.StructType([types.StructField(c, types.DoubleType()) for c in ("x0", "y0", "x1", "y1")] + [types.StructField("coordinate_space", types.StringType())]))]
        + [types.StructField("confidence", types.DoubleType())]
    )
)
#: Where an element's text may be, the first that is there; what lists of elements are called; the names of a box's sides.
TEXTS = ("text", "content", "markdown", "html", "value")
LISTS = ("elements", "items", "blocks")
SIDES = (("left", "top", "right", "bottom"), ("x0", "y0", "x1", "y1"))


def box_of(value) -> tuple[float, float, float, float] | None:
    """A box from four numbers, from its sides by either set of names, or from a corner with width and height; None from anything else."""
    try:
        if isinstance(value, dict):
            named = next((names for names in SIDES if all(n in value for n in names)), None)
            if named:
                return tuple(float(value[n]) for n in named)
            x, y, w, h = (float(value[n]) for n in ("x", "y", "width", "height"))
            return x, y, x + w, y + h
        a, b, c, d = value if isinstance(value, list | tuple) else ()
        return float(a), float(b), float(c), float(d)
    except (KeyError, TypeError, ValueError):
        return None


def text_of(item: dict) -> str:
    """An element's text without white space around it; a map or list as JSON."""
    found = next((item[k] for k in TEXTS if item.get(k) not in (None, "")), "")
    return (json.dumps(found, sort_keys=True, ensure_ascii=False) if isinstance(found, dict | list) else str(found)).strip()


def walk(tree, inside: tuple[str, ...] = ("pages", "elements")) -> Iterator[dict]:
    """The elements of a tree of documents, pages and lists: every map that has an ``element_id``, in order."""
    if isinstance(tree, dict):
        if "element_id" in tree:
            yield tree
        else:
            yield from walk(next((tree[k] for k in inside if isinstance(tree.get(k), list)), list(tree.values()) if not inside else []), inside)
    elif isinstance(tree, list | tuple):
        for x in tree:
            yield from walk(x, inside)


def listed(value) -> list[dict]:
    """The elements of an answer's JSON value: a list, a map that holds one, or a single element; lists in lists and in elements are read in order."""
    if isinstance(value, dict):
        own = next((value[k] for k in LISTS if isinstance(value.get(k), list)), None)
        here = [value] if text_of(value) else []
        return here + (listed(own) if own is not None else [])
    return [e for x in value for e in listed(x)] if isinstance(value, list) else []


@F.pandas_udf(ANSWER)
def _answered(content: pd.Series) -> pd.Series:
    from pagewright.plans.models import NotJson, parse_json

    def one(raw):
        try:
            value = parse_json(raw)
        except NotJson:
            return None
        out = []
        for e in listed(value):
            kind, box = e.get("type") or e.get("element_type") or "text", box_of(e.get("bbox", e.get("bounding_box")))
            space = str((e.get("bbox") or {}).get("coordinate_space") or "pixel") if isinstance(e.get("bbox"), dict) else "pixel"
            try:
                confidence = float(e["confidence"])
            except (KeyError, TypeError, ValueError):
                confidence = float("nan")
            out.append({"text": text_of(e), "element_type": str(kind), "bbox": None if box is None else dict(zip(("x0", "y0", "x1", "y1", "coordinate_space"), (*box, space), strict=True)), "confidence": confidence if math.isfinite(confidence) else None})
        return out

    return content.map(one, na_action="ignore")


def response_elements(responses: DataFrame, method: str = "document_vlm") -> DataFrame:
    """Elements of model answers (``document_id, page_number, content, model``, and ``after``: how many elements the page has already, where it has).

    JSON first, then text tagged with corners and a class, else the whole answer as one ``document`` element. Blank ones are left out, and the others numbered.
    """
    part = lambda t, k: F.regexp_extract(t, TAGGED, k)
    corners = lambda t: F.struct(*[part(t, k).cast("double").alias(c) for k, c in ((1, "x0"), (2, "y0"), (4, "x1"), (5, "y1"))], F.lit("normalized").alias("coordinate_space"))
    none = F.lit(None).cast("double")
    tagged = F.transform(
        F.regexp_extract_all("content", F.lit(TAGGED), F.lit(0)),
        lambda t: F.struct(T.strip(part(t, 3)).alias("text"), part(t, 6).alias("element_type"), corners(t).alias("bbox"), none.alias("confidence")),
    )
    whole = F.array(F.struct(T.strip("content").alias("text"), F.lit("document").alias("element_type"), F.lit(None).cast(BOX).alias("bbox"), none.alias("confidence")))
    found = F.coalesce("answered", F.when(F.col("content").rlike(TAGGED), tagged.cast(ANSWER)).otherwise(whole.cast(ANSWER)))
    solid = F.filter(found, lambda e: F.coalesce(e["text"], F.lit("")) != "")
    after = F.coalesce(F.col("after"), F.lit(0)) if "after" in responses.columns else F.lit(0)
    rows = responses.withColumn("answered", _answered("content")).select("document_id", "page_number", "model", after.alias("after"), F.posexplode(solid).alias("k", "e"))
    return completed(rows.select("document_id", "page_number", "model", (F.col("k") + F.col("after")).cast("int").alias("sequence_number"), "e.*", F.lit(method).alias("extraction_method")))


def fingerprint(pages: DataFrame, parser: str = "", ocr: str = "") -> DataFrame:
    """Adds the content fingerprint that decides whether a page's earlier extraction may be used again; needs ``routing``."""
    parts = [F.lit(PIPELINE_VERSION), F.col("document_id"), F.col("page_number").cast("string"), F.coalesce("native_text", F.lit("")), F.to_json("routing"), F.lit(parser), F.lit(ocr)]
    if "native_blocks" in pages.columns:
        parts.append(F.coalesce(F.to_json("native_blocks"), F.lit("")))
    if "image" in pages.columns:
        parts.append(F.coalesce(F.sha2("image", 256), F.lit("")))
    # Never null, and seen to be so: a join by it adds no filter that would work it out once more.
    return pages.withColumn("fingerprint", F.coalesce(T.prefixed_hash(*parts), F.lit("")))


def resumption(pages: DataFrame, earlier: DataFrame) -> DataFrame:
    """Pages with ``restored``: whether an earlier extraction holds for their present fingerprint; one that failed never does. Either side is read once, whatever is then done with each kind of page."""
    key = ["document_id", "page_number", "fingerprint"]
    if "error" in earlier.columns:
        earlier = earlier.where("error is null")
    held = earlier.select(*key, F.lit(True).alias("restored")).distinct()
    return pages.join(held, key, "left").withColumn("restored", F.coalesce("restored", F.lit(False)))


def pending(pages: DataFrame, earlier: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages that still have to be extracted, and earlier extractions that hold for their page's present fingerprint; one that failed never does."""
    key = ["document_id", "page_number", "fingerprint"]
    if "error" in earlier.columns:
        earlier = earlier.where("error is null")
    return pages.join(earlier, key, "left_anti"), earlier.join(pages.select(*key), key, "left_semi")


def meaningful_native(pages: DataFrame, thresholds: routing.Thresholds = routing.Thresholds()) -> Column:
    """Whether a page's text or its joined blocks would pass the router if layout did not count."""
    passes = lambda c: routing.decide(routing.signals(c), thresholds)["route"] == routing.NATIVE
    if "native_blocks" not in pages.columns:
        return passes(F.col("native_text"))
    joined = F.array_join(F.transform("native_blocks", lambda b: F.coalesce(b["text"], F.lit(""))), "\n")
    return passes(F.col("native_text")) | passes(F.coalesce(joined, F.lit("")))
