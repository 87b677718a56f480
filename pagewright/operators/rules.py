"""Normalisation and validation of typed product records (see ``chunks.PRODUCT``); raw values are never touched."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types

from pagewright.functions import text as T
from pagewright.operators.chunks import EVIDENCE, IDENTITY, LISTS, PARTS, TEXTS, VALUE, values

ISSUE = "struct<code:string,path:string,severity:string>"
#: What each field's confidence counts for in a record's.
WEIGHTS = {"manufacturer": 2.0, "part_name": 2.0, "part_number": 3.0, "category": 1.0, "description": 1.0}
METHODS = {"part_number": "part_number_exact_match_v1", "unit": "engineering_unit_aliases_v1", "manufacturer": "manufacturer_whitespace_v1"}
_FUNCTIONS = {"part_number": T.part_number, "unit": T.unit}


def normalised(value: Column, kind: str, ascii_only: bool) -> Column:
    """The value with its normal form, from an earlier normal form if there is one, and the method that made it."""
    source = F.coalesce(value["normalized"], value["raw"])
    done = _FUNCTIONS.get(kind, T.whitespace)(source, ascii_only)
    method = F.coalesce(value["normalization_method"], F.lit(METHODS.get(kind, "unicode_nfkc_whitespace_v1")))
    return F.when(source.isNotNull(), value.withField("normalized", done).withField("normalization_method", method)).otherwise(value)


def normalize(products: DataFrame, ascii_only: bool = False) -> DataFrame:
    """Fills in the normal forms and ``record_confidence``.

    The values of listed specifications go through the same functions as the fields: all texts of a record are one array, which is normalised in one pass.
    ``ascii_only`` vouches that all texts are ASCII, and then everything stays in the JVM; it is checked, and a text that is not raises.
    """
    texts = lambda v: F.coalesce(v["normalized"], v["raw"])
    entries = F.map_entries(F.coalesce("other_details", F.create_map().cast(f"map<string,{VALUE}>")))
    if ascii_only:
        out = products.withColumns({c: normalised(_ascii(F.col(c)), c, True) for c in IDENTITY})
        each = lambda s: F.struct(*[normalised(_ascii(s[c]), c, True).alias(c) for c in PARTS])
        out = out.withColumns({c: F.transform(c, each) for c in LISTS} | {c: F.transform(c, lambda v: normalised(_ascii(v), "", True)) for c in TEXTS})
        plain_key = lambda k: F.when(~k.rlike(r"[^\x00-\x7F]"), T.whitespace(k, True)).otherwise(F.raise_error(F.lit("a text is not ASCII")).cast("string"))
        out = out.withColumn("other_details", F.when(F.col("other_details").isNotNull(), _last_wins(F.transform(entries, lambda e: plain_key(e["key"])), F.transform(entries, lambda e: normalised(_ascii(e["value"]), "", True)))))
        return out.withColumn("record_confidence", confidence())
    out = products.withColumns({c: normalised(F.col(c), c, False) for c in IDENTITY})
    # All texts of a record, one list after the other; where a list begins is the number of texts before it.
    pair = lambda text, kind: F.struct(text.alias("text"), F.lit(kind).alias("kind"))
    values = {c: F.flatten(F.transform(F.coalesce(F.col(c), F.array().cast(products.schema[c].dataType)), lambda s: F.array(*[pair(texts(s[p]), p) for p in PARTS]))) for c in LISTS}
    values |= {c: F.transform(F.coalesce(F.col(c), F.array().cast(f"array<{VALUE}>")), lambda v: pair(texts(v), "")) for c in TEXTS}
    values |= {"keys": F.transform(entries, lambda e: pair(e["key"], "")), "values": F.transform(entries, lambda e: pair(texts(e["value"]), ""))}
    start, begins = F.lit(0), {}
    for c, own in values.items():
        begins[c], start = start, start + F.size(own)
    every = F.concat(*values.values())
    out = out.withColumn("_done", _normal_forms(F.transform(every, lambda x: x["text"]), F.transform(every, lambda x: x["kind"]))).withColumn("_begins", F.struct(*[v.alias(c) for c, v in begins.items()]))

    def done(v: Column, place: Column, kind: str) -> Column:
        method = F.coalesce(v["normalization_method"], F.lit(METHODS.get(kind, "unicode_nfkc_whitespace_v1")))
        return F.when(texts(v).isNotNull(), v.withField("normalized", F.get(F.col("_done"), place)).withField("normalization_method", method)).otherwise(v)

    at = lambda c: F.col("_begins")[c]
    listed: dict[str, Column] = {}
    for c in LISTS:
        listed[c] = _with_place(c, lambda s, i, c=c: F.struct(*[done(s[p], at(c) + i * len(PARTS) + k, p).alias(p) for k, p in enumerate(PARTS)]))
    for c in TEXTS:
        listed[c] = _with_place(c, lambda v, i, c=c: done(v, at(c) + i, ""))
    keys = F.transform(entries, lambda e, i: F.get(F.col("_done"), at("keys") + i))
    listed["other_details"] = F.when(F.col("other_details").isNotNull(), _last_wins(keys, F.transform(entries, lambda e, i: done(e["value"], at("values") + i, ""))))
    return out.withColumns(listed).drop("_done", "_begins").withColumn("record_confidence", confidence())


def _with_place(name: str, make) -> Column:
    return F.transform(name, lambda x, i: make(x, i))


def _last_wins(keys: Column, values: Column) -> Column:
    """A map of keys, of which some may have become alike; the last value of a key stays."""
    own = F.array_distinct(keys)
    last = lambda k: F.element_at(values, (F.size(keys) - F.array_position(F.reverse(keys), k) + 1).cast("int"))
    return F.map_from_arrays(own, F.transform(own, last))


def _ascii(value: Column) -> Column:
    """The value; reading it raises if its text is not ASCII."""
    beyond = F.coalesce(value["normalized"], value["raw"], F.lit("")).rlike(r"[^\x00-\x7F]")
    return F.when(~beyond, value).otherwise(F.raise_error(F.lit("a text is not ASCII")).cast(VALUE))


@F.pandas_udf(types.ArrayType(types.StringType()))
def _normal_forms(texts: pd.Series, kinds: pd.Series) -> pd.Series:
    def one(text, kind):
        if text is None:
            return None
        plain = " ".join(unicodedata.normalize("NFKC", text).split())
        if kind != "unit":
            return plain
        plain = plain.replace("μ", "µ")
        return T.UNITS.get(plain.casefold(), plain)

    return pd.Series([None if ts is None else [one(t, k) for t, k in zip(ts, ks, strict=True)] for ts, ks in zip(texts, kinds, strict=True)])


def effective(value: Column) -> Column:
    """A value's own confidence, else the best of its evidence."""
    return F.coalesce(value["confidence"], F.array_max(F.transform(value["evidence"], lambda e: e["confidence"])))


def confidence() -> Column:
    """Weighted mean of all effective confidences of a record, to six digits; null where it has none."""
    pair = lambda v, w: F.struct(effective(v).alias("c"), F.lit(w).alias("w"))
    one = F.array(*[pair(F.col(c), w) for c, w in WEIGHTS.items()])
    many = [F.flatten(F.transform(F.coalesce(F.col(c), F.array()), lambda s: F.array(*[pair(s[p], 1.0) for p in ("name", "value", "unit")]))) for c in LISTS]
    known = F.filter(F.concat(one, *many), lambda x: x["c"].isNotNull())
    total = lambda f: F.aggregate(known, F.lit(0.0), lambda a, x: a + f(x))
    return F.when(F.size(known) > 0, F.bround(total(lambda x: x["c"] * x["w"]) / total(lambda x: x["w"]), 6))


def _issue(code: str, path: Column, severity: str) -> Column:
    return F.struct(F.lit(code).alias("code"), path.alias("path"), F.lit(severity).alias("severity"))


def _share(x: Column) -> Column:
    """Whether a confidence is missing or lies between 0 and 1."""
    return x.isNull() | (~F.isnan(x) & x.between(0, 1))


def value_issues(v: Column, path: Column, document: Column, required: bool, strict: bool, low: float) -> Column:
    """What is wrong with one value: a form that its schema forbids, blank forms, missing evidence, low confidence, evidence from elsewhere, broken characters."""
    blank = lambda c: v[c].isNotNull() & T.blank(v[c])
    cites = F.coalesce(v["evidence"], F.array().cast(f"array<{EVIDENCE}>"))
    single = [
        F.when(F.coalesce(v["raw"], v["normalized"]).isNull() | ~_share(v["confidence"]), _issue("schema_error", path, "error")),
        F.when(blank("raw"), _issue("blank_raw_value", path, "warning")),
        F.when(blank("normalized"), _issue("blank_normalized_value", path, "warning")),
        F.when(F.lit(required) & (F.size(cites) == 0), _issue("missing_evidence", path, "error" if strict else "warning")),
        F.when(effective(v) < low, _issue("low_confidence", path, "warning")),
    ]
    listed = F.flatten(F.transform(cites, lambda e: F.array_compact(F.array(
        F.when((e["page_number"] < 1) | T.blank(e["element_id"]) | ~_share(e["confidence"]), _issue("schema_error", path, "error")),
        F.when(e["source_document_id"] != document, _issue("evidence_document_mismatch", path, "warning")),
        F.when(e["text"].contains("�"), _issue("replacement_character", path, "warning")),
    ))))
    return F.when(v.isNotNull(), F.concat(F.array_compact(F.array(*single)), listed)).otherwise(F.array().cast(f"array<{ISSUE}>"))


def validate(products: DataFrame, strict: bool = False, require_evidence: bool = True, low: float = 0.65) -> DataFrame:
    """Adds ``issues`` (code, path, severity) and ``accepted``: no issue is an error."""
    has = lambda c: F.col(c).isNotNull() & (F.coalesce(F.col(c)["raw"], F.col(c)["normalized"]).isNotNull())
    grade = "error" if strict else "warning"
    number = F.coalesce(F.col("part_number")["raw"], F.lit(""))
    blank_id = lambda c: F.coalesce(T.blank(c), F.lit(True))
    record = F.array_compact(F.array(
        F.when(blank_id("record_id"), _issue("schema_error", F.lit("record_id"), "error")),
        F.when(blank_id("source_document_id"), _issue("schema_error", F.lit("source_document_id"), "error")),
        F.when(~has("part_name") & ~has("part_number"), _issue("missing_product_identity", F.lit(""), "error")),
        F.when(~has("manufacturer"), _issue("missing_manufacturer", F.lit("manufacturer"), grade)),
        F.when(~has("part_number"), _issue("missing_part_number", F.lit("part_number"), grade)),
        F.when(F.size(F.coalesce("specifications", F.array())) == 0, _issue("missing_specifications", F.lit("specifications"), grade)),
        F.when(number.rlike(r"[\r\n]"), _issue("multiline_part_number", F.lit("part_number"), "error")),
        F.when(F.length(number) > 160, _issue("suspicious_part_number_length", F.lit("part_number"), "warning")),
        F.when(number.contains("�"), _issue("replacement_character", F.lit("part_number"), "error")),
    ))
    each = F.flatten(F.transform(values(), lambda x: value_issues(x["value"], x["path"], F.col("source_document_id"), require_evidence, strict, low)))
    out = products.withColumn("issues", F.concat(record, each, repeated_specifications()))
    return out.withColumn("accepted", ~F.exists("issues", lambda i: i["severity"] == "error"))


@F.pandas_udf(types.ArrayType(types.StructType([types.StructField(c, types.StringType()) for c in ("code", "path", "severity")])))
def _repeats(keys: pd.Series, values: pd.Series) -> pd.Series:
    def one(names, shown):
        first: dict[str, str | None] = {}
        out = []
        for i, (k, v) in enumerate(zip(names, shown, strict=True)):
            k = k.casefold()
            if k in first:
                code = "duplicate_specification" if first[k] == v else "conflicting_specification"
                out.append({"code": code, "path": f"specifications.{i}", "severity": "warning"})
            first.setdefault(k, v)
        return out

    return pd.Series([one(k, v) for k, v in zip(keys, values, strict=True)])


def repeated_specifications() -> Column:
    """Specifications whose name and unit, case folded, came before: duplicates if the value is the same as the first one's, else conflicts. One pass over a record's."""
    shown = lambda v: F.coalesce(v["normalized"], v["raw"], F.lit(""))
    specs = F.coalesce(F.col("specifications"), F.array())
    return _repeats(F.transform(specs, lambda s: F.concat_ws("\0", shown(s["name"]), shown(s["unit"]))), F.transform(specs, lambda s: shown(s["value"])))


def reviewed(validated: DataFrame) -> DataFrame:
    """Adds ``validation_warnings`` (code and path of every issue that is more than information) and ``review_status``, which such an issue turns from ``unreviewed`` to ``needs_review``."""
    told = F.transform(F.filter("issues", lambda i: i["severity"] != "info"), lambda i: F.concat_ws(":", i["code"], i["path"]))
    status = F.coalesce(F.col("review_status") if "review_status" in validated.columns else F.lit(None).cast("string"), F.lit("unreviewed"))
    out = validated.withColumns({"validation_warnings": told, "review_status": status})
    return out.withColumn("review_status", F.when((F.col("review_status") == "unreviewed") & (F.size("validation_warnings") > 0), "needs_review").otherwise(F.col("review_status")))


def require_valid(validated: DataFrame) -> DataFrame:
    """The same rows; reading one that is not accepted raises."""
    told = F.concat(F.lit("invalid product "), F.col("record_id"), F.lit(": "), F.array_join(F.transform("issues", lambda i: i["code"]), ", "))
    return validated.withColumn("accepted", F.when(F.col("accepted"), True).otherwise(F.raise_error(told)))


__all__ = ["VALUE", "normalize", "validate", "require_valid", "confidence", "effective"]
