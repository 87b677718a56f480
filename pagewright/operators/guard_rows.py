"""The source guard over products as rows, for answers of any size: what ``guard.Guard`` tells of an answer in memory, by joins and aggregates.

Python sees one product, or one element's text, at a time. What products say is told once as columns; their numbers meet the expected identifiers, what they cite meets the elements,
and a verdict for each chunk is what is left. A text is looked through once for whole tokens; identifiers that are no tokens, as they have spaces or other signs in them, are looked for in blocks.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions.untrusted import NotJson, loads
from pagewright.operators.guard import FIELDS, Identifiers, _raw, bare_title, concise_title, identity

#: Identifiers that one pass over a text looks for.
BLOCK = 1 << 15
_OUTSIDE = r"[^A-Za-z0-9._/\-]+"
_FACTS = {
    "is_object": pa.bool_(), "maker": pa.string(), "maker_cites": pa.list_(pa.string()), "name": pa.string(), "number": pa.string(), "identity_only": pa.bool_(),
    "maker_ids": pa.list_(pa.string()), "name_ids": pa.list_(pa.string()), "number_ids": pa.list_(pa.string()),
}
_FACTS_SQL = "is_object boolean, maker string, maker_cites array<string>, name string, number string, identity_only boolean, maker_ids array<string>, name_ids array<string>, number_ids array<string>"
Park = Callable[[DataFrame, str], DataFrame]


def _sayable(x: str | None) -> str | None:
    """A text as UTF-8 can hold it; one with half of a pair in it, which no source has, stays apart from all others."""
    try:
        x is None or x.encode()
    except UnicodeEncodeError:
        return "\0" + json.dumps(x)
    return x


def _facts(text: str | None) -> tuple:
    try:
        p = loads(text or "")
    except NotJson:
        p = None
    if not isinstance(p, dict):
        return (False, None, None, None, None, False, None, None, None)
    maker, name, number = (_raw(p.get(f)) for f in ("manufacturer", "part_name", "part_number"))
    refs = p["manufacturer"].get("evidence") if maker is not None else None
    cites = [_sayable(r["element_id"]) for r in refs if isinstance(r, dict) and isinstance(r.get("element_id"), str)] if isinstance(refs, list) else []
    only = set(p) == FIELDS
    parsed = [identity(p[f]) for f in ("manufacturer", "part_name", "part_number")] if only else [None]
    ids = [list(map(_sayable, x[1])) for x in parsed] if all(parsed) else [None] * 3
    return (True, _sayable(maker), cites, _sayable(name), _sayable(number), only, *ids)


def _told(products: DataFrame, chunk: tuple[str, ...]) -> DataFrame:
    """What each product says. Products are dealt to all tasks, whatever their chunk."""
    keys = [*chunk, "place", "product"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in products.select(*keys).schema)

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = list(zip(*map(_facts, batch.column("product").to_pylist()), strict=True)) or [()] * len(_FACTS)
            own = [batch.column(c) for c in keys]
            yield pa.RecordBatch.from_arrays(own + [pa.array(v, t) for v, t in zip(told, _FACTS.values(), strict=True)], names=[*keys, *_FACTS])

    return products.select(*keys).repartition(*keys).mapInArrow(tell, f"{schema}, {_FACTS_SQL}")


def _held(cited: DataFrame, expected: DataFrame, chunk: tuple[str, ...]) -> DataFrame:
    """Which cited element (``element_id, cite, text``) has which identifier (``number``) as a whole token: all tokens, expected or not, and those of the expected that are no tokens."""
    own = [*chunk, "element_id", "cite"]
    tokens = cited.select(*own, F.explode(F.split("text", _OUTSIDE)).alias("number")).where("number <> ''")
    odd = expected.where(~F.col("number").rlike(r"\A[A-Za-z0-9._/\-]+\z") & (F.col("number") != ""))
    blocks = odd.groupBy(*chunk, F.floor(F.col("at") / BLOCK).alias("block")).agg(F.collect_list("number").alias("numbers"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cited.select(*own).schema)

    def look(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.to_dict("records"):
                yield pd.DataFrame([(*(row[c] for c in own), x) for x in Identifiers(list(row["numbers"])).of(row["text"])], columns=[*own, "number"])

    return tokens.unionByName(cited.where("text is not null").join(blocks, list(chunk)).select(*own, "text", "numbers").mapInPandas(look, f"{schema}, number string"))


def _udf(f: Callable, kind: str, *columns: str) -> Column:
    """A function of single values over columns."""
    return F.pandas_udf(lambda *c: pd.Series([f(*row) for row in zip(*c, strict=True)], dtype=object), kind)(*columns)


def _first(*conditions: tuple[Column, str]) -> Column:
    """The name of the first condition that does not hold; null if all hold."""
    return F.coalesce(*[F.when(~F.coalesce(holds, F.lit(False)), name) for holds, name in conditions])


def enforce(
    products: DataFrame, hints: DataFrame, elements: DataFrame, chunk: tuple[str, ...] = ("document_id",), answered: DataFrame | None = None, park: Park = lambda rows, name: rows
) -> tuple[DataFrame, DataFrame]:
    """Guards products (``place, product``: a product's JSON, and any value that tells its place in its chunk's answer, alike only for like products): a verdict for each chunk, and the products that it lets through.

    Verdicts have ``mode, given, kept, dropped, first_reason, violation, repair_attempted, repaired, repair_reason``: what the audit of ``guard.enforce`` tells, without its lists. ``first_reason`` is that of the first
    product that was dropped. Chunks whose answers have no product are told by ``answered``. Products let through have ``place``, or the identifier's place (``at``) where they were repaired. ``park`` may keep what is read more than once.
    A product that is no JSON is no object, and ids of evidence that are no texts name nothing.
    """
    keys = list(chunk)
    given = products.select(*keys).distinct() if answered is None else answered.select(*keys).distinct()
    hinted = given.join(hints.select(*keys, "mode", "identifiers", "evidence_element_ids", F.transform("manufacturers", lambda m: F.struct(m["raw"].alias("raw"), m["element_id"].alias("element_id"))).alias("manufacturers")), keys, "left")
    hinted = park(hinted.withColumn("mode", F.coalesce("mode", F.lit("single_family"))), "hinted")
    texts = elements.select(*keys, "element_id", "text")
    # These two are tables of their own as they are small in most cases, and products are not shuffled to meet a table that Spark knows to be small.
    makers = park(hinted.select(*keys, F.explode("manufacturers").alias("m")).groupBy(*keys, F.col("m.raw").alias("maker")).agg(F.collect_set("m.element_id").alias("allowed")), "makers")
    scalars = park(hinted.select(*keys, "mode", (F.coalesce(F.size("manufacturers"), F.lit(0)) > 0).alias("has_makers")), "chunks")

    # What stands against each product.
    told = _told(products, chunk).join(makers, [*keys, "maker"], "left").join(scalars.select(*keys, "has_makers"), keys)
    against = (
        F.when(~F.col("is_object"), "product_is_not_an_object").when(F.col("maker").isNull(), "missing_manufacturer_identity")
        .when(F.col("has_makers") & F.col("allowed").isNull(), "manufacturer_not_in_source_candidates")
        .when(F.col("has_makers") & ~F.arrays_overlap("maker_cites", "allowed"), "manufacturer_candidate_evidence_not_cited").when(F.col("name").isNull(), "missing_part_name_identity")
    )
    told = park(told.withColumn("reason", against).drop("allowed", "maker_cites", "has_makers"), "told")

    # Which identifiers are expected, and which cited elements have them.
    cited = hinted.select(*keys, F.posexplode("evidence_element_ids").alias("cite", "element_id"))
    expected = hinted.select(*keys, F.posexplode("identifiers").alias("at", "number")).groupBy(*keys, "number").agg(F.count("*").alias("n_expected"), F.min("at").alias("at"))
    held = _held(cited.join(texts, [*keys, "element_id"]), expected, chunk)
    expected = expected.join(held, [*keys, "number"], "left").groupBy(*keys, "number").agg(
        F.first("n_expected").alias("n_expected"), F.first("at").alias("at"), F.min(F.when(F.col("cite").isNotNull(), F.struct("cite", "element_id")))["element_id"].alias("backing"), F.collect_set("element_id").alias("held_in")
    )
    expected = park(expected, "expected")

    # Numbers that products say against those expected; then all that is told of a chunk.
    kept = F.col("reason").isNull()
    said = told.groupBy(*keys, "number").agg(
        F.count("*").alias("n"), F.count_if(kept).alias("n_kept"), F.min(F.when(~kept, F.struct("place", "reason"))).alias("first_dropped"), F.min(F.when(kept, F.col("place"))).alias("first_kept"),
        F.min(F.when(kept, F.col("identity_only"))).alias("identity_only"), F.min(F.when(kept, F.col("number_ids").isNotNull())).alias("strict"), *_range("maker", kept), *_range("name", kept),
    )
    met = said.join(expected.drop("held_in"), [*keys, "number"], "full")
    n_kept, n_expected = F.coalesce("n_kept", F.lit(0)), F.coalesce("n_expected", F.lit(0))
    counted = met.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("n_kept").alias("n_kept"), F.min("first_dropped").alias("first_dropped"), F.min("first_kept").alias("first_kept"), F.max(n_kept != n_expected).alias("differs"), F.sum("n_expected").alias("n_expected"),
        F.max((n_expected > 1) | (n_expected > 0) & (F.col("number").isNull() | (F.col("number") == ""))).alias("ill_expected"), F.max((n_kept > 0) & (n_expected == 0)).alias("unexpected"),
        F.max((n_expected > 0) & F.col("backing").isNull()).alias("unbacked"), F.min("identity_only").alias("identity_only"), F.min("strict").alias("strict"),
        *[F.min(c).alias(c) for c in ("maker_from", "name_from")], *[F.max(c).alias(c) for c in ("maker_to", "name_to")],
    )
    counted = scalars.join(counted, keys, "left").fillna(0, ["n", "n_kept", "n_expected"]).fillna(False, ["differs", "ill_expected", "unexpected", "unbacked"])
    counted = park(counted.withColumn("open", (F.col("mode") != "single_family") & F.col("differs")), "counted")

    # What the proof of a repair needs of a chunk's evidence, where it comes to that.
    has = elements.groupBy(*keys).agg(F.count("*").alias("n_elements"), F.count_distinct("element_id").alias("n_ids"))
    ids = elements.select(*keys, "element_id").distinct().withColumn("found", F.lit(True))
    cites = cited.join(ids, [*keys, "element_id"], "left").groupBy(*keys).agg(
        F.count("*").alias("n_cited"), F.count_distinct(F.when(F.col("element_id") != "", F.col("element_id"))).alias("n_good"), F.count("found").alias("n_found")
    )
    tried = counted.where("open and n = n_kept and n_kept = n_expected and identity_only and strict and not unexpected and not ill_expected and not unbacked")
    each = lambda kind, c: F.transform(f"{c}_ids", lambda x: F.struct(F.lit(kind).alias("kind"), F.col(c).alias("raw"), x.alias("element_id")))
    claims = told.join(tried.select(*keys), keys, "left_semi").select(*keys, "place", F.explode(F.concat(*[each(c, c) for c in ("maker", "name", "number")])).alias("c"))
    claims = park(claims.groupBy(*keys, "c.kind", "c.raw", "c.element_id").agg(F.min("place").alias("place")), "claims")
    numbers = claims.where("kind = 'number'").join(cited.select(*keys, "element_id", "cite").distinct(), [*keys, "element_id"], "left").join(expected.select(*keys, F.col("number").alias("raw"), "held_in"), [*keys, "raw"], "left")
    wrong = F.when(F.col("cite").isNull(), 0).when(~F.coalesce(F.array_contains("held_in", F.col("element_id")), F.lit(False)), 1)
    numbers = numbers.groupBy(*keys).agg(F.min(F.when(wrong.isNotNull(), F.struct("place", wrong.alias("how"))))["how"].alias("number_fault"))
    backed = F.coalesce(F.contains("text", "raw"), F.lit(False))
    names = claims.where("kind <> 'number'").join(texts, [*keys, "element_id"], "left").groupBy(*keys).agg(*[F.max((F.col("kind") == k) & ~backed).alias(f"{k}_unbacked") for k in ("maker", "name")])
    several = claims.where("kind = 'name'").join(tried.where("name_from <> name_to").select(*keys), keys, "left_semi").where(_udf(concise_title, "boolean", "raw"))
    bare = texts.join(several.select(*keys, "element_id").distinct(), [*keys, "element_id"], "left_semi").select(*keys, "element_id", _udf(lambda t: None if t is None else bare_title(t), "string", "text").alias("raw"))
    titles = several.join(bare, [*keys, "element_id", "raw"]).groupBy(*keys).agg(F.count_distinct("raw").alias("n_titles"), F.min(F.struct("raw", "element_id")).alias("title"))

    both = counted
    for more in (has, cites, numbers, names, titles):
        both = both.join(more, keys, "left")
    one = F.col("name_from") == F.col("name_to")
    failing = _first(
        (F.col("n_elements") > 0, "document_extraction_not_available"),
        ((F.col("n_expected") > 0) & ~F.col("ill_expected"), "expected_identifiers_not_nonempty_and_unique"),
        ((F.col("n_cited") > 0) & (F.col("n_cited") == F.col("n_good")), "cardinality_evidence_ids_not_nonempty_and_unique"),
        (F.col("n_elements") == F.col("n_ids"), "extraction_contains_duplicate_element_ids"),
        (F.col("n_found") == F.col("n_cited"), "cardinality_evidence_element_not_found"),
        (~F.col("unbacked"), "expected_identifier_not_exactly_source_backed"),
        (F.col("n") == F.col("n_kept"), "products_were_rejected_before_identifier_repair"),
        (F.col("n_kept") == F.col("n_expected"), "emitted_product_count_does_not_match_expected_count"),
        (F.col("identity_only"), "product_is_not_identity_only"),
        (F.col("strict"), "identity_field_does_not_match_strict_raw_evidence_shape"),
        (~F.col("unexpected"), "emitted_part_number_is_not_expected"),
        (F.coalesce(F.col("number_fault") != 0, F.lit(True)), "part_number_evidence_is_not_from_cardinality_elements"),
        (F.col("number_fault").isNull(), "part_number_evidence_does_not_contain_exact_identifier"),
        (F.col("maker_from") == F.col("maker_to"), "manufacturer_identity_is_not_consistent"),
        (F.col("has_makers"), "manufacturer_is_not_a_deterministic_source_candidate"),
        (~F.col("maker_unbacked"), "manufacturer_identity_is_not_exactly_source_backed"),
        (~F.col("name_unbacked"), "part_name_identity_is_not_exactly_source_backed"),
        (one | (F.col("n_titles") > 0), "no_concise_standalone_part_name_candidate"),
        (one | (F.col("n_titles") == 1), "multiple_concise_standalone_part_name_candidates"),
    )
    ambiguous = (F.col("mode") == "single_family") & (F.col("n_kept") > 1)
    repair_reason = F.when(F.col("open"), failing)
    violation = F.when(ambiguous, "ambiguous_excess_product_set").when(F.col("repair_reason").isNotNull(), "incomplete_or_non_unique_multi_product_identifier_set")
    both = both.withColumn("repair_reason", repair_reason).withColumns({"violation": violation, "repaired": F.col("open") & F.col("repair_reason").isNull()})
    # After a repair as many products are there as identifiers, and as many as were kept.
    both = both.withColumn("kept", F.when(F.col("violation").isNull(), F.col("n_kept")).otherwise(0)).withColumn("dropped", F.col("n") - F.col("kept"))
    judged = park(both.select(*keys, "mode", F.col("n").alias("given"), "kept", "dropped", F.col("first_dropped.reason").alias("first_reason"), "violation", F.col("open").alias("repair_attempted"), "repaired", "repair_reason", "first_kept", "title"), "judged")
    return judged.drop("first_kept", "title"), _passed(told, expected, judged, chunk)


def _range(c: str, when: Column) -> list[Column]:
    return [F.min(F.when(when, F.col(c))).alias(f"{c}_from"), F.max(F.when(when, F.col(c))).alias(f"{c}_to")]


def _without_number(product: str, single: bool) -> str:
    return json.dumps({k: v for k, v in loads(product).items() if not (single and k == "part_number")}, sort_keys=True)


def _proven(first: str, title: str | None, title_id: str | None, number: str, backing: str) -> str:
    own = loads(first)
    name = own["part_name"] if title is None else {"raw": title, "evidence": [{"element_id": title_id}]}
    return json.dumps({"manufacturer": own["manufacturer"], "part_name": name, "part_number": {"raw": number, "evidence": [{"element_id": backing}]}}, sort_keys=True)


def _passed(told: DataFrame, expected: DataFrame, judged: DataFrame, chunk: tuple[str, ...]) -> DataFrame:
    """Products of chunks without a violation: as they are, without a part number where none is supported, or those that the source proves."""
    keys = list(chunk)
    kept = told.where("reason is null").select(*keys, "place", "product")
    whole = judged.where("violation is null and not repaired").select(*keys, (F.col("mode") == "single_family").alias("single"))
    good = kept.join(whole, keys).select(*keys, "place", F.lit(None).cast("int").alias("at"), _udf(_without_number, "string", "product", "single").alias("product"))
    mended = judged.where("repaired").select(*keys, F.col("first_kept").alias("place"), "title")
    first = kept.join(mended, [*keys, "place"]).groupBy(*keys).agg(F.min("product").alias("first"), F.first("title").alias("title"))
    rows = expected.join(first, keys).select(*keys, "at", _udf(_proven, "string", "first", "title.raw", "title.element_id", "number", "backing").alias("product"))
    return good.unionByName(rows.withColumn("place", F.lit(None).cast(told.schema["place"].dataType)))
