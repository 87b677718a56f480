import json

from pyspark.sql import functions as F

from pagewright.operators import catalog, chunks, hydrate, rules

EL = {"element_id": "el_1", "document_id": "d1", "page_number": 2, "text": "Bore 10 mm", "extraction_method": "native_text", "confidence": 0.9}


def codes(payload, elements=(EL,), document="d1"):
    out, issues = hydrate.Hydrator(document, None if elements is None else hydrate.index(document, list(elements))).product(payload)
    return out, [(i["code"], i["severity"]) for i in issues]


def field(ref):
    return {"part_name": {"raw": "x", "evidence": [ref]}}


def test_references():
    out, found = codes(field("el_1"))
    assert found == [] and out["part_name"]["evidence"][0]["text"] == "Bore 10 mm"
    out, found = codes(field({"element_id": "el_1", "page_number": 7, "text": "false"}))
    assert found == [("evidence_claim_mismatch", "warning")] * 2 and out["part_name"]["evidence"][0]["page_number"] == 2
    assert codes(field({"page_number": 2, "excerpt": "Bore 10 mm"}))[1] == []
    assert codes(field({"page_number": 2, "text": "Bore 10 mm"}), [EL, EL | {"element_id": "el_2"}])[1] == [("unknown_evidence_reference", "error")]
    assert codes(field("el_9"))[1] == [("unknown_evidence_reference", "error")]
    whole = field({"page_number": 1, "text": "made up"})
    assert codes(whole, [])[1] == [("unknown_evidence_reference", "error")] and codes(whole, None)[1] == [("unverified_evidence", "warning")]
    assert codes(field("el_1"), document="d2")[1] == [("cross_document_evidence", "error")]
    assert codes(field(5))[1] == [("invalid_evidence_reference", "error")]
    assert codes({"part_name": {"raw": "x", "evidence": "el_1"}})[1] == [("invalid_evidence_collection", "error")]


def test_details():
    detail = lambda n: {"name": {"raw": n, "evidence": ["el_1"]}, "value": {"raw": "v", "evidence": ["el_1"]}}
    out, found = codes({"other_details": [detail("X"), detail(" X "), detail(" "), 3]})
    assert list(out["other_details"]) == ["X", "X (2)"] and len(out["other_details"]["X"]["evidence"]) == 1
    assert [c for c, _ in found] == ["duplicate_other_detail_name", "invalid_other_detail_name", "invalid_other_detail"]
    assert codes({"specifications": [{}] * 48})[1] == [("wire_collection_limit_reached", "warning")]
    assert codes({"other_details": 4})[1] == [("invalid_other_details_collection", "error")]


def test_envelopes():
    kinds = lambda d: [i["code"] for i in hydrate.product_entries(d)[1]]
    assert kinds({"products": []}) == [] and kinds([{}]) == ["unversioned_product_array"] and kinds({"part_name": {}}) == ["single_product_envelope"]
    assert kinds("x") == ["invalid_product_batch"] and kinds({"products": [1] * 32}) == ["wire_product_limit_reached"]


def test_hydration_over_frames(spark):
    elements = spark.createDataFrame([tuple(EL.values())], "element_id string, document_id string, page_number int, text string, extraction_method string, confidence double")
    batches = spark.createDataFrame([("d1", json.dumps({"products": [field("el_1"), 7]})), ("d2", json.dumps(field("el_1"))), ("d3", "no json")], "document_id string, payload string")
    got = {(r.document_id, r.ordinal): [i.code for i in r.issues] for r in hydrate.hydrate(batches, elements).collect()}
    assert got == {("d1", 0): [], ("d1", 1): ["invalid_product_payload"], ("d2", 0): ["single_product_envelope", "cross_document_evidence"], ("d3", -1): ["invalid_product_batch"]}


def value(raw, normalized=None, confidence=None, text="Bore", element="el_1", document="d1", cited=True):
    e = {"source_document_id": document, "source_path": None, "page_number": 1, "element_id": element, "text": text, "confidence": 0.8}
    return {"raw": raw, "normalized": normalized, "confidence": confidence, "normalization_method": None, "evidence": [e] if cited else []}


def spec(name, v, unit=None):
    return {"name": value(name), "value": value(v), "unit": unit and value(unit), "category": None, "qualifier": None}


def products(spark, **changes):
    base = {
        "record_id": "p1", "source_document_id": "d1", "source_path": None, "manufacturer": value("  ACME   Corporation "), "part_name": value("Ring"), "part_number": value("pn–100"), "category": None,
        "description": None, "specifications": [spec("Temperature", "20", "degrees C")], "operating_conditions": [],
    }
    return spark.createDataFrame([base | changes], chunks.PRODUCT)


def test_normalisation(spark):
    r = rules.normalize(products(spark)).first()
    assert r.manufacturer.raw == "  ACME   Corporation " and r.manufacturer.normalized == "ACME Corporation"
    assert r.part_number.normalized == "PN-100" and r.specifications[0].unit.normalized == "°C" and r.record_confidence == 0.8
    same = rules.normalize(products(spark, part_number=value("x", normalized="old - 1"))).first()
    assert same.part_number.normalized == "OLD - 1"


def found(spark, strict=False, **changes):
    r = rules.validate(products(spark, **changes), strict=strict).first()
    return {(i.code, i.severity) for i in r.issues}, r.accepted


def test_schema_rules(spark):
    error = ("schema_error", "error")
    assert found(spark, part_name=value("x", confidence=1.5)) == ({error}, False)
    assert error in found(spark, record_id=" ")[0] and error in found(spark, category=value(None))[0]
    assert error in found(spark, part_name=value("x", element=" "))[0]


def test_rules(spark):
    assert found(spark) == (set(), True)
    assert found(spark, part_name=None, part_number=None) == ({("missing_product_identity", "error"), ("missing_part_number", "warning")}, False)
    assert found(spark, strict=True, manufacturer=None) == ({("missing_manufacturer", "error")}, False)
    assert found(spark, part_number=value("a\nb"))[0] == {("multiline_part_number", "error")}
    assert found(spark, part_number=value("�" + "x" * 160))[0] == {("replacement_character", "error"), ("suspicious_part_number_length", "warning")}
    assert found(spark, part_name=value(" "))[0] == {("blank_raw_value", "warning")}
    assert found(spark, part_name=value("x", cited=False, confidence=0.5))[0] == {("missing_evidence", "warning"), ("low_confidence", "warning")}
    assert found(spark, part_name=value("x", document="d2", text="a�"))[0] == {("evidence_document_mismatch", "warning"), ("replacement_character", "warning")}
    assert found(spark, specifications=[spec("A", "1"), spec("a", "1"), spec("A", "2")])[0] == {("duplicate_specification", "warning"), ("conflicting_specification", "warning")}


def test_chunks(spark):
    got = {r.chunk_type: r for r in chunks.product_chunks(products(spark)).collect()}
    assert set(got) == {"identity", "specification"} and got["identity"].text.splitlines()[0] == "Industrial catalog product"
    assert got["specification"].text.splitlines()[1] == "Specification: Temperature = 20 degrees C"
    merged = got["specification"].citations
    assert len(merged) == 1 and merged[0].field_paths == ["manufacturer", "part_name", "part_number", "specifications.0.name", "specifications.0.unit", "specifications.0.value"]
    again = {r.chunk_id for r in chunks.product_chunks(products(spark)).collect()}
    assert again == {r.chunk_id for r in got.values()}


def test_projections(spark):
    df = products(spark)
    assert [r.field_path for r in catalog.evidence(df).orderBy("field_path").collect()] == ["manufacturer", "part_name", "part_number", "specifications.0.name", "specifications.0.unit", "specifications.0.value"]
    assert catalog.specifications(df).first().unit_raw == "degrees C"


def test_batches(spark):
    rows = [("b1", 0, "r1", "{}", [], True), ("b1", 1, "r2", "{}", ["x"], False), ("b2", 0, "r3", "{}", [], True)]
    prepared = spark.createDataFrame(rows, "batch_id string, ordinal int, record_id string, payload string, issues array<string>, accepted boolean")
    batches = spark.createDataFrame([("b1",), ("b2",), ("b3",)], "batch_id string")
    out = catalog.persist_batch(prepared.unionByName(prepared), batches)
    assert {r.batch_id: (r.status, r.issues) for r in out["ingestion_batches"].collect()} == {"b1": ("partial", []), "b2": ("succeeded", []), "b3": ("succeeded", ["empty_product_batch"])}
    assert out["products"].count() == 2 and out["rejected_products"].count() == 1 and out["batch_products"].count() == 2
    assert out["rejected_products"].first().rejection_id.startswith("reject_")


def test_lookups(spark):
    df = spark.createDataFrame([("r1", "Acme", "A%1", 1), ("r2", "ACME", "b_2", 2), ("r3", None, "B22", 3)], "record_id string, manufacturer string, part_number string, updated_at int")
    assert [r.record_id for r in catalog.find_products(df, manufacturer="acme").collect()] == ["r1", "r2"]
    assert [r.record_id for r in catalog.find_products(df, contains={"part_number": "B_"}).collect()] == ["r2"]
    assert [r.record_id for r in catalog.find_products(df, limit=1, offset=0).collect()] == ["r3"]
    assert [r.record_id for r in catalog.find_by_part_number(df, "a%1", ("part_number",)).collect()] == ["r1"]
    assert catalog.violations(df, df.where("manufacturer = 'Acme'").select(F.col("manufacturer").alias("m")), {"manufacturer": "m"}).count() == 1


def test_latest_batch_of_a_record(spark):
    """batches compare as in ``batch:ordinal``, where the colon comes after all digits; rows without a place come first."""
    rows = [("b4", 7, "r1"), ("b49", 9, "r1"), ("b1", 2, "r2"), ("b1", 10, "r2"), (None, 3, "r3"), ("b2", 1, "r3"), ("b9", None, "r3")]
    prepared = spark.createDataFrame([(*r, "{}", [], True) for r in rows], "batch_id string, ordinal long, record_id string, payload string, issues array<string>, accepted boolean")
    got = catalog.persist_batch(prepared, prepared.select("batch_id").distinct())["products"].collect()
    assert {r.record_id: (r.batch_id, r.ordinal) for r in got} == {"r1": ("b4", 7), "r2": ("b1", 10), "r3": ("b2", 1)}


def test_blank_texts_and_spread_parts(spark):
    """parts of one file are worked on by all cores."""
    from pagewright.plans import catalogue

    part = spark.range(100).selectExpr("id as p_partkey", "'n' as p_name", "'Brand#1' as p_brand", "'T' as p_type", "cast(id % 50 as int) as p_size", "1.0D as p_retailprice").coalesce(1)
    assert catalogue.products_of(part).rdd.getNumPartitions() >= 3 * spark.sparkContext.defaultParallelism
    assert found(spark, part_name=value(" \x1c "))[0] == {("blank_raw_value", "warning")} and found(spark, part_name=value("​"))[0] == set()
