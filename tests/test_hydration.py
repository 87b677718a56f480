"""Hydration by joins against the walk in memory, whole products through a run, and failures that stay where they are."""

import json
import random

from pyspark.sql import functions as F

from pagewright.functions import tables, untrusted
from pagewright.operators import catalog, chunks, hints, hydrate, rules
from pagewright.plans import models, run

ELEMENT = f"element_id string, document_id string, page_number int, sequence_number int, text string, extraction_method string, confidence double, bbox {chunks.BOX}, source_path string"


def random_answer(r, elements):
    def ref():
        e = r.choice(elements)
        return r.choice([
            e["element_id"], {"element_id": e["element_id"]}, {"element_id": e["element_id"], "page_number": r.choice([1, 2, "2", None])}, {"page_number": e["page_number"], "text": e["text"]},
            {"page_number": str(e["page_number"]), "excerpt": e["text"]}, {"element_id": "el_none"}, {"element_id": "el_none", "page_number": 1, "text": "t"}, 7, None, {}, {"page_number": 1e300}, {"page_number": float(2)},
            {"element_id": 5, "text": ["x"]}, {"page_number": 10**30, "text": "t"},
        ])

    def value(deep=0):
        found = {"raw": r.choice(["a", "é", None, 3]), "evidence": r.choice([[ref() for _ in range(r.randrange(4))], "el_1", None])}
        return found if deep > 2 or r.random() < 0.7 else found | {"more": r.choice([value(deep + 1), [value(deep + 1), 4], {"a.b": value(deep + 1)}])}

    def product():
        out = {k: value() for k in r.sample(["manufacturer", "part_name", "x.y", "part_number"], 3)}
        if r.random() < 0.5:
            out["specifications"] = [{"name": value(), "value": value()} for _ in range(r.randrange(3))]
        if r.random() < 0.5:
            out["other_details"] = r.choice([[{"name": {"raw": r.choice(["Bore", "bore ", " Bore"]), "evidence": [ref()]}, "value": value()} for _ in range(3)], [4, {"name": 1}], "no", {}])
        return r.choice([out, out, out, 5, None])

    return r.choice([lambda: {"products": [product() for _ in range(r.randrange(5))]}, lambda: [product()], lambda: {"part_name": value()}, lambda: 4, lambda: {"products": "x"}])()


def test_joins_find_what_the_walk_finds(spark):
    r = random.Random(21)
    elements = []
    for d in ("d1", "d2"):
        for k in range(30):
            box = {"x0": 1.0, "y0": 2.0, "x1": 3.0, "y1": 4.0, "coordinate_space": "point"} if k % 3 else None
            elements.append({"element_id": f"el_{d}_{k}", "document_id": d, "page_number": k % 3 + (k != 9), "sequence_number": k, "text": r.choice(["t", "u", f"text {k}", "", None]), "extraction_method": "native_text", "confidence": r.choice([None, 0.5]), "bbox": box, "source_path": r.choice([None, "p.pdf"])})
    answers = [(r.choice(["d1", "d2"]), r.choice([f"b{k}", None]) if k < 1 else f"b{k}", json.dumps(random_answer(r, elements))) for k in range(1000)] + [("d1", "bad", "{"), ("d1", "deep", "[" * 100_000), ("d1", "null", None)]
    got = hydrate.hydrate(spark.createDataFrame(answers, "document_id string, batch string, payload string"), spark.createDataFrame(elements, ELEMENT)).collect()
    want = []
    for document, batch, payload in answers:
        own = hydrate.Hydrator(document, hydrate.index(document, elements))
        products, shape = hydrate._entries(payload)
        for i, p in enumerate(products):
            body, issues = own.product(p) if isinstance(p, dict) else ({"value": p}, [{"code": "invalid_product_payload"}])
            want.append((document, batch or "", i, json.loads(json.dumps(body)), [x["code"] for x in shape + issues]))
        if not products:
            want.append((document, batch or "", -1, None, [x["code"] for x in shape] or ["empty_product_batch"]))
    key = lambda x: x[:3]
    found = [(x.document_id, x.batch or "", x.ordinal, None if x.payload is None else json.loads(x.payload), [i.code for i in x.issues]) for x in got]
    assert sorted(found, key=key) == sorted(want, key=key)
    codes = {c for x in want for c in x[4]}
    assert {"cross_document_evidence", "unknown_evidence_reference", "evidence_claim_mismatch", "invalid_source_evidence", "invalid_evidence_reference", "duplicate_other_detail_name"} <= codes


def test_a_long_document_is_not_held_by_one_task(spark):
    elements = spark.range(200_000).select(F.concat(F.lit("el_"), "id").alias("element_id"), F.lit("d").alias("document_id"), (F.col("id") % 500 + 1).cast("int").alias("page_number"), F.concat(F.lit("text "), "id").alias("text"))
    products = [{"part_name": {"raw": "x", "evidence": [{"element_id": f"el_{k * 6000}"}, {"page_number": 3, "text": f"text {2 + 500 * k}"}, "el_none"]}} for k in range(32)]
    answers = spark.createDataFrame([("d", "b", json.dumps({"products": products}))], "document_id string, batch string, payload string")
    got = hydrate.hydrate(answers, elements).collect()
    assert [len(json.loads(x.payload)["part_name"]["evidence"]) for x in sorted(got, key=lambda x: x.ordinal)] == [2] * 32
    plan = hydrate.hydrate(answers, elements)._jdf.queryExecution().toString()
    assert "FlatMapCoGroups" not in plan and "FlatMapGroups" not in plan


TEXT = "Manufacturer: Norwick Ltd\nThe shaft ring family carries torque between two aligned shafts in dry rooms at moderate speed without any lubricant at all."
PAGE = "document_id string, page_number int, native_text string"


class Whole:
    """Answers with every field that a product can have."""

    def generate(self, schema, prompt, evidence):
        cite = [{"element_id": evidence[0]["element_id"]}]
        value = lambda raw: {"raw": raw, "confidence": 0.9, "evidence": cite}
        spec = {"name": value("Bore"), "value": value("5"), "unit": value("millimeters"), "category": value("Size"), "qualifier": value("max")}
        names = {c: [value(f"{c} 1"), value(f"{c}  2")] for c in chunks.TEXTS}
        details = [{"name": {"raw": n, "evidence": cite}, "value": value(v)} for n, v in (("Colour", "red"), ("Colour", "blue"), ("Ｆinish", "matt"))]
        product = {c: value(f"{c} é") for c in chunks.IDENTITY if c not in ("manufacturer", "part_number")} | {"manufacturer": value("Norwick Ltd")}
        return json.dumps({"products": [product | names | {"specifications": [spec], "operating_conditions": [spec], "other_details": details}]})


def test_a_product_is_kept_whole(spark, tmp_path):
    root = f"file://{tmp_path}"
    told = run.run(spark, spark.createDataFrame([("a", 1, TEXT)], PAGE), root, structured=Whole).first()
    assert (told.products, told.rejected) == (1, 0)
    store = run.tables(spark, root)
    p = store["products"].read().first()
    assert p.other_details["Finish"].raw == "matt" and p.other_details["Colour (2)"].normalized == "blue" and len(p.other_details) == 3
    assert [v.normalized for v in p.compatible_parts] == ["compatible_parts 1", "compatible_parts 2"] and p.materials[1].raw == "materials  2"
    assert p.specifications[0].category.raw == "Size" and p.operating_conditions[0].unit.normalized == "mm"
    payload = json.loads(p.payload)
    assert payload["other_details"]["Finish"]["raw"] == "matt" and payload["materials"][1]["raw"] == "materials  2"
    rows = store["product_evidence"].read().collect()
    paths = {r.field_path for r in rows}
    assert {"other_details.Colour (2)", "other_details.Finish", "aliases_and_cross_references.1", "certifications.0", "specifications.0.qualifier", "operating_conditions.0.value", "manufacturer"} <= paths
    assert {r.method for r in rows} == {"native_text"} and {r.text for r in rows} == {TEXT}


def test_details_that_become_alike(spark):
    value = lambda raw: {"raw": raw, "evidence": []}
    base = {"record_id": "p", "source_document_id": "d", "part_name": value("x"), "manufacturer": value("m"), "part_number": value("n"), "other_details": {"a  b": value("1 "), "a b": value("ｘ"), "c": value("2")}, "materials": [value("é  1"), None]}
    for text, ascii_only in ((None, False), ("x", True)):
        details = base["other_details"] if text is None else {"a  b": value("1 "), "a b": value("x")}
        told = json.dumps(base | {"other_details": details, "materials": [value("1  1")] if ascii_only else base["materials"]})
        df = spark.createDataFrame([(told,)], "j string").select(F.from_json("j", chunks.PRODUCT).alias("p")).select("p.*")
        r = rules.normalize(df, ascii_only=ascii_only).first()
        assert r.other_details["a b"].normalized == "x" and set(r.other_details) == ({"a b"} if ascii_only else {"a b", "c"})
        assert [m and m.normalized for m in r.materials] == (["1 1"] if ascii_only else ["é 1", None])
    issues = {(i.code, i.path) for i in rules.validate(df).first().issues}
    assert ("missing_evidence", "other_details.a b") in issues and ("missing_evidence", "materials.0") in issues
    assert catalog.evidence(df).count() == 0


class Poison:
    """Fails, in ways of its own, on what some documents say."""

    def generate(self, schema, prompt, evidence):
        text = evidence[0]["text"]
        if "poison" in text:
            raise RuntimeError("the model breaks")
        if "abyss" in text:
            return "[" * 1_000_000
        if "number" in text:
            return "5"
        return Whole().generate(schema, prompt, evidence)


def test_one_bad_document_is_a_row(spark, tmp_path):
    root = f"file://{tmp_path}"
    pages = [("a", 1, TEXT), ("b", 1, TEXT + " poison"), ("c", 1, TEXT + " abyss"), ("d", 1, TEXT + " number"), ("e", 1, TEXT)]
    told = run.run(spark, spark.createDataFrame(pages, PAGE), root, structured=Poison).first()
    assert (told.products, told.documents_succeeded, told.documents_review) == (2, 2, 3)
    store = run.tables(spark, root)
    failed = {r.document_id: (r.stage, r.error) for r in store["failed_chunks"].read().collect()}
    assert failed == {"b": ("generation", "the model breaks"), "c": ("generation", "too deep JSON"), "d": ("guard", "an answer is an object with a list of products")}
    assert {r.source_document_id for r in store["products"].read().collect()} == {"a", "e"} and store["elements"].read().count() == 5


def test_a_text_that_hints_cannot_read_is_an_error_of_its_chunk(spark):
    def find(text, kind):
        if "bad" in text:
            raise ZeroDivisionError("no")
        return hints.candidates_of(text, kind)

    df = spark.createDataFrame([("a", 1, "e1", "text", TEXT), ("b", 1, "e2", "text", "bad")], "document_id string, page_number int, element_id string, element_type string, text string")
    got = {r.document_id: (r.basis, r.raw) for r in hints._candidates(df, ("document_id",), find).collect()}
    assert got["b"] == ("failed", "hints: ZeroDivisionError: no") and got["a"][1] == "Norwick Ltd"
    told = spark.createDataFrame([("a", "single_family", "r", [], [], [], "hints: x")], "document_id string, mode string, reason string, identifiers array<string>, evidence_element_ids array<string>, manufacturers array<string>, error string")
    row = models.generate(told, Poison).first()
    assert (row.payload, row.attempts, row.error) == (None, 0, "hints: x")


def recursive(raw):
    """A cell by recursive descent."""
    at = 0

    def text(inside):
        nonlocal at
        out = []
        while m := tables._TOKEN.match(raw, at):
            at = m.end()
            if m["brace"] == "}" and inside:
                break
            if m["brace"] == "{":
                out.append(text(True))
            elif m["command"]:
                out.append(command(m["command"].lower()))
            else:
                out.append(m["escaped"] or m["plain"] or ("" if m["brace"] else " "))
        return "".join(out)

    def command(name):
        nonlocal at
        groups = []
        for _ in range(2 if name in tables.FRACTIONS else tables.RULES.get(name) or tables.FORMATS.get(name, 0)):
            opening = tables._OPENING.match(raw, at)
            at = opening.end() if opening else at
            groups.append(text(True) if opening else None)
        if name in tables.FRACTIONS and None not in groups:
            return "/".join(groups)
        return " " if name in tables.RULES or not groups else groups[-1] or " "

    return text(False)


def test_cells_of_any_depth():
    r = random.Random(23)
    bits = ["{", "{", "}", "}", r"\textbf{", r"\frac{", r"\multicolumn", r"\hline", r"\cline", "a", "b c", "~", "$", r"\&", "<b>", " ", r"\makecell{x}", "{y}", r"\unknown", r"\\", "é"]
    for _ in range(5000):
        cell = "".join(r.choice(bits) for _ in range(r.randrange(120)))
        assert tables._shown(cell) == recursive(cell), cell
    for deep in ("{" * 1_000_000, r"\textbf{" * 100_000, r"\frac{a}{" * 100_000, "{" * 1_000_000 + "a" + "}" * 1_000_000):
        assert len(tables.clean_cell(deep)) < len(deep)
    assert tables.identifier_column("| Part Number | N |\n| " + "{" * 100_000 + " | b |\n| A-1 | c |", "table") == []


def test_kinds_of_broken_json():
    kinds = {"": "empty", " ": "empty", '{"a": [1': "truncated", '{"a" 1}': "malformed", "[" * 1_000_000: "too deep", "see " + '{"a":' * 1_000_000: "too deep", "{} and []": "malformed", "words": "malformed"}
    for text, kind in kinds.items():
        try:
            untrusted.within(text)
        except untrusted.NotJson as e:
            assert e.kind == kind, (text[:20], e.kind)
        else:
            raise AssertionError(text[:20])
    assert untrusted.within('so: {"a": "[[["} there') == {"a": "[[["} and untrusted.loads('"' + "[" * 1000 + '"') == "[" * 1000
