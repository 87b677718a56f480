import json

import pytest

from pagewright import cli
from pagewright.operators import catalog
from pagewright.plans import config, models, run
from pagewright.sources import readers

PAGE = "document_id string, page_number int, native_text string"
TEXT = "Manufacturer: Norwick Ltd\nThe shaft ring family carries torque between two aligned shafts in dry rooms at moderate speed without any lubricant at all."
TABLE = TEXT + "\nPart Number | Bore\nA-1 | 1\nB-1 | 2"


class Reader:
    """Answers every chunk with what its schema and prompt allow, and cites what they name."""

    def generate(self, schema, prompt, evidence):
        assert evidence and all(e["text"] for e in evidence)
        product = schema["properties"]["products"]["items"]["properties"]
        maker = product["manufacturer"]["properties"]
        ref = lambda p: [{"element_id": p["evidence"]["items"]["properties"]["element_id"]["enum"][0]}]
        name = {"raw": maker["raw"]["enum"][0], "evidence": ref(maker)}
        if "part_number" in product:
            number = product["part_number"]["properties"]
            return json.dumps({"products": [{"manufacturer": name, "part_name": name, "part_number": {"raw": x, "evidence": ref(number)}} for x in number["raw"]["enum"]]})
        return json.dumps({"products": [{"manufacturer": name, "part_name": {"raw": "Ring", "evidence": [{"element_id": "el_unknown"}]}}]})


def test_offline_run_resumes(spark, tmp_path):
    pages = [("a", 1, TEXT), ("a", 2, TEXT + " again"), ("a", 3, ""), ("b", 1, TEXT)]
    root = f"file://{tmp_path}"
    first = run.run(spark, spark.createDataFrame(pages, PAGE), root).first()
    assert (first.documents, first.pages, first.checkpoint_hits, first.products) == (2, 4, 0, 0) and first.elements == 3 == first.chunks
    again = run.run(spark, spark.createDataFrame([*pages[1:3], ("b", 1, "New text. " + TEXT)], PAGE), root).first()
    assert again.checkpoint_hits == 2 and again.chunks == 3
    got = run.tables(spark, root)["knowledge_chunks"].read()
    assert got.where("source_document_id = 'b'").first().text.startswith("New text.") and got.where("source_document_id = 'a'").count() == 2


def test_products_are_admitted_or_rejected(spark, tmp_path, capsys):
    root = f"file://{tmp_path}"
    pages = spark.createDataFrame([("a", 1, TABLE), ("b", 1, TEXT)], PAGE)
    r = run.run(spark, pages, root, structured=Reader).first()
    assert (r.products, r.rejected, r.documents_review, r.documents_succeeded) == (2, 1, 1, 1)
    store = run.tables(spark, root)
    assert {x.part_number.normalized for x in store["products"].read().collect()} == {"A-1", "B-1"}
    assert "unknown_evidence_reference" in {i.code for i in store["rejected_products"].read().first().issues}
    kinds = {k: n for k, n in store["knowledge_chunks"].read().groupBy("chunk_kind").count().collect()}
    assert kinds == {"page_evidence": 2, "product": 2}
    same = run.run(spark, pages, root, structured=Reader).first()
    assert (same.products, same.rejected, same.chunks) == (2, 1, 4)
    assert cli.main(["query", root, "part number: a-1"]) == 0
    out = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert len(out) == 1 and out[0]["chunk_kind"] == "product" and out[0]["score"] is None
    assert cli.main(["query", root, "Norwick Ltd", "--vector", "--limit", "2"]) == 0 and len(capsys.readouterr().out.splitlines()) == 2
    assert cli.main(["query", root, "x", "--limit", "0"]) == 2


def test_a_failing_page_is_a_row(spark, tmp_path):
    class Down:
        def read(self, page):
            raise OSError("no service")

    pages = spark.createDataFrame([("a", 1, "short"), ("b", 1, TEXT)], PAGE)
    r = run.run(spark, pages, f"file://{tmp_path}", page_model=Down).first()
    assert (r.documents_failed, r.documents_succeeded, r.page_errors) == (1, 1, 1)


def test_limits(spark):
    pages = spark.createDataFrame([(d, p, TEXT) for d in "abc" for p in (1, 2, 3)], PAGE)
    take = lambda **x: sorted((r.document_id, r.page_number) for r in run.limited(pages, config.Config(limits=config.Limits(**x))).collect())
    assert take(documents=1, pages_per_document=2) == [("a", 1), ("a", 2)] and len(take()) == 9


def test_configuration(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("pages_per_parse: 3\nrouting:\n  characters: 10\nlimits:\n  documents: 2\n")
    c = config.from_yaml(str(path))
    assert (c.pages_per_parse, c.routing.characters, c.limits.documents, c.mode) == (3, 10, 2, "offline")
    assert config.Endpoint.from_env("X", env={"X_URL": "http://h", "X_TIMEOUT": "5"}).timeout == 5
    for bad in ({"mode": "live"}, {"pages_per_parse": 0}, {"unknown": 1}, {"limits": {"pages": 0}}):
        with pytest.raises(ValueError):
            config.from_mapping(bad)


FULL = readers.PAGE


def full(document, page, text, image=b"img", coverage=0.0, complete=False):
    return (document, page, text, [], image, 600.0, 800.0, coverage, 0, False, (complete, 0, 0, 0, 0))


class Sees:
    """Reads what it is given: the image as text, in two elements, one nested in the other."""

    def read(self, page):
        return json.dumps({"elements": [{"text": bytes(page["image"]).decode(), "bbox": {"x": 1, "y": 2, "width": 3, "height": 4}, "blocks": [{"content": {"b": 1, "a": "é"}, "bbox": {"left": 0, "top": 0, "right": 1, "bottom": 1}}]}]})


class Verifies:
    def read(self, page):
        return json.dumps([{"text": f"ocr of {bytes(page['image']).decode()}"}, {"text": " "}])


class Unusable:
    """Every attempt is answered with nothing that can be used."""

    def read(self, page):
        raise models.CallFailed([{"attempt": 1, "outcome": "unusable", "status": 200}])


def test_models_see_images_and_ocr_follows(spark, tmp_path):
    pages = spark.createDataFrame([full("a", 1, TEXT), full("a", 2, "", b"scan"), full("a", 3, "", None, complete=True), full("a", 4, TEXT, b"art", coverage=0.9)], FULL)
    root = f"file://{tmp_path}"
    r = run.run(spark, pages, root, page_model=Sees, ocr_model=Verifies).first()
    assert (r.ocr_pages, r.blank_pages, r.page_errors, r.elements) == (3, 1, 0, 7)
    got = run.tables(spark, root)["elements"].read().orderBy("page_number", "sequence_number").collect()
    read = [(e.page_number, e.sequence_number, e.extraction_method, e.text) for e in got if e.page_number in (2, 4)]
    assert read == [
        (2, 0, "document_vlm", "scan"), (2, 1, "document_vlm", '{"a": "é", "b": 1}'), (2, 2, "ocr_verification", "ocr of scan"),
        (4, 0, "document_vlm", "art"), (4, 1, "document_vlm", '{"a": "é", "b": 1}'), (4, 2, "ocr_verification", "ocr of art"),
    ]
    assert tuple(got[1].bbox)[:4] == (1.0, 2.0, 4.0, 6.0) and len({e.element_id for e in got}) == 7
    audits = {(x.page_number, x.event) for x in run.tables(spark, root)["page_audits"].read().collect()}
    assert audits == {(2, "answered"), (2, "ocr_answered"), (3, "deterministic_blank_page"), (4, "answered"), (4, "ocr_answered")}


def test_failed_pages_are_tried_again(spark, tmp_path):
    class Down:
        def read(self, page):
            raise OSError("no service")

    pages = spark.createDataFrame([full("a", 1, "short", b"scan"), full("b", 1, TEXT, b"art", coverage=0.9)], FULL)
    root = f"file://{tmp_path}"
    first = run.run(spark, pages, root, page_model=Down).first()
    assert (first.page_errors, first.elements, first.documents_failed) == (2, 0, 2)
    # A service that is down is no reason to take the native text; an answer that can't be used is, if the text is good.
    second = run.run(spark, pages, root, page_model=Unusable).first()
    assert (second.page_errors, second.elements, second.checkpoint_hits) == (1, 1, 0)
    kept = run.tables(spark, root)["elements"].read().first()
    assert kept.document_id == "b" and kept.metadata["vlm_fallback"] == "true"
    third = run.run(spark, pages, root, page_model=Sees).first()
    assert (third.page_errors, third.checkpoint_hits, third.documents_failed) == (0, 1, 0)
    with pytest.raises(run.RunFailed):
        run.run(spark, pages.withColumn("native_text", pages["document_id"]), root, config.Config(fail_fast=True), page_model=Down)


def test_catalogue_tables(spark, tmp_path):
    root = f"file://{tmp_path}"
    run.run(spark, spark.createDataFrame([("a", 1, TABLE), ("b", 1, TEXT)], PAGE), root, structured=Reader)
    store = {k: t.read() for k, t in run.tables(spark, root).items()}
    products = {x.record_id: x for x in store["products"].collect()}
    assert {x.review_status for x in products.values()} == {"needs_review"} and all("missing_specifications:specifications" in x.validation_warnings for x in products.values())
    assert {x.product_record_id for x in store["batch_products"].collect()} == set(products)
    one = next(iter(products))
    cited = catalog.get_evidence(store["product_evidence"], one).collect()
    assert {x.field_path for x in cited} == {"manufacturer", "part_name", "part_number"} and all(x.text for x in cited)
    assert catalog.get_evidence(store["product_evidence"], one, "part_number").count() == 1
    assert {x.document_id: x.status for x in store["documents"].collect()} == {"a": "succeeded", "b": "review"}
    assert catalog.get_batch(store["ingestion_batches"], store["ingestion_batches"].first().batch_id).count() == 1
    assert store["knowledge_chunks"].where("embedding is null").count() == 0
    assert catalog.find_products(store["products"].selectExpr("record_id", "review_status", "manufacturer.raw manufacturer", "part_number.raw part_number"), review_status="NEEDS_REVIEW").count() == 2


def test_live_clients(spark):
    class Scripted:
        sent = []

        def post(self, url, headers, payload, timeout):
            self.sent.append((url, headers, payload))
            if "input" in payload:
                return 200, {"data": [{"index": 1, "embedding": [0.0, 1.0]}, {"index": 0, "embedding": [1.0, 0.0]}]}
            return 200, {"choices": [{"message": {"content": '{"products": []}'}, "finish_reason": "stop"}]}

    point = lambda name: {"url": f"http://{name}", "model": name, "api_key": "k"}
    live = config.from_mapping({"mode": "live", "page_model": point("page"), "ocr_model": point("ocr"), "structured_model": point("structured"), "embedding_model": point("embedding")})
    made = models.clients(live, Scripted)
    assert made.page().read({"image": b"\x89PNG"}) == '{"products": []}'
    assert Scripted.sent[-1][2]["messages"][0]["content"][1]["image_url"]["url"] == "data:image/png;base64,iVBORw==" and Scripted.sent[-1][1] == {"Authorization": "Bearer k"}
    assert made.structured().generate({"type": "object"}, "p", [{"element_id": "el_1", "text": "t"}]) and "el_1" in Scripted.sent[-1][2]["messages"][1]["content"]
    assert made.embedding().embed(["a", "b"]) == [[1.0, 0.0], [0.0, 1.0]] and Scripted.sent[-1][2]["input"] == ["passage: a", "passage: b"]
    assert made.ocr() is not None and models.clients(config.Config()).ocr is None
    with pytest.raises(ValueError):
        made.page().read({"image": None})
    with pytest.raises(ValueError):
        models.GuidedStructured(None, mode="other")
    assert models.excerpt("a\0" + "b" * 300) == "a\\0" + "b" * 237 and models.excerpt({"x": 1}, tail=True, limit=3) == " 1}"
