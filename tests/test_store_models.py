import json

import pytest
from pyspark.sql import functions as F

from pagewright.operators import catalog, chunks, elements, ops, retrieval
from pagewright.plans import models
from pagewright.sources import readers, store
from pagewright.streaming import incremental

PAGE = "document_id string, page_number int, native_text string"
CHUNK = "chunk_id string, content_sha256 string, chunk_kind string, product_record_id string, source_document_id string, source_path string, page_number int, chunk_type string, ordinal int, text string, citations array<struct<source_document_id:string,source_path:string,page_number:int,element_id:string,excerpt:string,confidence:double,field_paths:array<string>>>"


def test_elements_and_chunks(spark):
    pages = spark.createDataFrame([("d", 3, "one page"), ("d", 4, "  "), ("e", 1, None)], PAGE)
    el = elements.native_elements(pages)
    assert [(r.document_id, r.page_number, r.text, r.confidence) for r in el.collect()] == [("d", 3, "one page", 1.0)]
    two = el.unionByName(el.withColumns({"sequence_number": F.lit(5), "text": F.lit(" "), "element_id": F.lit("el_b")})).unionByName(el.withColumns({"sequence_number": F.lit(7), "text": F.lit("later"), "element_id": F.lit("el_a")}))
    got = chunks.page_chunks(two).orderBy("ordinal").collect()
    assert [(r.ordinal, r.text, r.citations[0].field_paths[0]) for r in got] == [(0, "one page", "pages.3.elements.0.text"), (1, "later", "pages.3.elements.7.text")]
    assert chunks.mismatches(two, pages).count() == 0 and chunks.duplicate_pages(pages.unionByName(pages)).count() == 3


def test_model_answers_become_elements(spark):
    tagged = "<x_0.1><y_0.2>Title<x_0.9><y_0.3><class_Title><x_0><y_0>  <x_1><y_1><class_Text>"
    listed = json.dumps({"elements": [{"text": "a", "type": "Text", "bbox": [1, 2, 3, 4], "confidence": "7"}, {"markdown": " "}, {"html": "<b>b</b>", "confidence": "nan"}]})
    rows = spark.createDataFrame([("d", 1, tagged, "m"), ("d", 2, listed, "m"), ("d", 3, "just prose", "m"), ("d", 4, " ", "m"), ("d", 5, "{}", "m")], "document_id string, page_number int, content string, model string")
    got = {(r.page_number, r.sequence_number): r for r in elements.response_elements(rows).collect()}
    assert {k: v.text for k, v in got.items()} == {(1, 0): "Title", (2, 0): "a", (2, 1): "<b>b</b>", (3, 0): "just prose"}
    assert got[(1, 0)].element_type == "Title" and got[(1, 0)].bbox.x1 == 0.9 and got[(2, 0)].confidence == 1.0 and got[(2, 1)].confidence is None
    assert got[(3, 0)].element_type == "document" and len({r.element_id for r in got.values()}) == 4


def test_table_versions_and_scopes(spark, tmp_path):
    table = store.Table(spark, f"file://{tmp_path}/t", "k string, page int, v int")
    assert table.read().count() == 0
    table.write(spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("b", 1, 1)], table.schema))
    new = spark.createDataFrame([("a", 1, 2)], table.schema)
    table.replace(new, ["k", "page"], sort=["k"])
    assert {tuple(r) for r in table.read().collect()} == {("a", 1, 2), ("a", 2, 1), ("b", 1, 1)}
    gone = spark.createDataFrame([("b",)], "k string")
    assert catalog.replace_scope(table.read(), new.limit(0), ["k"], gone).count() == 2
    left, n = catalog.delete_scope(table.read(), {"k": "a"})
    assert left.count() == 1 and n.first().deleted == 2


def folders(path):
    return {f"{d.name}/{b.name}" for d in path.glob("d-*") for b in d.glob("_bucket=*")}


def test_one_page_of_many_rewrites_one_bucket(spark, tmp_path):
    table = store.Table(spark, f"file://{tmp_path}", "d string, page int, v int", ["d", "page"], 32)
    first = table.write(spark.range(10_000).selectExpr("concat('d', id % 10) as d", "cast(id div 10 as int) as page", "1 as v"))
    before = folders(tmp_path)
    assert len(before) == 32
    second = table.replace(spark.createDataFrame([("d3", 7, 2), ("d3", 7, 3)], table.schema), ["d", "page"])
    assert len(folders(tmp_path) - before) == 1 and table.versions() == [first, second]
    assert table.read().where("v > 1").count() == 2 and table.read().count() == 10_001
    assert table.read(first).count() == 10_000 and table.read(first).where("v > 1").count() == 0
    owners = spark.createDataFrame([("d3", 7), ("d4", 7), ("none", 1)], "d string, page int")
    assert sorted(r.v for r in table.scoped(owners, ["d", "page"]).collect()) == [1, 2, 3]
    third = table.replace(spark.createDataFrame([], table.schema), ["d", "page"], owners)
    assert table.read().count() == 9_998 and table.read(second).count() == 10_001
    assert table.replace(spark.createDataFrame([], table.schema), ["d", "page"]) == third
    assert table.expire(1) >= 2 and table.versions() == [third] and table.read().count() == 9_998
    assert len(folders(tmp_path)) == len(table._manifest()["files"])
    with pytest.raises(ValueError):
        table.read(first)
    with pytest.raises(ValueError):
        table.replace(spark.createDataFrame([], table.schema), ["d"])


def test_two_writers(spark, tmp_path):
    """Writers of different buckets both stay; of two writers of one bucket the second one finds out."""
    table = store.Table(spark, f"file://{tmp_path}", "k int, v int", ["k"], 8)
    row = lambda *x: spark.createDataFrame([x], table.schema)
    table.write(spark.createDataFrame([(k, 0) for k in range(40)], table.schema))
    held = table._manifest()
    bucket = {k: table._touched(held, [row(k, 0)]) for k in range(40)}
    other = next(k for k in range(40) if bucket[k] != bucket[0])
    files = table._files(catalog.replace_scope(table._frame([f for f in held["files"] if f["bucket"] in bucket[0]]), row(0, 1), ["k"]), 8, None)
    table.replace(row(other, 2), ["k"])
    table._commit(held, files, bucket[0])
    assert {(r.k, r.v) for r in table.read().where("v > 0").collect()} == {(0, 1), (other, 2)} and table.read().count() == 40
    with pytest.raises(store.Conflict):
        table._commit(held, files, bucket[0])


def test_tables_of_earlier_forms(spark, tmp_path):
    """A folder with a pointer and without kinds and pages is read, and becomes one of buckets when it is written; its old folder goes with its version."""
    from pagewright.plans import run

    old = [("kb_1", "d1", None, "t1", [("d1", None, 4, "e1", "t1", None, ["p"])]), ("kb_2", "d1", "prd_1", "t2", []), ("kb_3", "d2", None, "t3", [("d2", None, 1, "e2", "t3", None, ["p"])])]
    rows = spark.createDataFrame(old, f"chunk_id string, source_document_id string, product_record_id string, text string, citations array<{run.CITATION}>")
    rows.write.parquet(f"{tmp_path}/knowledge_chunks/v-1")
    (tmp_path / "knowledge_chunks" / "CURRENT").write_text("v-1")
    table = run.tables(spark, f"file://{tmp_path}")["knowledge_chunks"]
    key = lambda df: sorted((r.chunk_id, r.chunk_kind, r.page_number) for r in df.collect())
    want = [("kb_1", "page_evidence", 4), ("kb_2", "product", None), ("kb_3", "page_evidence", 1)]
    assert key(table.read()) == want and table.versions() == []
    gone = spark.createDataFrame([("d2", 1)], "source_document_id string, page_number int")
    table.replace(table.read().limit(0), ["source_document_id", "page_number"], gone)
    assert key(table.read()) == want[:2] and table.versions() == [1] and all(f["bucket"] is not None and f["form"] == 1 for f in table._manifest()["files"])
    step = lambda df: df.withColumn("text", F.upper("text"))
    newer = store.Table(spark, table.path, table.schema, table.key, upgrades=[*table.upgrades, step])
    assert {r.text for r in newer.read().collect()} == {"T1", "T2"}
    newer.replace(newer.read().limit(0), ["source_document_id"], spark.createDataFrame([("d9",)], "source_document_id string"))
    assert {r.text for r in newer.read().collect()} == {"T1", "T2"}


def test_incremental_index(spark, tmp_path):
    table = store.Table(spark, f"file://{tmp_path}/chunks", CHUNK)
    source, mark = f"file://{tmp_path}/in", f"file://{tmp_path}/mark"
    spark.createDataFrame([("d", 1, "old"), ("d", 2, "stays")], PAGE).coalesce(1).write.parquet(source)
    incremental.follow(spark, source, PAGE, table, mark).awaitTermination()
    spark.createDataFrame([("d", 1, "new"), ("d", 3, " ")], PAGE).coalesce(1).write.mode("append").parquet(source)
    incremental.follow(spark, source, PAGE, table, mark).awaitTermination()
    assert {(r.page_number, r.text) for r in table.read().collect()} == {(1, "new"), (2, "stays")}


def test_json_lines(spark, tmp_path):
    path = f"file://{tmp_path}/x"
    df = spark.createDataFrame([(1, None), (2, "b")], "z int, a string")
    store.append_jsonl(df, path)
    store.append_events(df, path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == ['{"a":"b","z":2}', '{"z":1}', '{"z":1}', '{"z":2,"a":"b"}']
    assert readers.read_json(spark, path, "z int, a string").count() == 4
    assert sorted(r.line for r in store.lines(df).collect()) == ['{"a":"b","z":2}', '{"a":null,"z":1}']


def test_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name, raw in (("B.PDF", b"same"), ("sub/a.pdf", b"same"), ("c.jpg", b"x"), ("d.txt", b"y")):
        (tmp_path / name).write_bytes(raw)
    assert [r.path.rsplit("/", 1)[1] for r in readers.discover_pdfs(spark, [f"file://{tmp_path}"]).collect()] == ["B.PDF", "a.pdf"]

    def count(raw):
        if raw == b"x":
            raise ValueError("no pages")
        return 3

    files = readers.inventory(spark, str(tmp_path), ["pdf", ".JPG"], count).collect()
    assert [(r.relative_path, r.page_count) for r in files] == [("B.PDF", 3), ("c.jpg", None), ("sub/a.pdf", 3)] and files[1].page_count_method == "error: no pages"
    assert files[0].sha256 == files[2].sha256 and files[0].document_id != files[2].document_id
    df = spark.createDataFrame([(r.relative_path, r.sha256, r.size_bytes) for r in files], "path string, sha string, size long")
    m = ops.inventory_metrics(df, "sha", "size").first()
    assert (m.file_count, m.unique_count, m.duplicate_file_count, m.duplicate_groups) == (3, 2, 1, 1)
    assert ops.duplicate_groups(df, "sha", "path").first().paths == ["B.PDF", "sub/a.pdf"]
    pages = readers.read_pages(spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(f"file://{tmp_path}"), lambda raw: [{"page_number": 1, "native_text": raw.decode()}])
    assert pages.first().native_text == "y" and pages.first().document_id.startswith("sha256:")


def test_search(spark):
    rows = [("c1", [1.0, 0.0], "product", "Temp 20%"), ("c2", [0.6, 0.8], "page_evidence", "TEMP_x"), ("c3", [0.0, 0.0], "product", "Épate"), ("c4", None, "product", "x"), ("c5", [1.0], "product", "x"), ("c0", [2.0, 0.0], "product", "x")]
    df = spark.createDataFrame(rows, "chunk_id string, embedding array<double>, chunk_kind string, text string")
    assert [(r.chunk_id, r.score) for r in retrieval.similar(df, [1.0, 0.0], 2).collect()] == [("c0", 1.0), ("c1", 1.0)]
    assert [r.chunk_id for r in retrieval.similar(df, [0.0, 1.0], 5, chunk_kind="page_evidence").collect()] == ["c2"]
    for bad in ([], [0.0], [float("nan")]):
        with pytest.raises(ValueError):
            retrieval.similar(df, bad)
    find = lambda q: [r.chunk_id for r in retrieval.search_text(df, q, order=["chunk_id"]).collect()]
    assert find("temp") == ["c1", "c2"] and find("20%") == ["c1"] and find("_") == ["c2"] and find("épate") == [] and len(find("")) == 6


def test_operations(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 9), ("a", 3, 2)], "g string, k int, pages int")
    assert [r.taken for r in ops.page_budget(df, "pages", "k", 8, 4, ["g"]).orderBy("k").collect()] == [4, 4, 0]
    states = spark.createDataFrame([(s,) for s in ("needs_review", "Success", "running", "odd", None)], "s string")
    assert [r.state for r in ops.job_states(states, "s").collect()] == ["review", "succeeded", "running", "unknown", "unknown"]
    with pytest.raises(ValueError):
        ops.page_chunks(df, 0, ["g"], ["k"])


class Scripted:
    def __init__(self, *answers):
        self.answers, self.calls = list(answers), 0

    def post(self, url, headers, payload, timeout):
        self.calls += 1
        x = self.answers.pop(0)
        if isinstance(x, Exception):
            raise x
        return x


def reply(content, reason="stop"):
    return {"choices": [{"message": {"content": content}, "finish_reason": reason}]}


def client(*answers, attempts=4):
    waits: list[float] = []
    return models.ChatClient(Scripted(*answers), "u", "m", models.Retry(attempts), sleep=waits.append), waits


def test_retries():
    c, waits = client(OSError("down"), (503, {}), (200, reply("no json")), (200, reply('{"a":1}')))
    value, attempts = c.complete([], models.decode)
    assert value == {"a": 1} and waits == [0.0, 1.0, 2.0, 4.0] and [a["outcome"] for a in attempts] == ["transport_error", "status", "unusable", "ok"]
    c, _ = client((400, {}))
    with pytest.raises(models.CallFailed):
        c.complete([])
    c, _ = client(*[(200, reply(""))] * 4)
    with pytest.raises(models.CallFailed) as e:
        c.complete([], models.decode)
    assert models.unsupported_content(e.value)
    c, _ = client((200, reply("")), (500, {}), attempts=2)
    with pytest.raises(models.CallFailed) as e:
        c.complete([], models.decode)
    assert not models.unsupported_content(e.value)


def test_decoding():
    for text in ('{"a": 1}', '```json\n{"a": 1}\n```', '<think>{x</think> {"a": 1}', 'Here it is: {"a": 1} as asked'):
        assert models.parse_json(text) == {"a": 1}
    for text, kind in (("", "empty"), ('{"a": [1', "truncated"), ('{"a" 1}', "malformed"), ('{"a": 1} {"b": 2}', "malformed")):
        with pytest.raises(models.NotJson) as e:
            models.parse_json(text)
        assert e.value.kind == kind
    with pytest.raises(models.NotJson):
        models.decode(reply('{"a": 1}', "length"))
    assert models.decode({"output": [{"content": [{"text": "[1]"}]}]}) == [1]
    assert models.decode({"choices": [{"message": {"tool_calls": [{"function": {"arguments": '{"b":2}'}}]}}]}) == {"b": 2}
    assert models.merged({"a": {"x": 1}, "b": 1}, {"a": {"y": 2}, "b": 3}) == {"a": {"x": 1, "y": 2}, "b": 3}


def test_offline_models(spark):
    schema = {"type": "object", "required": ["k", "l"], "properties": {"k": {"enum": ["x", "y"]}, "l": {"type": "array", "minItems": 2}, "m": {"type": "string"}}}
    assert models.offline_value(schema) == {"k": "x", "l": []}
    df = spark.createDataFrame([(i, "same text" if i % 2 else None) for i in range(40)], "i int, text string")
    got = models.embed(df).collect()
    assert len(got) == 40 and len({tuple(r.embedding) for r in got}) == 2
    with pytest.raises(ValueError):
        models.reordered([{"index": 0, "embedding": [1.0]}, {"index": 0, "embedding": [1.0]}], 2)
    assert models.reordered([{"index": 1, "embedding": [2.0]}, {"index": 0, "embedding": [1.0]}], 2) == [[1.0], [2.0]]
    pages = spark.createDataFrame([("d", 1, "x")], PAGE)

    class Fails:
        def read(self, page):
            raise OSError("gone")

    assert models.read_pages(pages, Fails).first().error == "gone" and models.read_pages(pages).first().content == "{}"


def test_resume(spark):
    pages = spark.createDataFrame([("d", 1, "x"), ("d", 2, "y")], PAGE).withColumn("routing", F.struct(F.lit("native_text").alias("route")))
    named = elements.fingerprint(pages)
    old = named.where("page_number = 1").unionByName(named.where("page_number = 2").withColumn("fingerprint", F.lit("stale"))).select("document_id", "page_number", "fingerprint")
    todo, held = elements.pending(named, old)
    assert [r.page_number for r in todo.collect()] == [2] and [r.page_number for r in held.collect()] == [1]


def test_walk_and_status_files(spark, tmp_path):
    (tmp_path / "b.JSON").write_text(json.dumps({"kind": " Own-Job-Status ", "state": "done"}))
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "A.json").write_text(json.dumps({"state": "queued", "job_id": 7}))
    (tmp_path / "c.json").write_text(json.dumps({"state": "x"}))
    (tmp_path / "note.txt").write_text("x")
    (tmp_path / "link.json").symlink_to(tmp_path / "c.json")
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "own.json").write_text("{}")
    w = readers.walk(spark, f"file://{tmp_path}", ["json"], f"file://{tmp_path}/out")
    assert [p.rsplit("/", 1)[1] for p in w.paths] == ["b.JSON", "c.json", "A.json"] and (w.ignored, w.symlinks) == (1, 1)
    found, more = readers.read_status_files(spark, f"file://{tmp_path}", 3)
    assert more and {r.path.rsplit("/", 1)[1]: r.is_status for r in found.collect()} == {"b.JSON": True, "c.json": False, "own.json": False}
    assert readers.read_status_files(spark, f"file://{tmp_path}/sub", 3)[1] is False


def test_page_objects_and_changes(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.4 /Type /Pages /Type /Page /Type/Page >>")
    (tmp_path / "b.pdf").write_bytes(b"none")
    got = readers.inventory(spark, str(tmp_path), ["pdf"]).collect()
    assert [(r.page_count, r.page_count_method[:5], r.changed_during_read) for r in got] == [(2, "parse", False), (None, "error", False)]


def test_json_document(spark, tmp_path):
    store.write_json(spark, f"file://{tmp_path}/x.json", {"b": 1, "a": "é"})
    store.write_json(spark, f"file://{tmp_path}/x.json", {"b": 2})
    assert json.loads((tmp_path / "x.json").read_text()) == {"b": 2}
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["x.json"]


def test_boxes_texts_and_trees():
    assert elements.box_of([1, "2", 3, 4]) == (1.0, 2.0, 3.0, 4.0) == elements.box_of({"left": 1, "top": 2, "right": 3, "bottom": 4}) == elements.box_of({"x": 1, "y": 2, "width": 2, "height": 2})
    assert elements.box_of({"x0": 1, "y0": 2, "x1": 3}) is None and elements.box_of("1234") is None and elements.box_of([1, 2, 3]) is None
    assert elements.text_of({"text": "", "content": ["a"], "value": "b"}) == '["a"]' and elements.text_of({}) == ""
    tree = {"pages": [{"elements": [{"element_id": "a"}, [{"element_id": "b"}]]}, {"elements": []}], "x": {"element_id": "no"}}
    assert [e["element_id"] for e in elements.walk(tree)] == ["a", "b"]


def test_chunks_that_contradict_themselves(spark):
    page = ("a", None, "page_evidence", None, "d", None, 1, "page_element", 0, "t", None)
    rows = [page, ("b", None, "page_evidence", "p", "d", None, 0, "identity", -1, " ", None), ("c", None, "product", None, "d", None, 2, "identity", 0, "t", None)]
    got = {}
    for r in chunks.inconsistent(spark.createDataFrame(rows, CHUNK)).collect():
        got.setdefault(r.chunk_id, set()).add(r.problem)
    assert got == {"b": {"chunk_type", "owner", "page_number", "ordinal", "text"}, "c": {"owner", "page_number"}}
    vectors = spark.createDataFrame([page, ("z", *page[1:])], CHUNK).withColumn("embedding", F.when(F.col("chunk_id") == "a", F.array(F.lit(1.0), F.lit(float("nan")))).otherwise(F.array(F.lit(1.0))))
    assert [tuple(r) for r in chunks.inconsistent(vectors).collect()] == [("a", "embedding")]


def test_a_copy_that_cannot_be_written_is_an_issue(spark, tmp_path):
    (tmp_path / "file").write_text("x")
    assert store.try_append(spark.range(1), f"file://{tmp_path}/file/x.jsonl", "products_jsonl_write_failed")[0].startswith("products_jsonl_write_failed")
    assert store.try_append(spark.range(1), f"file://{tmp_path}/y.jsonl", "c") == []
