import json
import random

import pytest

from pagewright.plans import budget, calls, config, models, run

PAGE = "document_id string, page_number int, native_text string, image binary"


def in_memory(spark):
    """Parks frames by their rows, so tests write no tables."""
    return lambda rows, name: spark.createDataFrame(rows.collect(), rows.schema)


def sequential(documents, limit, fails):
    """One document after the other, as far as the budget goes; what fails spends nothing."""
    taken, left = [], limit
    for name in sorted(documents):
        if left <= 0:
            break
        own = documents[name][:left]
        taken += [(name, n) for n in own]
        left -= 0 if name in fails else len(own)
    return taken, left


@pytest.mark.parametrize("seed", range(4))
def test_a_budget_is_spent_by_outcome(spark, seed):
    rng = random.Random(seed)
    documents = {f"d{i:02}": sorted(rng.sample(range(1, 30), rng.randint(1, 6))) for i in range(8)}
    fails = {d for d in documents if rng.random() < (0, 0.3, 0.6, 1)[seed]}
    limit = (14, 14, 7, 200)[seed]
    pages = spark.createDataFrame([(d, p) for d, own in documents.items() for p in own], "document_id string, page_number int")
    seen, waves = [], []

    def process(rows):
        got = [tuple(r) for r in rows.select("document_id", "page_number").collect()]
        seen.extend(got)
        waves.append(len(got))
        return spark.createDataFrame([(d,) for d in sorted({d for d, _ in got} & fails)], "document_id string")

    left = budget.spend(pages, limit, process, in_memory(spark))
    want, rest = sequential(documents, limit, fails)
    assert sorted(seen) == sorted(want) and left == rest
    assert seed != 0 or len(waves) <= 2


def test_no_budget_is_one_wave_and_no_pages_are_none(spark):
    pages = spark.createDataFrame([("a", 1), ("b", 1)], "document_id string, page_number int")
    waves = []
    assert budget.spend(pages, None, lambda rows: waves.append(rows.count()), in_memory(spark)) is None and waves == [2]
    assert budget.spend(pages.limit(0), 5, lambda rows: waves.append(0), in_memory(spark)) == 5 and waves == [2]


class Ended(BaseException):
    """What ends a task: no operator catches it."""


def counted(log, stop_at=None):
    """A page model that writes a line for each call into a file, and ends its task at one of them."""

    class Counted:
        def read(self, page):
            with open(log, "a") as f:
                f.write(f"{page['document_id']}\n")
            if stop_at is not None and len(open(log).readlines()) == stop_at:
                raise Ended
            return json.dumps({"elements": [{"text": f"page of {page['document_id']}"}]})

    return Counted


def test_a_task_that_is_tried_again_repeats_no_call(spark, tmp_path):
    pages = spark.createDataFrame([(f"d{i}", 1, "", bytes([i])) for i in range(8)], PAGE).repartition(1)
    log, folder = f"{tmp_path}/log", f"file://{tmp_path}/calls"
    with pytest.raises(Exception, match="Ended"):
        models.read_pages(pages, calls.remembered(counted(log, 5), folder)).collect()
    first = open(log).read().split()
    assert len(first) == 5 and calls.answers(spark, folder).count() == 4
    got = {r.document_id: r.content for r in models.read_pages(pages, calls.remembered(counted(log), folder)).collect()}
    # Only the call that was under way when the task ended is made once more.
    assert len(open(log).read().split()) == 9 and got == {f"d{i}": json.dumps({"elements": [{"text": f"page of d{i}"}]}) for i in range(8)}
    calls.forget(folder)
    assert calls.answers(spark, folder).count() == 0


def test_only_usable_answers_are_kept(tmp_path):
    class Tries:
        asked = []

        def generate(self, schema, prompt, evidence):
            self.asked.append(prompt)
            return "no JSON" if len(self.asked) == 1 else '{"products": []}'

        def embed(self, texts, query=False):
            self.asked.append(tuple(texts))
            return [[float(len(t)), 1.0] for t in texts]

        def read(self, page):
            self.asked.append("page")
            raise models.CallFailed([{"attempt": 1, "outcome": "transport_error"}])

    make = calls.remembered(Tries, str(tmp_path))
    assert make().generate({}, "p", []) == "no JSON" and make().generate({}, "p", []) == '{"products": []}' == make().generate({}, "p", [])
    assert Tries.asked == ["p", "p"]
    assert make().embed(["a", "bb", "a"]) == [[1.0, 1.0], [2.0, 1.0], [1.0, 1.0]] and make().embed(["bb", "ccc"]) == [[2.0, 1.0], [3.0, 1.0]]
    assert Tries.asked[2:] == [("a", "bb"), ("ccc",)] and make().embed([]) == [] and make().embed(["a"], query=True) == [[1.0, 1.0]]
    for _ in range(2):
        with pytest.raises(models.CallFailed):
            make().read({"document_id": "d"})
    assert Tries.asked[-2:] == ["page", "page"]


def test_keys_tell_requests_and_models_apart(tmp_path):
    keys = {calls.request_key(k, m, r) for k in ("page", "structured") for m in ("a", "b") for r in ({"x": 1}, {"x": "1"}, {"x": b"1"}, {"x": b"2"}, {"x": None})}
    assert len(keys) == 20 and calls.request_key("page", "a", {"x": 1, "y": 2}) == calls.request_key("page", "a", {"y": 2, "x": 1})
    one, two = (models.ImagePages(models.ChatClient(None, "http://h", m), "read") for m in ("m1", "m2"))
    assert calls.identity(one) != calls.identity(two) and calls.identity(models.HashedEmbeddings(8)) != calls.identity(models.HashedEmbeddings(16))
    journal = calls.Journal(str(tmp_path))
    journal.put("ab", "page", "é", [])
    assert journal.get("ab")["answer"] == "é" and journal.get("ac") is None
    (tmp_path / "ab" / "ab.json").write_text("{")
    assert journal.get("ab") is None


def test_a_run_spends_its_budget_by_outcome_and_keeps_a_journal(spark, tmp_path):
    class Picky:
        def read(self, page):
            if page["document_id"] == "b":
                raise OSError("no service")
            return json.dumps({"elements": [{"text": f"page {page['page_number']} of {page['document_id']}"}]})

    pages = spark.createDataFrame([(d, p, "", b"x") for d in "abcd" for p in (1, 2)], PAGE)
    root = f"file://{tmp_path}"
    r = run.run(spark, pages, root, config.Config(limits=config.Limits(pages=5), journal=True, embed=False, buckets=2), page_model=Picky).first()
    store = run.tables(spark, root)
    assert {(x.document_id, x.page_number) for x in store["extractions"].read().collect()} == {("a", 1), ("a", 2), ("c", 1), ("c", 2), ("d", 1)}
    assert (r.documents, r.pages, r.page_errors, r.documents_failed) == (4, 7, 2, 1) and not (tmp_path / "_calls").exists()
