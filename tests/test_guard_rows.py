import json
import random

import pytest

from pagewright.functions import tables, untrusted
from pagewright.operators import guard, guard_rows, hints

TEXTS = [
    ("e0", "Manufactured by Norwick Ltd"), ("e1", "## Shaft Ring"), ("e2", "<b>Long Ring</b>"), ("e3", "Part Number | Bore\nA-1 | 1\nB-1 | 2\nC 1 | 3\nxD-1 | 4"), ("e4", "A-1, C 1 and D(é; Shaft Ring"), ("e5", ""),
]
IDS = ["A-1", "B-1", "C 1", "D(é"]


def value(raw, *ids):
    return {"raw": raw, "evidence": [{"element_id": x} for x in ids]}


def product(r, number):
    """Mostly as it should be; at times with a fault."""
    often = lambda good, *other: good if r.random() < 0.97 else r.choice(other)
    title = r.choice([value("Shaft Ring", "e1"), value("Shaft Ring", "e1", "e4"), value("Ring", "e1"), value("Long Ring", "e2")]) if r.random() < 0.2 else value("Shaft Ring", "e1")
    p = {"manufacturer": often(value("Norwick Ltd", "e0"), value("Norwick Ltd", "e1"), value("Other Ltd", "e0"), value("Norwick Ltd", "e0", "e9"), 3, {"raw": "\ud800", "evidence": 1}), "part_name": often(title, value(" "), value("Absent", "e1"), None)}
    p["part_number"] = often(value(number, "e3" if number == "B-1" else "e4"), value(number, "e3"), value(number, "e1"), value(number, "e3", "e3"), value("Z-9", "e3"), {"raw": number}, None)
    if r.random() < 0.03:
        p["category"] = value("x", "e1")
    return often(p, "x", 7, [], {})


def test_rows_are_guarded_as_whole_answers_are(spark):
    """what joins tell of products as rows is what ``Guard`` tells of each answer as a whole."""
    r = random.Random(4)
    answers, hinted, found, want, passed = [], [], [], {}, {}
    for n in range(300):
        c = f"c{n}"
        ids = r.choice([IDS, IDS, IDS, IDS[:2], IDS[:3], ["A-1", "A-1"], ["A-1", "E-1"], ["D-1", "A-1"], []])
        cited = r.choice([["e3", "e4"], ["e3", "e4"], ["e4", "e3"], ["e3"], [], ["e3", "e3"], ["e3", "gone"]]) if r.random() < 0.4 else ["e3", "e4"]
        makers = [("Norwick Ltd", "e0")] if r.random() < 0.9 else []
        elements = r.choice([[], [*TEXTS, ("e1", "twice")], TEXTS]) if r.random() < 0.1 else TEXTS
        mode = "single_family" if r.random() < 0.15 else "multi_product_rows"
        numbers = [r.choice(ids or IDS) for _ in range(len(ids) or 1)] if r.random() < 0.7 else list(ids)
        told = [product(r, x) for x in (numbers if r.random() < 0.9 else numbers[1:])]
        answers += [(c, i, json.dumps(p)) for i, p in enumerate(told)]
        hinted.append((c, mode, ids, cited, [{"raw": a, "element_id": b} for a, b in makers]))
        found += [(c, *e) for e in elements]
        good, audit = guard.Guard(mode, ids, cited, makers, elements or None).enforce({"products": told})
        repair, dropped = audit["identity_row_repair"] or {}, audit["dropped_products"]
        want[c] = (
            mode, len(told), audit["final_product_count"], audit["dropped_product_count"], dropped[0]["reason"] if dropped else None, (audit["cardinality_violation"] or {}).get("reason"), bool(repair), repair.get("applied", False),
            repair.get("reason"),
        )
        passed[c] = good["products"]
    answers = spark.createDataFrame(answers, "document_id string, place int, product string")
    hint = spark.createDataFrame(hinted, "document_id string, mode string, identifiers array<string>, evidence_element_ids array<string>, manufacturers array<struct<raw:string,element_id:string>>")
    elements = spark.createDataFrame(found, "document_id string, element_id string, text string")
    keep = lambda rows, name: rows.localCheckpoint()
    verdicts, rows = guard_rows.enforce(answers, hint, elements, answered=hint.select("document_id"), park=keep)
    assert {v[0]: tuple(v[1:]) for v in verdicts.collect()} == want
    assert {x[8] for x in want.values() if x[6]} >= {None, "part_number_evidence_is_not_from_cardinality_elements", "part_name_identity_is_not_exactly_source_backed", "expected_identifier_not_exactly_source_backed"}
    got = {c: [] for c in passed}
    for x in rows.orderBy("place", "at").collect():
        got[x.document_id].append(json.loads(x.product))
    assert got == passed


def test_spellings_of_a_chunk_come_from_rows(spark):
    """The first of spellings that differ in case only, across elements; elements of which all spellings were there before are cited too."""
    table = lambda *ids: "Part Number | Bore\n" + "\n".join(f"{x} | 1" for x in ids)
    found = [("d", 1, 2, "b", "table", table("q-1", "Q-3", "Q-2")), ("d", 1, 1, "c", "table", table("Q-2", "Q-1", "q-2")), ("d", 2, 1, "a", "table", table("q-3", "Q-1")), ("d", 1, 3, "x", "text", "none"), ("n", 1, 1, "y", "text", "none")]
    got = {r.document_id: r for r in hints.cardinality(spark.createDataFrame(found, "document_id string, page_number int, sequence_number int, element_id string, element_type string, text string")).collect()}
    assert got["d"].identifiers == ["Q-2", "Q-1", "Q-3"] and got["d"].evidence_element_ids == ["c", "b", "a"] and got["d"].mode == "multi_product_rows"
    assert got["n"].identifiers == [] and got["n"].evidence_element_ids == [] and got["n"].mode == "single_family"


def _columns_of_a_grid(text, kind):
    """Identifiers as they were found with all rows in memory."""
    if not tables.looks_like_table(text, kind):
        return []
    grid = [[tables.clean_cell(c) for c in r] for r in tables.rows(text, "table" in kind.casefold())]
    is_header = lambda c: bool(tables.ORDERABLE_HEADER.search(c) or tables.SIZE_HEADER.fullmatch(c))
    for top, header in enumerate(grid):
        named = [(i, tables.orderable) for i, c in enumerate(header) if tables.ORDERABLE_HEADER.search(c)]
        sized = [(i, tables.code_like) for i, c in enumerate(header) if tables.SIZE_HEADER.fullmatch(c) and not tables.ORDERABLE_HEADER.search(c)]
        below = grid[top + 1 :]
        stop = next((k for k, r in enumerate(below) if any(map(is_header, r))), len(below))
        for i, fits in named + sized:
            found = [r[i] for r in below[:stop] if i < len(r) and fits(r[i])]
            if len({v.casefold() for v in found}) > 1:
                return found
    return []


def test_identifiers_are_read_row_by_row():
    r = random.Random(5)
    cells = ["Part Number", "Size", "SKU", "A-1", "a-1", "B2", "10mm", "Small", "", r"\textbf{C-3}", "<b>D4</b>", "Product size code", "-"]
    for _ in range(3000):
        text = "\n".join(r.choice([" | ", "\t", "  "]).join(r.choice(cells) for _ in range(r.randrange(1, 4))) for _ in range(r.randrange(8)))
        kind = r.choice(["table", "text"])
        assert tables.identifier_column(text, kind) == _columns_of_a_grid(text, kind), text


def test_what_is_no_text_is_refused_as_before():
    for x in (None, float("nan"), 3, b"{}"):
        with pytest.raises(TypeError):
            untrusted.loads(x)
    with pytest.raises(untrusted.NotJson):
        untrusted.loads("[" * 129 + "]" * 129)
    assert untrusted.loads("[" * 128 + "]" * 128) and untrusted.loads(json.dumps(["{" * 500])) == ["{" * 500]
