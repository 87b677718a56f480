"""PDF pages: text, blocks, counts and layout of files that are made here; what is damaged is a row."""

import base64
import json
import random
import zlib

import pytest
from pyspark.sql import functions as F

from pagewright import cli
from pagewright.operators import routing
from pagewright.plans import run
from pagewright.sources import pdf, pdf_text, readers


def made(objects: dict[int, bytes], trailer: bytes = b"/Root 1 0 R") -> bytes:
    out, places = b"%PDF-1.4\n", {}
    for n, body in objects.items():
        places[n] = len(out)
        out += b"%d 0 obj\n" % n + body + b"\nendobj\n"
    table = b"".join(b"%d 1\n%010d 00000 n \n" % (n, at) for n, at in places.items())
    return out + b"xref\n" + table + b"trailer\n<<%s>>\nstartxref\n%d\n%%%%EOF" % (trailer, len(out))


def stream(data: bytes, info: bytes = b"") -> bytes:
    return b"<<%s/Length %d>>\nstream\n%s\nendstream" % (info, len(data), data)


FONT = b"<</Type/Font/Subtype/Type1/BaseFont/H/Encoding<</BaseEncoding/WinAnsiEncoding/Differences[1/eacute/fi 3/uni6728]>>/FirstChar 0/Widths[%s]>>" % (b"500 " * 256)


def one_page(contents: bytes, more: bytes = b"", objects: dict | None = None, resources: bytes = b"/Font<</F 5 0 R>>") -> bytes:
    page = b"<</Type/Page/Parent 2 0 R/Contents 4 0 R/Resources<<%s>>%s>>" % (resources, more)
    return made({1: b"<</Type/Catalog/Pages 2 0 R>>", 2: b"<</Kids[3 0 R]/Count 1/MediaBox[0 0 600 800]>>", 3: page, 4: stream(contents), 5: FONT} | (objects or {}))


def only(raw: bytes) -> dict:
    rows = list(pdf.pages(raw))
    assert len(rows) == 1 and "error" not in rows[0], rows
    return rows[0]


@pytest.mark.parametrize("packed", [False, True])
def test_texts_come_back(packed):
    pages = [["Hello wörld 木", "  two  spaces"], [], ["(𝛼) \\ <x>", *[f"line {k}" for k in range(40)]]]
    got = list(pdf.pages(pdf_text.text_pdf(pages, packed)))
    assert [r["page_number"] for r in got] == [1, 2, 3]
    assert [r["native_text"] for r in got] == ["\n".join(x.strip() for x in p) for p in pages]
    assert [len(r["native_blocks"]) for r in got] == [1, 0, 1] and all(r["inventory"]["complete"] for r in got)
    assert pdf.page_count(pdf_text.text_pdf(pages, packed)) == 3
    shares = [[r["page_number"] for r in pdf.pages(pdf_text.text_pdf(pages, packed), k, 2)] for k in range(2)]
    assert shares == [[1], [2, 3]]


def test_operators_of_text():
    text = rb"""BT /F 10 Tf 12 TL 50 700 Td (A\101\(\)\\) Tj T* [(wo) -20 (rd) -700 (next)] TJ (third) ' 0 Tc 1 2 (f o) " 1 0 0 1 50 600 Tm <0102 03> Tj ET"""
    got = only(one_page(text))
    assert got["native_text"].split("\n") == ["AA()\\", "word next", "third", "f o", "éfi木"]
    assert [b["text"].count("\n") for b in got["native_blocks"]] == [3, 0]
    box = got["native_blocks"][1]["bbox"]
    assert (box["x0"], box["x1"], box["y0"], box["y1"]) == pytest.approx((50, 50 + 3 * (5 + 2), 192, 202)) and (got["width"], got["height"]) == (600, 800)


def test_turned_pages_and_forms():
    form = stream(b"BT /F 10 Tf 0 0 Td (inside) Tj ET", b"/Type/XObject/Subtype/Form/Matrix[1 0 0 1 100 100]/Resources<</Font<</F 5 0 R>>>>")
    loop = stream(b"/X Do", b"/Type/XObject/Subtype/Form/Resources<</XObject<</X 7 0 R>>>>")
    got = only(one_page(b"q 1 0 0 1 0 300 cm /X Do Q /L Do", b"/Rotate 90", {6: form, 7: loop}, b"/XObject<</X 6 0 R/L 7 0 R>>"))
    assert got["native_text"] == "inside" and (got["width"], got["height"]) == (800, 600)
    box = got["native_blocks"][0]["bbox"]
    assert (box["x0"], box["y0"]) == pytest.approx((398, 100)) and box["x1"] - box["x0"] == pytest.approx(10)


def test_counts_of_objects_and_scans():
    jpeg = stream(b"\xff\xd8jpeg\xff\xd9", b"/Type/XObject/Subtype/Image/Filter/DCTDecode")
    notes = b"/Annots[<</Subtype/Link>><</Subtype/Text>><</Subtype/Link>><</Subtype/Widget>>]"
    inline = b"q 60 0 0 80 0 0 cm BI /W 1 /H 1 /BPC 8 /CS /G ID \x00EI x EI Q"
    got = only(one_page(b"0 0 m 10 10 l S 0 0 5 5 re f n q 600 0 0 400 0 0 cm /I Do Q " + inline, notes, {6: jpeg}, b"/XObject<</I 6 0 R/J 6 0 R>>"))
    assert got["inventory"] == {"complete": True, "drawing_count": 2, "embedded_image_count": 2, "annotation_count": 1, "link_count": 2}
    assert got["image_coverage"] == pytest.approx(0.51) and got["image"] == b"\xff\xd8jpeg\xff\xd9" and got["native_text"] == ""


def test_filters_and_predictors():
    text = b"BT /F 10 Tf 50 700 Td (packed) Tj ET"
    for data, how in ((zlib.compress(text), b"/FlateDecode"), (base64.a85encode(text) + b"~>", b"/ASCII85Decode"), (text.hex().encode() + b">", b"/ASCIIHexDecode"), (base64.a85encode(zlib.compress(text)) + b"~>", b"[/ASCII85Decode/FlateDecode]")):
        assert only(one_page(b"", b"", {4: stream(data, b"/Filter" + how)}))["native_text"] == "packed"
    assert only(one_page(b"", b"", {4: stream(zlib.compress(text * 50)[:-9], b"/Filter/FlateDecode")}))["native_text"].startswith("packed")
    r = random.Random(3)
    rows = [bytes(r.randrange(256) for _ in range(12)) for _ in range(20)]
    coded, above = b"", bytes(12)
    for k, row in enumerate(rows):
        left, corner = bytes(3) + row[:-3], bytes(3) + above[:-3]
        paeth = [min((abs(b - c), 0, a), (abs(a - c), 1, b), (abs(a + b - 2 * c), 2, c))[2] for a, b, c in zip(left, above, corner, strict=True)]
        by = [bytes(12), left, above, [(a + b) // 2 for a, b in zip(left, above, strict=True)], paeth][k % 5]
        coded += bytes([k % 5]) + bytes((x - y) & 255 for x, y in zip(row, by, strict=True))
        above = row
    assert pdf._predicted(coded, {"Predictor": 15, "Colors": 3, "Columns": 4}) == b"".join(rows)


def test_damage_is_a_row():
    good = pdf_text.text_pdf([["first"], ["second"]])
    assert [r["native_text"] for r in pdf.pages(good.replace(b"startxref", b"startxxxx"))] == ["first", "second"]
    assert [r["native_text"] for r in pdf.pages(good[: good.rindex(b"xref\n0")] + b"trailer <</Root 1 0 R>>")] == ["first", "second"]
    for raw, why in ((b"", "not a PDF"), (b"%PDF-1.4 nothing", "no pages"), (b"%PDF-1.4\n1 0 obj " + b"[" * 100_000, "no pages"), (good.replace(b"/Root 1 0 R", b"/Root 1 0 R/Encrypt 9 0 R"), "encrypted")):
        rows = list(pdf.pages(raw))
        assert len(rows) == 1 and why in rows[0]["error"] and "page_number" not in rows[0]
    broken = one_page(b"", b"", {4: stream(b"zzzz", b"/Filter/FlateDecode")})
    assert [(r["page_number"], r["error"][:5]) for r in pdf.pages(broken)] == [(1, "error")]
    unknown = one_page(b"", b"", {4: stream(b"zzzz", b"/Filter/LZWDecode")})
    assert "LZWDecode" in next(pdf.pages(unknown))["error"]
    circle = made({1: b"<</Type/Catalog/Pages 2 0 R>>", 2: b"<</Kids[2 0 R 3 0 R 2 0 R]>>", 3: b"<</Kids[2 0 R 4 0 R]>>", 4: b"<</Type/Page>>"})
    assert [r["page_number"] for r in pdf.pages(circle)] == [1]
    bomb = one_page(b"", b"", {4: stream(zlib.compress(bytes(pdf.INFLATED + 1)), b"/Filter/FlateDecode")})
    assert "beyond bounds" in next(pdf.pages(bomb))["error"]


def test_random_damage_never_raises():
    r = random.Random(7)
    for k in range(400):
        raw = bytearray(pdf_text.text_pdf([["some text", "more"], ["b"]], k % 2 == 0))
        for _ in range(r.choice([1, 5, 60])):
            raw[r.randrange(len(raw))] = r.randrange(256)
        assert all(("error" in p) != ("native_text" in p) for p in pdf.pages(bytes(raw)))


def test_columns_and_layout(spark, tmp_path):
    lines = lambda x, top: b"".join(b"BT /F 10 Tf %d %d Td (block %d) Tj ET " % (x, top - 40 * k, k) for k in range(3))
    (tmp_path / "two.pdf").write_bytes(one_page(lines(50, 700) + lines(400, 695)))
    (tmp_path / "one.PDF").write_bytes(one_page(lines(50, 700)))
    (tmp_path / "bad.pdf").write_bytes(b"%PDF-1.4")
    (tmp_path / "long.pdf").write_bytes(pdf_text.text_pdf([[f"page {k}"] for k in range(30)]))
    found = readers.pdf_pages(spark, str(tmp_path), 1000).cache()
    got = {r.source_path.rsplit("/", 1)[1]: r for r in found.where("page_number = 1").collect()}
    assert got["two.pdf"].is_multi_column and not got["one.PDF"].is_multi_column and got["two.pdf"].inventory.complete
    assert [b.text for b in got["two.pdf"].native_blocks][:2] == ["block 0", "block 0"]
    assert "multi_column_layout" in routing.route_pages(found.where("source_path like '%two.pdf'")).first().routing.reasons
    long = found.where("source_path like '%long.pdf'")
    assert [r.native_text for r in long.orderBy("page_number").collect()] == [f"page {k}" for k in range(30)] and long.select(F.spark_partition_id()).distinct().count() > 3
    assert [r.source_path.rsplit("/", 1)[1] for r in found.where("error is not null").collect()] == ["bad.pdf"]
    same = readers.read_pages(readers.discover_pdfs(spark, [f"file://{tmp_path}"], content=True))
    key = lambda df: sorted((r.document_id, r.page_number or 0, r.native_text or "", r.error or "") for r in df.collect())
    assert key(same) == key(found)


def test_a_sweep_finds_the_columns_that_pairs_find(spark):
    r = random.Random(9)
    rows = []
    for _ in range(400):
        boxes = [(x, y, x + r.choice([5, 30, 60]), y + r.choice([-2, 0, 3, 9])) for x, y in [(r.uniform(0, 95), float(r.randrange(40))) for _ in range(r.randrange(8))]]
        left, right = [b for b in boxes if b[2] <= 58.0], [b for b in boxes if b[0] >= 42.0]
        want = len(boxes) >= 4 and min(len(left), len(right)) >= 2 and any(min(a[3], b[3]) - max(a[1], b[1]) > 0 for a in left for b in right)
        rows.append(([tuple(map(float, b)) for b in boxes], want))
    df = spark.createDataFrame(rows, "b array<struct<x0:double,y0:double,x1:double,y1:double>>, want boolean")
    assert df.where(routing.multi_column(F.col("b"), F.lit(100.0)) != F.col("want")).count() == 0 and df.where("want").count() > 20


def test_a_run_over_files(spark, tmp_path, capsys):
    text = "Manufacturer: Norwick Ltd\nThe shaft ring family carries torque between two aligned shafts in dry rooms\nat moderate speed without any lubricant at all."
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "good.pdf").write_bytes(pdf_text.text_pdf([text.split("\n"), text.split("\n")[:2]]))
    (tmp_path / "in" / "bad.pdf").write_bytes(b"%PDF-1.4 cut off")
    root = f"file://{tmp_path}/out"
    assert cli.main(["run", "--pdf", str(tmp_path / "in"), root]) == 1
    told = json.loads(capsys.readouterr().out.splitlines()[-1])
    assert (told["documents"], told["documents_failed"], told["pages"], told["page_errors"]) == (2, 1, 3, 1)
    error = run.tables(spark, root)["page_errors"].read().first()
    assert error.page_number == 0 and "no pages" in error.error
    assert run.tables(spark, root)["elements"].read().where("bbox is not null").count() == 2


def test_codes_of_a_font_are_read_as_before():
    """codes of two bytes are unpacked at once; what has no text or half a code, and widths of all kinds, come out as one by one."""
    font = pdf.Font.__new__(pdf.Font)
    font.size, font.missing, font.width, font.text, font.even = 2, 500.0, {}, pdf._Texts({1: "a", 2: "ß", 0xD800: "x"}), True
    assert font.read(bytes.fromhex("00010002d8000009")) == ("aßx�", 2000.0, 4, 0) and font.read(b"")[0:3:2] == ("", 0)
    assert font.read(bytes.fromhex("000102")) == ("aß", 1000.0, 2, 0)
    font.width, font.even = {1: 250.5}, False
    assert font.read(bytes.fromhex("00010002")) == ("aß", 750.5, 2, 0)
    font.size, font.text = 1, pdf._Texts({32: " ", 65: "A"})
    assert font.read(b"A A") == ("A A", 1500.0, 3, 1)


def test_pages_of_many_files_are_handed_on_together(spark, monkeypatch):
    """one frame holds the pages of many files, and none is lost where a frame ends within a file or a file is damaged."""
    files = [(str(i), bytearray(pdf_text.text_pdf([[f"file {i} page {k}"] for k in range(1 + i % 3)])) if i % 5 else bytearray(b"x")) for i in range(20)]
    df = spark.createDataFrame(files, "path string, content binary").coalesce(1)
    want = {(str(i), k + 1) for i in range(20) if i % 5 for k in range(1 + i % 3)} | {(str(i), None) for i in range(0, 20, 5)}
    for size in (readers.FRAME, 5000):
        monkeypatch.setattr(readers, "FRAME", size)
        got = [(r.source_path, r.page_number) for r in readers.read_pages(df).select("source_path", "page_number").collect()]
        assert len(got) == len(want) and set(got) == want
