import pytest
from pyspark.sql import functions as F

from pagewright.operators import routing

GOOD = "The rotary shaft coupling XK-1200/7 carries torque between two aligned shafts in dry rooms at moderate speed without any lubricant."


def decide(spark, text, coverage=0.0, tables=0, columns=False, t=routing.Thresholds()):
    row = spark.createDataFrame([(text, coverage, tables, columns)], "native_text string, image_coverage double, table_count int, is_multi_column boolean")
    return routing.route_pages(row, t).first()


def test_good_text_stays_native(spark):
    r = decide(spark, GOOD)
    assert (r.routing.route, r.routing.requires_ocr, r.routing.reasons) == ("native_text", False, ["native_text_quality_passed"])
    assert r.signals.identifier_count == 1


def test_empty_scan(spark):
    r = decide(spark, "", 1.0)
    assert r.routing.reasons == ["insufficient_native_characters", "insufficient_native_words", "low_alphanumeric_ratio", "image_heavy_layout", "ocr_identifier_verification"]
    assert r.signals.printable_ratio == 1.0 and r.signals.alphanumeric_ratio == 0.0


@pytest.mark.parametrize(("args", "reason"), [((0.0, 1), "table_layout"), ((0.0, 0, True), "multi_column_layout"), ((0.45,), "image_heavy_layout")])
def test_layout(spark, args, reason):
    assert decide(spark, GOOD, *args).routing.reasons[0] == reason
    off = routing.Thresholds(tables=False, columns=False, images=False)
    assert decide(spark, GOOD, *args, t=off).routing.route == "native_text"


def test_broken_glyphs_and_odd_signals(spark):
    assert "corrupt_or_replacement_glyphs" in decide(spark, GOOD + "�" * 20).routing.reasons
    odd = decide(spark, GOOD, float("inf"), -4).signals
    assert (odd.image_coverage, odd.table_count) == (0.0, 0)
    assert decide(spark, None).signals.character_count == 0


def test_median_and_words(spark):
    s = decide(spark, "ab\n\n abcd \nabcdef\nabcdefgh").signals
    assert (s.line_count, s.median_line_length, s.word_count) == (4, 5.0, 4)


def test_layout_estimates(spark):
    box = lambda *b: {"x0": b[0], "y0": b[1], "x1": b[2], "y1": b[3], "is_image": b[4]}
    schema = "b array<struct<x0:double,y0:double,x1:double,y1:double,is_image:boolean>>, w double, h double"
    two = [box(0.0, 0.0, 40.0, 20.0, False), box(0.0, 30.0, 40.0, 50.0, False), box(50.0, 10.0, 90.0, 20.0, False), box(50.0, 60.0, 90.0, 70.0, True)]
    r = spark.createDataFrame([(two, 100.0, 100.0)], schema).select(routing.multi_column(F.col("b"), F.col("w")).alias("m"), routing.image_coverage(F.col("b"), F.col("w"), F.col("h")).alias("c")).first()
    assert r.m and r.c == pytest.approx(0.04)
    apart = [box(0.0, 0.0, 40.0, 10.0, False), box(0.0, 10.0, 40.0, 20.0, False), box(50.0, 30.0, 90.0, 40.0, False), box(50.0, 40.0, 90.0, 50.0, False)]
    assert not spark.createDataFrame([(apart, 100.0, 100.0)], schema).select(routing.multi_column(F.col("b"), F.col("w")).alias("m")).first().m


def test_blank_pages(spark):
    schema = "native_text string, native_blocks array<string>, image_coverage double, table_count int, is_multi_column boolean, image binary, inventory struct<complete:boolean,drawing_count:int,embedded_image_count:int,annotation_count:int,link_count:int>"
    rows = [("  ", [], 0.0, 0, False, None, i) for i in ((True, 0, 0, 0, 0), (True, 1, 0, 0, 0), (True, 0, 1, 0, 0), (True, 0, 0, 1, 0), (True, 0, 0, 0, 1), (False, 0, 0, 0, 0), (True, None, 0, 0, 0))]
    df = spark.createDataFrame(rows, schema)
    assert [r[0] for r in df.select(routing.is_blank(df)).collect()] == [True] + [False] * 6


def test_thresholds_are_checked():
    with pytest.raises(ValueError):
        routing.Thresholds(characters=-1)
    with pytest.raises(ValueError):
        routing.Thresholds(printable=1.5)


def test_lines_and_words_of_odd_texts(spark):
    """F2, F8, F9, F10: lines, words and gaps as they are defined, on texts of which patterns could give back much."""
    from pagewright.functions import text as T

    texts = ["", " ", " a\tb  \r\n\n\x0b c d \x1c\x1fe\x1f", "x" + " " * 50000 + "\n" + "  \t" * 20000, "word " * 300000, "__a.b-/+c, é٣ ..x", "﻿ a　 b c\x85\x00d", "a\n \nb"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, t string")
    got = df.orderBy("i").select(T.lines("t").alias("lines"), T.word_count("t").alias("n"), F.regexp_count("t", F.lit(T.WORDS)).cast("long").alias("all"), T.strip("t").alias("s"), T.blank("t").alias("blank")).collect()
    ends = "\n\r\x0b\x0c\x1c\x1d\x1e\x85  "
    for x, r in zip(texts, got, strict=True):
        for c in ends:
            x = x.replace(c, "\n")
        assert r.lines == [s.strip() for s in x.split("\n") if s.strip()] and r.n == r["all"] and r.blank == (r.s == "")


def test_resumption_reads_each_side_once(spark):
    from pagewright.operators import elements

    pages = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y"), ("c", 1, "z")], "document_id string, page_number int, fingerprint string")
    earlier = spark.createDataFrame([("a", 1, "x", None), ("a", 1, "x", None), ("b", 1, "old", None), ("c", 1, "z", "no service")], "document_id string, page_number int, fingerprint string, error string")
    got = elements.resumption(pages, earlier)
    assert {r.document_id: r.restored for r in got.collect()} == {"a": True, "b": False, "c": False} and got.count() == 3
