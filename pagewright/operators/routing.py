"""Page routing: signals of the native text, and the ordered reasons against taking a page as it is."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions import text as T

NATIVE, VISION = "native_text", "document_vlm"
#: Reasons in the order in which they are told.
REASONS = (
    "insufficient_native_characters", "insufficient_native_words", "low_printable_ratio", "low_alphanumeric_ratio",
    "corrupt_or_replacement_glyphs", "table_layout", "multi_column_layout", "image_heavy_layout",
)
PASSED, VERIFY = "native_text_quality_passed", "ocr_identifier_verification"


@dataclass(frozen=True)
class Thresholds:
    characters: int = 80
    words: int = 12
    printable: float = 0.95
    alphanumeric: float = 0.35
    replacement: float = 0.01
    coverage: float = 0.45
    tables: bool = True
    columns: bool = True
    images: bool = True
    verify_vision: bool = True
    verify_native: bool = False

    def __post_init__(self):
        if min(self.characters, self.words) < 0:
            raise ValueError("least counts must not be negative")
        if not all(0 <= x <= 1 for x in (self.printable, self.alphanumeric, self.replacement, self.coverage)):
            raise ValueError("ratios lie between 0 and 1")


def signals(native: Column, coverage: Column | None = None, tables: Column | None = None, columns: Column | None = None, identifiers: bool = True) -> Column:
    """A struct of a page's signals. A missing text counts as empty; a coverage that is no finite number as 0. Identifiers are counted if asked for, and null otherwise."""
    text = F.coalesce(native, F.lit(""))
    count = lambda p: F.regexp_count(text, F.lit(p)).cast("long")
    broken = text.contains("\ufffd") | text.contains("\0")
    # Characters of a class: what removing its runs takes away, which makes no list of matches.
    of_class = lambda p: (F.length(text) - F.length(F.regexp_replace(text, f"{p}+", ""))).cast("long")

    def measured(lengths: Column) -> Column:
        n = F.size(lengths)
        middle = (F.element_at(lengths, F.floor((n + 1) / 2).cast("int")) + F.element_at(lengths, F.floor(n / 2).cast("int") + 1)) / 2.0
        return F.struct(n.cast("long").alias("n"), F.when(n > 0, middle).otherwise(0.0).alias("median"))

    ratio = lambda a, b, empty: F.when(b > 0, F.least(F.lit(1.0), a / b)).otherwise(F.lit(empty))
    cover = F.coalesce(coverage, F.lit(0.0)) if coverage is not None else F.lit(0.0)
    cover = F.when(F.isnan(cover) | (F.abs(cover) == float("inf")), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cover)))
    # What is used more than once is worked out once for each text.
    counted = F.struct(
        T.once(F.sort_array(F.transform(T.lines(text), lambda s: F.length(s))), measured).alias("line"),
        F.length(F.regexp_replace(text, f"{T.SPACE}+", "")).cast("long").alias("solid"),
        F.length(text).cast("long").alias("size"),
    )

    def told(c: Column) -> Column:
        return F.struct(
            c["solid"].alias("character_count"),
            T.word_count(text).alias("word_count"),
            c["line"]["n"].alias("line_count"),
            ratio(c["size"] - of_class(r"[\p{C}\p{Z}&&[^ \n\r\t]]"), c["size"], 1.0).alias("printable_ratio"),
            ratio(of_class(T.ALNUM), c["solid"], 0.0).alias("alphanumeric_ratio"),
            ratio(F.when(broken, of_class(r"[\x{fffd}\x00]")).otherwise(F.lit(0).cast("long")), F.greatest(c["solid"], F.lit(1)), 0.0).alias("replacement_character_ratio"),
            c["line"]["median"].alias("median_line_length"),
            cover.alias("image_coverage"),
            (F.greatest(F.lit(0), F.coalesce(tables, F.lit(0))) if tables is not None else F.lit(0)).cast("int").alias("table_count"),
            (F.coalesce(columns, F.lit(False)) if columns is not None else F.lit(False)).alias("is_multi_column"),
            (count(T.IDENTIFIERS) if identifiers else F.lit(None).cast("long")).alias("identifier_count"),
        )

    return T.once(counted, told)


def decide(s: Column, t: Thresholds = Thresholds()) -> Column:
    """Route, whether OCR has to verify it, and the reasons, from a struct of signals."""
    told = (
        s["character_count"] < t.characters, s["word_count"] < t.words, s["printable_ratio"] < t.printable, s["alphanumeric_ratio"] < t.alphanumeric,
        s["replacement_character_ratio"] > t.replacement, F.lit(t.tables) & (s["table_count"] > 0), F.lit(t.columns) & s["is_multi_column"], F.lit(t.images) & (s["image_coverage"] >= t.coverage),
    )
    against = F.array_compact(F.array(*[F.when(c, F.lit(r)) for c, r in zip(told, REASONS, strict=True)]))
    vision = F.size(against) > 0
    verify = F.when(vision, F.lit(t.verify_vision)).otherwise(F.lit(t.verify_native) & (s["identifier_count"] > 0))
    reasons = F.concat(F.when(vision, against).otherwise(F.array(F.lit(PASSED))), F.when(verify, F.array(F.lit(VERIFY))).otherwise(F.array().cast("array<string>")))
    return F.struct(F.when(vision, VISION).otherwise(NATIVE).alias("route"), verify.alias("requires_ocr"), reasons.alias("reasons"))


def route_pages(pages: DataFrame, t: Thresholds = Thresholds(), identifiers: bool = True) -> DataFrame:
    """Adds ``signals`` and ``routing`` to pages (``native_text``, and ``image_coverage, table_count, is_multi_column`` where there are such). Identifiers are counted if asked for, or if the decision needs them."""
    has = lambda c: F.col(c) if c in pages.columns else None
    found = signals(F.col("native_text"), has("image_coverage"), has("table_count"), has("is_multi_column"), identifiers or t.verify_native)
    return pages.withColumn("signals", found).withColumn("routing", decide(F.col("signals"), t))


def table_count(text: Column) -> Column:
    """1 where at least three lines, and a fifth of all that are not blank, look tabular."""
    # Without a tab or a gap within a line no line is tabular, and then none is cut out.
    gap = text.contains("\t") | text.rlike(rf"[{T.SPACE}&&[^\n]]{{2}}")
    lines = F.when(gap, F.regexp_extract_all(text, F.lit(T.WHOLE_LINE), F.lit(0))).otherwise(F.array().cast("array<string>"))

    def judged(rows: Column) -> Column:
        tabular = F.size(F.filter(rows, lambda s: s.contains("\t") | s.rlike(rf"[^\s]{T.SPACE}{{2,}}[^\s]{T.SPACE}{{2,}}[^\s]")))
        enough = lambda n: (F.size(rows) >= 3) & (n >= 3) & (n / F.greatest(F.size(rows), F.lit(1)) >= 0.2)
        return F.when(T.once(tabular, enough), 1).otherwise(0)

    return T.once(lines, judged)


def image_coverage(boxes: Column, width: Column, height: Column) -> Column:
    """The share of the page that images cover; boxes are ``x0, y0, x1, y1, is_image``."""
    area = lambda b: F.greatest(F.lit(0.0), b["x1"] - b["x0"]) * F.greatest(F.lit(0.0), b["y1"] - b["y0"])
    total = F.aggregate(F.filter(boxes, lambda b: b["is_image"]), F.lit(0.0), lambda a, b: a + area(b))
    return F.least(F.lit(1.0), total / F.greatest(F.lit(1.0), width * height))


def multi_column(boxes: Column, width: Column) -> Column:
    """Whether two blocks on the left and two on the right of a page stand side by side somewhere: one sweep over the blocks from the top, which knows how far down either side reaches."""
    is_left, is_right = lambda b: b["x1"] <= width * 0.58, lambda b: b["x0"] >= width * 0.42
    sides = F.array_sort(F.transform(boxes, lambda b: F.struct(b["y0"].cast("double").alias("top"), b["y1"].cast("double").alias("end"), is_left(b).alias("left"), is_right(b).alias("right"))))
    none = F.lit(float("-inf"))
    start = F.struct(none.alias("left"), none.alias("right"), F.lit(False).alias("found"))

    def step(s: Column, b: Column) -> Column:
        meets = (b["left"] & (s["right"] > b["top"])) | (b["right"] & (s["left"] > b["top"])) | (b["left"] & b["right"])
        reach = lambda side: F.when(b[side], F.greatest(s[side], b["end"])).otherwise(s[side])
        return F.struct(reach("left").alias("left"), reach("right").alias("right"), (s["found"] | (meets & (b["end"] > b["top"]))).alias("found"))

    enough = lambda test: F.size(F.filter(boxes, test)) >= 2
    return F.coalesce((width > 0) & (F.size(boxes) >= 4) & enough(is_left) & enough(is_right) & F.aggregate(sides, start, step, lambda s: s["found"]), F.lit(False))


def layout(pages: DataFrame) -> DataFrame:
    """Pages with ``table_count`` and ``is_multi_column`` from their text and blocks, and ``image_coverage`` from blocks of images, where a page does not say itself."""
    boxed = F.filter(F.coalesce("native_blocks", F.array().cast(pages.schema["native_blocks"].dataType)), lambda b: b["bbox"].isNotNull())
    boxes = F.transform(boxed, lambda b: F.struct(*[b["bbox"][c].alias(c) for c in ("x0", "y0", "x1", "y1")], (b["element_type"] == "image").alias("is_image")))
    told = {"table_count": table_count(F.col("native_text")), "is_multi_column": multi_column(boxes, F.col("width")), "image_coverage": image_coverage(boxes, F.col("width"), F.col("height"))}
    return pages.withColumns({c: F.coalesce(F.col(c), x) if c in pages.columns else x for c, x in told.items()})


def is_blank(p: DataFrame) -> Column:
    """Certainly blank: the inventory is complete, its four counts are 0, and nothing else was seen on the page."""
    empty = (F.trim(F.coalesce(p["native_text"], F.lit(""))) == "") & (F.size(F.coalesce(p["native_blocks"], F.array())) == 0)
    seen = (F.coalesce(p["table_count"], F.lit(0)) == 0) & (F.coalesce(p["image_coverage"], F.lit(0.0)) == 0) & ~F.coalesce(p["is_multi_column"], F.lit(False)) & p["image"].isNull()
    i = p["inventory"]
    counts = [i[c] == 0 for c in ("drawing_count", "embedded_image_count", "annotation_count", "link_count")]
    out = empty & seen & i["complete"]
    for c in counts:
        out = out & c
    return F.coalesce(out, F.lit(False))


def route_histogram(routed: DataFrame) -> DataFrame:
    return routed.groupBy(F.col("routing.route").alias("route")).agg(F.count("*").alias("pages"), F.count_if("routing.requires_ocr").alias("ocr_pages"))
