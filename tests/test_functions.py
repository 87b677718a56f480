import hashlib
import random
import struct

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagewright.functions import tables
from pagewright.functions import text as T


def one(spark, value, f, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(f(F.col("v")).alias("r")).first().r


def test_normal_forms(spark):
    assert one(spark, "  ﬁne  print ", T.whitespace) == "fine print"
    assert one(spark, "  abc–12 − x", T.part_number) == "ABC-12 - X"
    assert [one(spark, u, T.unit) for u in ("Degrees  C", "MILLIMETRES", "μm", "µm", "furlong")] == ["°C", "mm", "µm", "µm", "furlong"]
    assert one(spark, "ÉCOLE Straße", T.fold) == "École straße".replace("É", "É") .replace("cole", "cole")
    assert one(spark, "Straße", T.casefold) == "strasse"


def test_whitespace_matches_python(spark):
    odd = "".join(chr(c) for c in [*range(1, 0x100), *range(0x1680, 0x1690), *range(0x2000, 0x2070), 0x3000])
    assert one(spark, odd, T.collapse) == " ".join(odd.split())


def test_prefixed_hash(spark):
    parts = ["a", "", "é😀"]
    want = hashlib.sha256(b"".join(len(p.encode()).to_bytes(8, "big") + p.encode() for p in parts)).hexdigest()
    assert spark.range(1).select(T.prefixed_hash(*[F.lit(p) for p in parts])).first()[0] == want


def test_identifiers_stand_alone(spark):
    df = spark.createDataFrame([("part A.1(b) here", "A.1(b)"), ("xA.1", "A.1"), ("A.1-2", "A.1"), ("a.1", "A.1")], "t string, i string")
    assert [r[0] for r in df.select(T.contains_identifier("t", "i")).collect()] == [True, False, False, False]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.text("abc 1", min_size=1, max_size=5).map(str.strip).filter(bool), min_size=2, max_size=4), min_size=1, max_size=5))
def test_html_rows_round_trip(grid):
    html = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in grid)
    assert tables.rows(html) == [[" ".join(c.split()) for c in r] for r in grid]


def test_latex_table():
    text = r"\begin{tabular}{|c|c|} \hline \multicolumn{2}{|c|}{Couplings} \\ \hline \textbf{Size} & Bore \\ A1\_x & $\frac{1}{2}$ \\[2pt] B2 & 3\,mm \& up \\ C3 & {x & y} \\ \end{tabular}"
    rows = tables.rows(text)
    assert rows[0] == ["Couplings"] and rows[1] == ["Size", "Bore"] and rows[2] == ["A1_x", "1/2"] and rows[4] == ["C3", "x & y"]
    assert tables.identifier_column(text, "text") == ["A1_x", "B2", "C3"]


def test_identifier_columns():
    bar = "Part Number | Bore | Material\nQ-100 | 10mm | steel\nQ-200 | 12mm | steel"
    assert tables.identifier_column(bar, "text") == ["Q-100", "Q-200"]
    assert tables.identifier_column("Size | Bore\n10mm | 1\n12mm | 2", "text") == []
    assert tables.identifier_column("Size | Bore\nSmall | 1\nLarge | 2", "text") == []
    assert tables.identifier_column("Part Number | Bore\nQ-100 | 1\nq-100 | 2", "text") == []
    assert tables.identifier_column("Part No.  Name\nAA-1  x\nAA-2  y", "text") == []
    assert tables.identifier_column("Part No.  Name\nAA-1  x\nAA-2  y", "table") == ["AA-1", "AA-2"]


def test_rows_in_columns(spark):
    assert one(spark, "| a | b |\nplain\n|c|d|", T.bar_rows) == [["a", "b"], ["c", "d"]]
    assert one(spark, "<TR><td>a <b>x</b></td><th>b</th></TR><tr><td>single</td></tr>", T.html_rows) == [["a x", "b"]]


def test_numbers_are_the_shortest_that_give_the_double_back(spark):
    rng = random.Random(11)
    rows = [0.0, -0.0, 1.0, 1e-4, 1e-5, 9.999e-5, 1e15, 1e16, 1e17, 5e-324, 2e23, 2.0**-44, 1.7976931348623157e308, 2.2250738585072014e-308, -1.0164619483135988e18, 2.0**63, float("inf"), -float("inf"), float("nan"), 0.1 + 0.2]
    rows += [rng.random() for _ in range(40_000)] + [round(rng.uniform(-1e6, 1e6), rng.randint(0, 8)) for _ in range(40_000)]
    rows += [float(rng.getrandbits(63)) for _ in range(5_000)] + [rng.getrandbits(rng.randint(1, 52)) * 5e-324 for _ in range(5_000)] + [2.0**k for k in range(-1074, 1024, 7)]
    shown = lambda values: [tuple(r) for r in spark.createDataFrame([(x,) for x in values], "x double").repartition(8).select("x", T.number("x").alias("t")).collect()]
    got = shown([*rows, None])
    assert [(x, t) for x, t in got if t != (None if x is None else repr(x))] == [] and len(got) == len(rows) + 1
    # Of any bits: as short, and the same double again. The last of 17 digits is Java's, and may not be the nearest.
    odd = [(x, t) for x, t in shown([struct.unpack("d", rng.randbytes(8))[0] for _ in range(50_000)]) if t != repr(x)]
    assert len(odd) < 10 and all(float(t) == x and len(t) == len(repr(x)) and sum(c.isdigit() for c in t.split("e")[0]) == 17 for x, t in odd)
