"""Text functions with the exact Unicode classes that the engine's rules are stated in."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space as Unicode and the separators U+001C to U+001F have it.
SPACE = r"[\p{IsWhite_Space}\x1c-\x1f]"
WORD = r"[\p{L}\p{N}_]"
ALNUM = r"[\p{L}\p{N}]"
_SOLID = r"[^\p{IsWhite_Space}\x1c-\x1f]"
_IN_LINE = r"[^\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"
#: White space within a line.
_GAP = r"[\p{IsWhite_Space}\x1f&&[^\n\r\x0b\x0c\x85\x{2028}\x{2029}]]"
#: What a line that is not blank has from its first to its last visible character, and such a line as a whole. All line ends are white space. Nothing is given back: each character is read a fixed number of times.
STRIPPED_LINE = f"{_SOLID}++(?:{_GAP}++{_SOLID}++)*+"
WHOLE_LINE = f"(?<!{_GAP}){_GAP}*+{_SOLID}{_IN_LINE}*+"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"
#: A word starts with a word character and goes on over dots, slashes, plus and minus signs.
WORDS = r"[\p{L}\p{N}_][\p{L}\p{N}_./+\-]*"
_EDGE = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"
#: Runs of letters and digits joined by single separators, with at least one of either and four characters.
IDENTIFIERS = rf"(?<!{WORD})(?=[A-Za-z0-9][A-Za-z0-9._/\-]{{3,}}{_EDGE})(?=[A-Za-z0-9._/\-]*[A-Za-z])(?=[A-Za-z0-9._/\-]*[0-9])[A-Za-z0-9]+(?:[._/\-][A-Za-z0-9]+)+(?!{WORD})"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Spellings of units, in lower case.
UNITS = {
    "degrees c": "°C", "degree c": "°C", "deg c": "°C", "celsius": "°C", "degrees f": "°F", "degree f": "°F", "deg f": "°F", "fahrenheit": "°F",
    "millimeter": "mm", "millimeters": "mm", "millimetre": "mm", "millimetres": "mm", "centimeter": "cm", "centimeters": "cm", "meter": "m", "meters": "m",
    "kilogram": "kg", "kilograms": "kg", "gram": "g", "grams": "g", "volts": "V", "volt": "V", "amps": "A", "amp": "A", "ampere": "A", "amperes": "A",
    "watts": "W", "watt": "W", "kilowatts": "kW", "kilowatt": "kW", "hertz": "Hz", "megapascal": "MPa", "megapascals": "MPa", "kilopascal": "kPa",
    "kilopascals": "kPa", "pounds per square inch": "psi",
}
#: Hyphen, non-breaking hyphen, figure dash, en dash, em dash, minus sign.
DASHES = "‐‑‒–—−"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def fold(x: Column | str) -> Column:
    """ASCII-only case folding, as for keys that compare without case."""
    return F.translate(_col(x), UPPER, LOWER)


def strip(x: Column | str) -> Column:
    return F.regexp_replace(_col(x), f"^{SPACE}+|{SPACE}+$", "")


def blank(x: Column | str) -> Column:
    """Whether nothing is left of a text when it is stripped; null for null."""
    return ~_col(x).rlike(_SOLID)


def collapse(x: Column | str) -> Column:
    """Every run of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(_col(x), f"{SPACE}+", " "))


def lines(x: Column | str) -> Column:
    """Stripped lines that are not blank."""
    return F.regexp_extract_all(_col(x), F.lit(STRIPPED_LINE), F.lit(0))


def word_count(x: Column | str) -> Column:
    """How many ``WORDS`` a text has: of each only its first character is kept, so no list of them is made."""
    first = rf"[^\p{{L}}\p{{N}}_]*+(?:({WORD})[\p{{L}}\p{{N}}_./+\-]*+|\z)"
    return F.length(F.regexp_replace(_col(x), first, "$1")).cast("long")


def once(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f(x)`` with ``x`` worked out once, however often ``f`` uses it: a column's expression is repeated at each use, a lambda's parameter is not."""
    return F.element_at(F.transform(F.array(x), f), 1)


def contains_folded(x: Column | str, query: str) -> Column:
    """Substring test without ASCII case; the query's characters all stand for themselves."""
    return fold(x).contains(query.translate(str.maketrans(UPPER, LOWER)))


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


@F.pandas_udf(StringType())
def _casefold(s: pd.Series) -> pd.Series:
    return s.map(str.casefold, na_action="ignore")


def casefold(x: Column | str, ascii_only: bool = False) -> Column:
    """Full case folding; with ``ascii_only`` the caller vouches that lower-casing is enough, which stays in the JVM."""
    return F.lower(_col(x)) if ascii_only else _casefold(_col(x))


def whitespace(x: Column | str, ascii_only: bool = False) -> Column:
    """Compatibility composition, then single spaces."""
    x = _col(x)
    return collapse(x if ascii_only else _nfkc(x))


def part_number(x: Column | str, ascii_only: bool = False) -> Column:
    return F.upper(whitespace(F.translate(_col(x), DASHES, "-" * len(DASHES)), ascii_only))


def unit(x: Column | str, ascii_only: bool = False) -> Column:
    """The sign of a spelled unit; what has none stays, with single spaces. Micro signs come out as U+00B5."""
    clean = F.translate(whitespace(x, ascii_only), "μ", "µ")
    table = F.create_map(*[F.lit(v) for pair in UNITS.items() for v in pair])
    return F.coalesce(F.try_element_at(table, casefold(clean, ascii_only)), clean)


def prefixed_hash(*parts: Column) -> Column:
    """SHA-256 over each part's length in bytes (eight bytes, big-endian) and its bytes."""
    pieces = [x for p in parts for x in (F.unhex(F.lpad(F.hex(F.octet_length(p).cast("long")), 16, "0")), F.encode(p, "UTF-8"))]
    return F.sha2(F.concat(*pieces), 256)


def quoted(x: Column | str) -> Column:
    """A text that a regular expression takes literally."""
    return F.regexp_replace(_col(x), r"([\\.\[\]{}()*+?^$|\-/])", r"\\$1")


def contains_identifier(text: Column | str, identifier: Column | str) -> Column:
    """Whether the identifier stands in the text without letters, digits or any of ``. _ / -`` next to it; case counts."""
    edge = F.lit("[A-Za-z0-9._/\\-]")
    return F.regexp_like(_col(text), F.concat(F.lit("(?<!"), edge, F.lit(")"), quoted(identifier), F.lit("(?!"), edge, F.lit(")")))


def display(raw: Column, normalized: Column) -> Column:
    """What is shown of a value: its normal form, else its raw one. Maps and lists are JSON text by then, as the boundary reads them into columns of text."""
    return strip(F.coalesce(normalized, raw, F.lit("")))


def finite(x: Column | str) -> Column:
    """A number from text, or null where it is none or not finite."""
    d = _col(x).try_cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) < float("inf")), d)


def html_rows(x: Column | str, row: str = "tr", cell: str = "t[hd]") -> Column:
    """Rows of cells of an HTML table, without tags, with single spaces; rows of one cell are left out."""
    whole = F.regexp_extract_all(_col(x), F.lit(rf"(?is)<{row}\b[^>]*>(.*?)</{row}>"), F.lit(1))
    cells = lambda r: F.transform(F.regexp_extract_all(r, F.lit(rf"(?is)<{cell}\b[^>]*>(.*?)</{cell}>"), F.lit(1)), lambda c: collapse(F.regexp_replace(c, "<[^>]+>", " ")))
    return F.filter(F.transform(whole, cells), lambda r: F.size(r) >= 2)


def bar_rows(x: Column | str) -> Column:
    """Rows of cells of lines with bars; lines of one cell are left out."""
    inner = lambda s: F.regexp_replace(s, r"^\|+|\|+$", "")
    rows = F.transform(F.filter(lines(x), lambda s: s.contains("|")), lambda s: F.transform(F.split(inner(s), r"\|"), collapse))
    return F.filter(rows, lambda r: F.size(r) >= 2)


def number(x: Column | str) -> Column:
    """A double as text: the fewest digits that give it back, without an exponent from 0.0001 up to below 1e16, and ``1e-05`` or ``1.5e+16`` beyond; ``nan``, ``inf`` and ``-inf``; null for null.

    Limit: where a double needs 17 digits, the last one is Java's, which in Java 17 is not always the nearest that gives the double back (one of some 80,000 random bit patterns differs from Python's
    ``repr``; none of 80,000 numbers between -10^6 and 10^6 did). Spark's own text of a double is that of the Java version it runs on, which may have a digit too many, and has another notation (``1.0E-4``), so neither belongs in a hash.
    """
    value = _col(x).cast("double")

    def digits(s: Column) -> Column:
        """Digits without zeros around them, and where the point stands before the first one."""
        whole, exponent = F.regexp_extract(s, r"^(\d+)", 1), F.coalesce(F.regexp_extract(s, r"E(-?\d+)$", 1).try_cast("int"), F.lit(0))
        every = F.concat(whole, F.regexp_extract(s, r"\.(\d+)", 1))
        led = F.regexp_replace(every, "^0+", "")
        return F.struct(F.regexp_replace(led, "0+$", "").alias("d"), (F.length(whole) + exponent - (F.length(every) - F.length(led))).alias("at"))

    def fewest(n: Column) -> Column:
        """Only texts of 16 digits and more, and those of subnormal numbers, can be shortened. Of two of one length the nearer one comes first."""

        def cut(k: Column) -> Column:
            low = F.substring(n["d"], F.lit(1), k).cast("decimal(20,0)")
            up = F.substring(n["d"], k + 1, F.lit(1)) >= "5"
            near = lambda v: F.struct((v.cast("string")).alias("d"), (n["at"] + F.length(v.cast("string")) - k).alias("at"))
            return F.when(up, F.array(near(low + 1), near(low))).otherwise(F.array(near(low), near(low + 1)))

        least = F.when(F.abs(value) < 1e-300, F.lit(1)).otherwise(F.lit(15))
        tried = F.flatten(F.transform(F.sequence(least, F.length(n["d"]) - 1), cut))
        fits = F.filter(tried, lambda c: F.concat(F.lit("0."), c["d"], F.lit("E"), c["at"].cast("string")).cast("double") == F.abs(value))
        best = F.get(F.transform(fits, lambda c: F.struct(F.regexp_replace(c["d"], "0+$", "").alias("d"), c["at"].alias("at"))), F.lit(0))
        open_ = (F.length(n["d"]) > 15) | (F.abs(value) < 1e-300) & (F.length(n["d"]) > 1)
        return F.when(open_, F.coalesce(best, n)).otherwise(n)

    def shown(n: Column) -> Column:
        d, at, size = n["d"], n["at"], F.length(n["d"])
        plain = (
            F.when(at <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -at), d)).when(at >= size, F.concat(d, F.repeat(F.lit("0"), at - size), F.lit(".0")))
            .otherwise(F.concat(F.substring(d, F.lit(1), at), F.lit("."), F.substring(d, at + 1, size)))
        )
        power = (at - 1).cast("string")
        far = F.concat(F.when(at > 0, F.lit("e+")).otherwise(F.lit("e-")), F.lpad(F.regexp_replace(power, "-", ""), F.greatest(F.lit(2), F.length(F.regexp_replace(power, "-", ""))), F.lit("0")))
        head = F.concat(F.substring(d, 1, 1), F.when(size > 1, F.concat(F.lit("."), F.substring(d, F.lit(2), size))).otherwise(F.lit("")))
        return F.when((at > -4) & (at <= 16), plain).otherwise(F.concat(head, far))

    once = lambda c, f: F.transform(F.array(c), f)[0]
    # Integers of more than 53 bits are exact as such; Java 17 rounds some of them to a digit that is not the nearest.
    size = F.abs(value)
    told = F.when((size >= 2.0**53) & (size < 2.0**63), size.try_cast("bigint").cast("string")).otherwise(size.cast("string"))
    text = once(once(digits(told), fewest), shown)
    sign = F.when(value.cast("string").startswith("-"), "-").otherwise("")
    own = F.when(F.isnan(value), "nan").when(F.abs(value) == float("inf"), F.concat(sign, F.lit("inf"))).when(value == 0, F.concat(sign, F.lit("0.0"))).otherwise(F.concat(sign, text))
    return F.when(value.isNotNull(), own)
