"""Format-preserving pseudonyms for personal data (DataFrame functions only).

Numbers and dates that pass their validation are permuted by a keyed Feistel network within their own format, and within what is valid of it, so a pseudonym is found
again and whoever holds the key can undo it (``reveal``). One value has one pseudonym for one key, so equal values stay linked across documents. The local part
of an e-mail address is replaced by keyed characters of the same classes, which links equal values but can't be undone.

What is covered, and what its validation is:

* ``card``: 13 to 19 digits, or groups of 4-4-4-4 or 4-6-5 with spaces or hyphens; a right Luhn digit. Length and signs stay.
* ``iban``: a country's letters, check digits and up to 30 characters, also in groups of four; right check digits, and the country's length where ``IBAN_LENGTHS`` has it.
  Country and letters stay.
* ``date``: year-month-day with hyphens, or day, month and year with dots or slashes; days that exist, from 1800 to the middle of 2158. Dates with the month first are not covered.
* ``ip``: four numbers up to 255 that no letter, digit or dot touches, so no versions such as v1.2.3.4. IPv6 is not covered.
* ``ssn``: 3-2-4 digits with hyphens; neither area 000, 666 or above 899, nor group 00 or serial 0000.
* ``phone``: ten digits as 3-3-4 with brackets, hyphens or dots, or a plus sign and 9 to 15 digits with single signs in between. Numbering plans are not checked. Ten digits in a row or with
  spaces alone are not covered, as too much else looks so. The digits before the last ten stay, or the first two after a plus sign.
* ``email``: a local part, and a domain of at least two labels.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order in which a match is assigned to them.
PATTERNS = {
    "email": r"[A-Za-z0-9._+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{2,63}){1,8}",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b",
    "date": r"\b(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})\b",
    "ip": r"(?<![0-9A-Za-z.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9A-Za-z]|\.[0-9])",
    "ssn": r"\b(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}\b",
    "phone": r"\+[1-9][0-9](?:[ .-]?[0-9]{1,4}){2,5}\b(?![-.]?[0-9])|(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}\b|\b[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}\b",
    "card": r"\b(?:[0-9]{13,19}|[0-9]{4}([ -])(?:[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{6}\1[0-9]{5}))\b",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
FIRST_DAY, DAYS = date(1800, 1, 1), (256, 512)
#: The characters of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20,
    "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "JO": 30,
    "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28,
    "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VA": 22,
}
ROUNDS = 8


def _noise(key: str, kind: str, tweak: Column, i: Column, x: Column) -> Column:
    """A keyed number below 2**60 for a round and what it reads."""
    inner = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), tweak.cast("string"), i.cast("string"), x.cast("string")), 256)
    return F.conv(F.substring(F.sha2(F.concat(F.lit(key), inner), 256), 1, 15), 16, 10).cast("long")


def _feistel(key: str, kind: str, a: Column, b: Column, m: Column, n: Column, tweak: Column, undo: bool) -> Column:
    """The pair (a, b) of numbers below m and n, permuted: rounds add noise from one of them to the other in turn."""

    def step(acc: Column, i: Column) -> Column:
        even = i % 2 == 0
        sign = -1 if undo else 1
        left = F.when(even, F.pmod(acc["a"] + sign * _noise(key, kind, tweak, i, acc["b"]), m)).otherwise(acc["a"])
        right = F.when(even, acc["b"]).otherwise(F.pmod(acc["b"] + sign * _noise(key, kind, tweak, i, acc["a"]), n))
        return F.struct(left.alias("a"), right.alias("b"))

    turns = F.array(*[F.lit(i) for i in (reversed(range(ROUNDS)) if undo else range(ROUNDS))])
    return F.aggregate(turns, F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), step)


def _tens(n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(10**k).cast("long") for k in range(16)]), n + 1)


def _digits(key: str, kind: str, d: Column, undo: bool) -> Column:
    """A string of 2 to 30 digits, permuted among those of its length."""
    n = F.length(d)
    u = F.floor(n / 2).cast("int")
    found = _feistel(key, kind, F.substring(d, F.lit(1), u).cast("long"), F.substring(d, u + 1, n - u).cast("long"), _tens(u), _tens(n - u), n, undo)
    return F.concat(F.lpad(found["a"].cast("string"), u, F.lit("0")), F.lpad(found["b"].cast("string"), n - u, F.lit("0")))


def _only(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refilled(value: Column, digits: Column) -> Column:
    """The value with its digits replaced, in order."""
    chars = F.filter(F.split(value, ""), lambda c: c != "")
    start = F.struct(F.lit("").alias("s"), F.lit(1).alias("k"))
    step = lambda acc, c: F.when(c.rlike("[0-9]"), F.struct(F.concat(acc["s"], F.substring(digits, acc["k"], F.lit(1))).alias("s"), (acc["k"] + 1).alias("k"))).otherwise(F.struct(F.concat(acc["s"], c).alias("s"), acc["k"].alias("k")))
    return F.aggregate(chars, start, step)["s"]


def luhn(payload: Column) -> Column:
    """The check digit that makes the digits a valid card number."""
    digits = F.reverse(F.transform(F.filter(F.split(payload, ""), lambda c: c != ""), lambda c: c.cast("int")))
    total = F.aggregate(F.transform(digits, lambda x, i: F.when(i % 2 == 1, x).otherwise(F.when(x > 4, 2 * x - 9).otherwise(2 * x))), F.lit(0), lambda a, x: a + x)
    return F.pmod(10 - F.pmod(total, F.lit(10)), F.lit(10)).cast("string")


def mod97(value: Column) -> Column:
    """An IBAN's remainder, of its characters in the order given; letters count as 10 to 35."""
    number = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(
        F.filter(F.split(value, ""), lambda c: c != ""), F.lit(0).cast("long"),
        lambda a, c: F.pmod(F.when(c.rlike("[0-9]"), a * 10 + c.cast("int")).otherwise(a * 100 + F.ascii(c) - 55), F.lit(97)).cast("long"),
    )


def _date(value: Column) -> Column:
    iso = value.contains("-")
    return F.when(iso, F.try_to_date(value, "yyyy-MM-dd")).otherwise(F.try_to_date(F.regexp_replace(value, "[./]", "-"), "dd-MM-yyyy"))


def _day(value: Column) -> Column:
    return F.datediff(_date(value), F.lit(FIRST_DAY))


def valid(kind: str, value: Column) -> Column:
    if kind == "card":
        d = _only(value)
        return luhn(F.substring(d, F.lit(1), F.length(d) - 1)) == F.right(d, F.lit(1))
    if kind == "iban":
        plain = F.replace(value, F.lit(" "), F.lit(""))
        lengths = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])
        known = F.try_element_at(lengths, F.left(plain, F.lit(2)))
        size = F.length(plain)
        right = mod97(F.concat(F.substring(plain, F.lit(5), size), F.left(plain, F.lit(4)))) == 1
        return right & F.coalesce(known == size, size.between(15, 34)) & F.substring(plain, 3, 2).between("02", "98")
    if kind == "date":
        return F.coalesce((_day(value) >= 0) & (_day(value) < DAYS[0] * DAYS[1]), F.lit(False))
    if kind == "phone":
        return ~value.startswith("+") | value.contains("(") | F.length(_only(value)).between(9, 15)
    return F.lit(True)


def _email(key: str, value: Column) -> Column:
    local = F.substring_index(value, "@", 1)
    noise = F.sha2(F.concat(F.lit(key), F.sha2(F.concat(F.lit(f"{key}|email|"), value), 256)), 256)
    byte = lambda i: F.conv(F.substring(noise, F.pmod(2 * i, F.lit(62)) + 1, F.lit(3)), 16, 10).cast("int")
    letters, digits = F.lit("abcdefghijklmnopqrstuvwxyz"), F.lit("0123456789")
    other = lambda c, i: (
        F.when(c.rlike("[a-z]"), F.substring(letters, F.pmod(byte(i), F.lit(26)) + 1, F.lit(1)))
        .when(c.rlike("[A-Z]"), F.upper(F.substring(letters, F.pmod(byte(i), F.lit(26)) + 1, F.lit(1))))
        .when(c.rlike("[0-9]"), F.substring(digits, F.pmod(byte(i), F.lit(10)) + 1, F.lit(1)))
        .otherwise(c)
    )
    return F.concat(F.array_join(F.transform(F.filter(F.split(local, ""), lambda c: c != ""), other), ""), F.lit("@"), F.substring_index(value, "@", -1))


def pseudonym(kind: str, value: Column, key: str, undo: bool = False) -> Column:
    d = _only(value)
    if kind == "email":
        return value if undo else _email(key, value)
    if kind == "card":
        payload = _digits(key, kind, F.substring(d, F.lit(1), F.length(d) - 1), undo)
        return _refilled(value, F.concat(payload, luhn(payload)))
    if kind == "iban":
        country, body = F.left(value, F.lit(2)), F.substring(value, F.lit(5), F.length(value))
        own = _only(body)
        body = F.when(F.length(own) > 1, _refilled(body, _digits(key, kind, own, undo))).otherwise(body)
        check = F.lpad((98 - mod97(F.concat(F.replace(body, F.lit(" "), F.lit("")), country, F.lit("00")))).cast("string"), 2, "0")
        return F.concat(country, check, body)
    if kind == "ssn":
        # Areas without the two that are left out, groups and serials, each counted from 0.
        area, group, serial = F.substring(d, 1, 3).cast("long"), F.substring(d, 4, 2).cast("long"), F.substring(d, 6, 4).cast("long")
        pair = _feistel(key, kind, (area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), F.lit(0), undo)
        area = F.floor(pair["a"] / 99) + 1
        area = F.when(area >= 666, area + 1).otherwise(area)
        return F.format_string("%03d-%02d-%04d", area, pair["a"] % 99 + 1, pair["b"] + 1)
    if kind == "date":
        n = _day(value)
        pair = _feistel(key, kind, F.floor(n / DAYS[1]), F.pmod(n, F.lit(DAYS[1])), F.lit(DAYS[0]), F.lit(DAYS[1]), F.lit(0), undo)
        day = F.date_add(F.lit(FIRST_DAY), (pair["a"] * DAYS[1] + pair["b"]).cast("int"))
        return F.when(value.contains("-"), F.date_format(day, "yyyy-MM-dd")).otherwise(
            F.concat(F.date_format(day, "dd"), F.substring(value, 3, 1), F.date_format(day, "MM"), F.substring(value, 6, 1), F.date_format(day, "yyyy"))
        )
    if kind == "ip":
        part = lambda k: F.element_at(F.split(value, r"\."), k).cast("long")
        pair = _feistel(key, kind, part(1) * 256 + part(2), part(3) * 256 + part(4), F.lit(65536), F.lit(65536), F.lit(0), undo)
        return F.concat_ws(".", *[x.cast("string") for s in "ab" for x in (F.floor(pair[s] / 256), pair[s] % 256)])
    if kind == "phone":
        stays = F.when(value.startswith("+") & ~value.contains("("), 2).otherwise(F.length(d) - 10)
        return _refilled(value, F.concat(F.substring(d, F.lit(1), stays), _digits(key, kind, F.substring(d, stays + 1, F.length(d)), undo)))
    return _refilled(value, _digits(key, kind, d, undo))


def _kind(value: Column) -> Column:
    """The first kind whose pattern is the whole of the match; null where validation fails."""
    found = None
    for kind, p in PATTERNS.items():
        fits = value.rlike(f"^(?:{p})$")
        then = F.when(valid(kind, value), kind)
        found = F.when(fits, then) if found is None else found.when(fits, then)
    return found


def mask(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", undo: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, text`` with pseudonyms for what was found, ``n_pii`` and ``n_<kind>``.

    A null text stays null and an empty one empty, both without findings. What only looks like one of the kinds (a card number with a wrong
    check digit, the 31st of June) stays as it is. Rows are treated one by one, repeated ones alike; a table without rows gives none; other columns are ignored.
    """
    text = F.col("text")
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    likely = text.rlike("[0-9@]")
    hits = F.when(likely, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    read = read.withColumn("hits", hits)
    named = F.transform("hits", lambda v: F.struct(v.alias("v"), _kind(v).alias("kind")))
    read = read.withColumn("hits", F.when(F.size("hits") > 0, named))

    def changed(x: Column) -> Column:
        out = F.when(x["kind"].isNull(), x["v"])
        for kind in PATTERNS:
            out = out.when(x["kind"] == kind, pseudonym(kind, x["v"], key, undo))
        return out

    gaps = F.split(text, ANY, -1)
    joined = F.array_join(F.zip_with(gaps, F.transform("hits", changed), lambda g, v: F.concat(g, F.coalesce(v, F.lit("")))), "")
    count = lambda kind: F.coalesce(F.size(F.filter("hits", lambda x: x["kind"] == kind)).cast("long"), F.lit(0).cast("long")).alias(f"n_{kind}")
    found = F.coalesce(F.size(F.filter("hits", lambda x: x["kind"].isNotNull())).cast("long"), F.lit(0).cast("long"))
    return read.select("doc_id", F.when(found > 0, joined).otherwise(text).alias("text"), found.alias("n_pii"), *map(count, PATTERNS))


def reveal(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Undoes ``mask`` for the same key, but for e-mail addresses."""
    return mask(docs, key, id_col, text_col, undo=True)
