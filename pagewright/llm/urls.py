"""URL filter: host and path rules, and a character language-model ratio where no rule fits (DataFrame functions only).

URLs that a rule allows or blocks train two smoothed variable-order Markov models over characters. Counts of runs of one to four characters
are exact rows of a written table, however many there are; neither the driver nor a task holds them all. Each order is smoothed with the one
below it. What a character adds to a score depends only on the run of four that it ends, so that is worked out once for each distinct run and
joined to the runs of the URLs. A URL's score is the difference of its log-likelihoods under both models, divided by its length; parts are whole
multiples of 1 / ``UNIT``, so sums are exact in any order. The threshold is calibrated on a fold of the labelled URLs that does not train.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm import scratch

#: Host, path, verdict.
RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))
ORDER = 4
UNIT = float(1 << 32)
WEIGHT = 4.0
FOLDS = 5


def host(url: Column) -> Column:
    h = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(h, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def ruled(rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits the columns ``host`` and ``path``, and its verdict; null where none fits."""
    name = verdict = None
    for h, p, v in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((F.col("host") == h) | F.col("host").endswith(f".{h}")) & F.col("path").startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return name, verdict


def _body(url: Column) -> Column:
    """What follows the scheme, in lower case."""
    return F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"(?s)^.*?://", "")


def _runs(body: Column) -> Column:
    """The run of ORDER characters that ends at each character, after a run of the ORDER - 1 marks that lead the text."""
    chars = F.concat(F.array(*[F.lit("^")] * (ORDER - 1)), F.filter(F.split(body, ""), lambda c: c != ""))
    # Arrays joined to themselves: inside a lambda by index, the text would be split again for every character.
    two = F.zip_with(chars, F.slice(chars, 2, F.size(chars)), lambda x, y: F.concat(x, y))
    four = F.zip_with(two, F.slice(two, 3, F.size(two)), lambda x, y: F.concat(x, y))
    return F.concat(F.array(F.lit("^" * (ORDER - 1))), F.filter(four, lambda x: x.isNotNull()))


def _trained(labelled: DataFrame) -> DataFrame:
    """``run, allow, block``: how often each run of one to ORDER characters is in the URLs of either verdict."""
    kinds = [F.count(F.when(F.col("ruled") == v, 1)).alias(v) for v in ("allow", "block")]
    longest = labelled.select("ruled", F.explode(_runs(_body(F.col("url")))).alias("run")).groupBy("run").agg(*kinds)
    ends = F.explode(F.transform(F.sequence(F.lit(1), F.length("run")), lambda n: F.col("run").substr(-n, n))).alias("run")
    return scratch.table(longest.select(ends, "allow", "block").groupBy("run").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")), "url-runs")


def _chance(kind: str, total: float) -> Column:
    """Smoothed chance of a run's last character after those before it; ``seen_n`` and ``context_n`` count its last n characters and the n before its last."""
    p = (F.col(f"{kind}_seen_1") + 1.0) / (total + 256.0)
    for n in range(1, ORDER):
        p = F.least(F.lit(1.0), (F.col(f"{kind}_seen_{n + 1}") + WEIGHT * p) / (F.col(f"{kind}_context_{n}") + WEIGHT))
    return p


def _weighed(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """``run, weight``: what a character that ends each of the distinct ``runs`` adds to a score, in multiples of 1 / UNIT."""
    parts = [(f"seen_{n}", F.col("run").substr(ORDER + 1 - n, n)) for n in range(1, ORDER + 1)] + [(f"context_{n}", F.col("run").substr(ORDER - n, n)) for n in range(1, ORDER)]
    asked = runs.select(F.col("run").alias("whole"), F.explode(F.array(*[F.struct(F.lit(k).alias("part"), c.alias("run")) for k, c in parts])).alias("ask")).select("whole", "ask.*")
    told = [F.coalesce(F.max(F.when(F.col("part") == k, F.col(v))), F.lit(0)).alias(f"{v}_{k}") for k, _ in parts for v in ("allow", "block")]
    found = asked.join(counts, "run", "left").groupBy("whole").agg(*told)
    totals = counts.agg(*[F.sum(v).alias(v) for v in ("allow", "block")]).first()
    allow, block = (_chance(v, (totals[v] or 0) / ORDER) for v in ("allow", "block"))
    return found.select(F.col("whole").alias("run"), F.round((F.log(allow) - F.log(block)) * UNIT).cast("long").alias("weight"))


def _scored(judged: DataFrame) -> DataFrame:
    """``h1, h2, score`` of every distinct text after a scheme that has a character, by 128 bits of hashes."""
    bodies = scratch.table(judged.where("h1 is not null").select("h1", "h2", _body(F.col("url")).alias("body")).distinct(), "url-bodies")
    counts = _trained(judged.where("ruled is not null and not held"))
    runs = bodies.select("h1", "h2", F.explode(_runs(F.col("body"))).alias("run")).where(F.length("run") == ORDER)
    weights = scratch.table(_weighed(runs.select("run").distinct(), counts), "url-weights")
    sums = runs.join(weights, "run").groupBy("h1", "h2").agg((F.sum("weight") / F.lit(UNIT) / F.count("*")).alias("score"))
    return scratch.table(sums, "url-scores")


def filter_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict, score, threshold``.

    A null url, or one without ``://``, has an empty host and path and fits no rule. Where no rule fits, a URL is blocked when its score lies below the
    threshold; without characters, or where the rules label no URL of one kind, it is allowed. ``score`` is null where there is nothing to score. Repeated rows are judged one by
    one; other columns are ignored.
    """
    read = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    name, verdict = ruled(rules)
    judged = read.withColumns({"rule": name, "ruled": verdict, "held": F.pmod(F.crc32(F.coalesce("url", F.lit("")).cast("binary")), F.lit(FOLDS)) == 0})
    body = F.when(F.col("url").isNotNull(), _body(F.col("url")))
    judged = judged.withColumns({"h1": F.when(body.isNotNull(), F.xxhash64(body)), "h2": F.when(body.isNotNull(), F.xxhash64(F.lit("url"), body))})
    known = judged.join(_scored(judged), ["h1", "h2"], "left")
    fit = known.where("ruled is not null and held")
    stats = {r["ruled"]: (r["m"], r["s"] or 0.0) for r in fit.groupBy("ruled").agg(F.avg("score").alias("m"), F.stddev_pop("score").alias("s")).collect() if r["m"] is not None}
    threshold = -math.inf
    if len(stats) == 2:
        (a, sa), (b, sb) = stats["allow"], stats["block"]
        threshold = (a * sb + b * sa) / (sa + sb) if sa + sb > 0 else (a + b) / 2
    by_model = F.when(F.col("score") < threshold, "block").otherwise("allow")
    return known.select("page_id", "host", "path", "rule", F.coalesce("ruled", by_model).alias("verdict"), "score", F.lit(threshold).alias("threshold"))
