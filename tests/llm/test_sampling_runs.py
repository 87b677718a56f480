"""Importance resampling, mixing and periodic runs against brute force, with nulls, ties, repeated rows, long texts, empty tables and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from pagewright.llm import importance, mixing, periods

SCHEMA = "doc_id long, text string, source string, bucket int, rank int, size int, weight int, part int, of string, period int, start int"


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    word = lambda: r.choice(["Stone", "garden", "ÉTÉ", "x1", "mañana", "the", "THE", "of", "木", "b-c"])
    out = [(i, " ".join(word() for _ in range(r.choice([0, 3, 19, 20, 25, 60, 200]))), r.choice(["a", "b", "c", "Z", "é", None])) for i in range(120)]
    out += [(300, None, "a"), (301, "", "b"), (302, " \t\n", None), (303, "w " * 9_000, "d"), (304, "o", "d"), (None, "the garden " * 15, "a"), (None, None, None)]
    return out + [out[7]] * 3 + [(7, "another text of the same id", out[7][2])]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, 2, 3, 4, 5, "o", 6, 7) for i, t, s in rows], SCHEMA).repartition(3)


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_resample(rows, target, percent, least, low, high, buckets, seed):
    runs = lambda ws: [" ".join(ws[i : i + n]) for n in range(low, high + 1) for i in range(len(ws) - n + 1)]
    slot = lambda x: zlib.crc32(x.encode()) % buckets
    s, t = Counter(slot(x) for _, d, _ in rows for x in runs(words_of(d))), Counter(slot(x) for d in target for x in runs(words_of(d)))
    gain = lambda k: math.floor(1000 * math.log((t[k] + 1) * (s.total() + buckets) / ((s[k] + 1) * (t.total() + buckets))))
    out = []
    for i, d, _ in rows:
        own = runs(words_of(d))
        weight = sum(gain(slot(x)) for x in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words_of(d))])
    able = sorted((x for x in out if x[5] >= least), key=lambda x: (-x[3], math.inf if x[0] is None else x[0], -x[2], -x[1]))
    for k, x in enumerate(able[: percent * len(able) // 100]):
        x[4] = k + 1
    return Counter(tuple(x[:5]) for x in out)


@pytest.mark.parametrize(("percent", "least", "low", "high", "buckets"), [(10, 20, 1, 1, 10_000), (50, 0, 1, 3, 64), (100, 3, 2, 2, 7)])
def test_resample(spark, rows, percent, least, low, high, buckets):
    target = ["the garden of stone", None, "木 x1 " * 20, ""]
    texts = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    got = importance.resample(frame(spark, rows), texts, percent, least, low, high, buckets, 7).collect()
    assert Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got) == brute_resample(rows, target, percent, least, low, high, buckets, 7)


def test_resample_of_nothing(spark, rows):
    none = spark.createDataFrame([], SCHEMA)
    assert importance.resample(none, none).count() == 0
    got = importance.resample(frame(spark, rows), none, 30).collect()
    assert Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got) == brute_resample(rows, [], 30, 20, 1, 1, 10_000, 2024)
    with pytest.raises(ValueError):
        importance.gains(none, none, buckets=1 << 21)


def test_ranks_follow_a_sort_over_many_partitions(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 100).alias("v"), "id").repartition(7)
    got = importance.numbered(df, [F.col("v").desc(), F.col("id").asc()], "place").collect()
    want = sorted(((i * 7919 % 100, i) for i in range(5000)), key=lambda x: (-x[0], x[1]))
    assert [(r.v, r.id) for r in sorted(got, key=lambda r: r.place)] == want and sorted(r.place for r in got) == list(range(1, 5001))


def brute_targets(sizes, weights, most):
    """Shares by weight; what is above its bound stops there, and the rest is shared again until nothing is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    held: dict = {}
    while True:
        left = sum(sizes.values()) - sum(held.values())
        free = [s for s in order if s not in held]
        share = {s: Fraction(left * weight[s], sum(weight[x] for x in free)) for s in free}
        above = [s for s in free if share[s] > most * sizes[s]]
        if not above:
            return {**held, **share}
        held |= {s: most * sizes[s] for s in above}


@pytest.mark.parametrize("weights", [(5, 2, 1), (1, 1000)])
def test_mix(spark, rows, weights):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    want = brute_targets(sizes, weights, 3)
    got = mixing.mix(frame(spark, rows), weights).collect()
    assert Counter((r.doc_id, r["size"], r.source) for r in got) == Counter((i, size(t), s) for i, t, s in rows)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], abs_tol=1e-6)
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    for s, target in want.items():
        assert abs(taken[s] - target) <= 0.5 + 1e-6, s
        own = [r for r in got if r.source == s and r["size"]]
        # One document of a source is taken in part at most; of the others, none has over one copy more than another.
        assert sum(r.taken % r["size"] > 0 for r in own) <= 1
        assert max((r.taken // r["size"] for r in own), default=0) - min((r.taken // r["size"] for r in own), default=0) <= 1
    again = mixing.mix(frame(spark, rows[::-1]).repartition(5), weights).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_mix_takes_each_document_as_often_as_the_others(spark):
    """Inclusion follows the source's chance alone: over many seeds, long and short documents are in as often."""
    rows = [(i, "w " * (5 if i % 2 else 50), "a") for i in range(200)] + [(1000 + i, "w " * 100, "b") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").cache()
    share = Counter()
    for seed in range(2):
        for r in mixing.mix(df, (1, 3), seed=seed).where("source = 'a'").collect():
            share[r["size"]] += r.taken / r["size"] / 200
    chance = 15500 / 4 / 5500
    assert all(abs(v - chance) < 0.12 for v in share.values()), (share, chance)


def test_mix_of_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    got = mixing.mix(spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")).collect()
    assert Counter((r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in got) == Counter([(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)])


def brute_runs(ws, times=4, least=6):
    n, found = len(ws), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and ws[j] == ws[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, m, q) for (s, m), q in found.items())


def brute_periods(i, text, planted):
    ws = [x.encode() for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    n, h = len(ws), zlib.crc32(str(i).encode())
    if planted and i is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        ws = [ws[x] if x < a else ws[a + (x - a) % p] for x in range(n)]
    runs = brute_runs(ws)
    gone = {x for s, m, q in runs for x in range(s + q, s + m)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    told = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = b" ".join(x for k, x in enumerate(ws) if k not in gone)
    return (i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_of_random_sequences():
    r = random.Random(13)
    for _ in range(600):
        ws = [r.randrange(r.choice([1, 2, 3])) for _ in range(r.randrange(1, 60))]
        if r.random() < 0.5:
            root = [r.randrange(4) for _ in range(r.randrange(1, 9))]
            at = r.randrange(len(ws))
            ws[at:at] = (root * 12)[: r.randrange(4 * len(root), 12 * len(root))]
        assert periods.runs_of(ws) == brute_runs(ws), ws


@pytest.mark.parametrize("planted", [True, False])
def test_find_runs(spark, planted):
    r = random.Random(14)
    rows = []
    for i in range(260):
        ws = [r.choice(["a", "b", "é", "木", "word"]) for _ in range(r.choice([0, 1, 4, 5, 6, 30, 120]))]
        for _ in range(r.randrange(3)):
            root = [r.choice("abcdefg") for _ in range(r.choice([1, 1, 2, 3, 7, 20]))]
            at = r.randrange(len(ws) + 1)
            ws[at:at] = (root * 9)[: r.randrange(3 * len(root), 9 * len(root))]
        rows.append((i, r.choice([" ", "\n\t", "  "]).join(ws) + r.choice(["", " "]), "s"))
    rows += [(900, None, "s"), (901, "", "s"), (902, " \n", "s"), (None, "a b " * 20, "s"), (903, "x " * 30_000, "s"), (904, " ".join(f"u{k % 1500}" for k in range(9000)), "s"), rows[5], rows[5]]
    got = periods.find_runs(frame(spark, rows), planted).collect()
    long = {903: (0, 30_000, 1), 904: (0, 9000, 1500)}
    want = Counter(brute_periods(i, t, planted) for i, t, _ in rows if i not in long)
    assert Counter(tuple(x)[:8] for x in got if x.doc_id not in long) == want
    assert all((x.start, x.length, x.period) == long[x.doc_id] for x in got if x.doc_id in long)
    assert all(len(x.runs) == x.n_runs for x in got)
    assert periods.find_runs(spark.createDataFrame([], SCHEMA), planted).count() == 0


def test_an_ordered_set_keeps_its_order_over_many_blocks():
    r = random.Random(15)
    xs = r.sample(range(100_000), 20_000)
    ends, seen = periods.Ends(xs[0]), [xs[0]]
    for x in xs[1:]:
        before, after = ends.put(x)
        if len(seen) < 3000:
            assert before == max((y for y in seen if y < x), default=-1) and after == min((y for y in seen if y > x), default=-1)
            seen.append(x)
    assert [x for b in ends.blocks for x in b] == sorted(xs) and max(map(len, ends.blocks)) <= 2 * periods.BLOCK
