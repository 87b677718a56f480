"""The pipeline as a whole against a brute-force version on a small corpus."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def corpus():
    r = random.Random(9)
    words = {"en": "the house and garden of stone river with light over old trees".split(), "de": "das Haus und der Garten aus Stein mit Licht über alten Bäumen".split()}
    rows, items = [], []
    for i in range(24):
        lang = "de" if i % 3 == 0 else "en"
        rows.append((i, " ".join(r.choice(words[lang]) + str(r.randrange(40)) for _ in range(r.choice([4, 60, 90]))), lang))
    base = [f"{r.choice(words['en'])}{k}" for k in range(80)]
    rows.append((30, " ".join(base), "en"))
    for k in range(4):
        near = list(base)
        near[10 * k] = "changed"
        rows.append((31 + k, " ".join(near), "en"))
    items.append((1, " ".join(base[:15])))
    items.append((2, " ".join(rows[1][1].split()[:20])))
    rows += [(40, rows[4][1].replace(" ", "  \n"), "en"), (41, rows[4][1], "en"), (42, "123 456 !!", "en"), (43, None, None), (44, "", "en"), (45, "€" * 40 + "é", None), (46, rows[7][1], "de"), (46, rows[7][1], "de")]
    return rows, items


def bits_per_byte(counts, text):
    """Bits a byte under the best language, byte by byte and context by context."""
    s = b"\0\0\0" + bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode())

    def cost(lang, at, order):
        if order < 0:
            return 8.0
        seen = counts[lang].get((order, s[at - order : at]), {})
        n, q = sum(seen.values()), len(seen)
        if s[at] in seen:
            return -math.log2(seen[s[at]] / (n + q))
        return (-math.log2(q / (n + q)) if n else 0) + cost(lang, at, order - 1)

    return min(sum(cost(x, i, 3) for i in range(3, len(s))) for x in counts) / max(1, len(s) - 3)


def brute(rows, items):
    counts: dict = {}
    for i, t, lang in rows:
        if lang is not None and t is not None and zlib.crc32(str(i).encode()) % 5:
            s = b"\0\0\0" + bytes(c + 32 if 65 <= c <= 90 else c for c in t.encode())
            own = counts.setdefault(lang, {})
            for at in range(3, len(s)):
                for order in range(4):
                    ctx = own.setdefault((order, s[at - order : at]), {})
                    ctx[s[at]] = ctx.get(s[at], 0) + 1
    kept = [(i, t) for i, t, _ in rows if t and re.search(r"[^\W\d_]", t) and bits_per_byte(counts, t) < 8]
    first: dict = {}
    for i, t in kept:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), []).append((i, t))
    kept = [min(v) for v in first.values()]

    def shingles(t):
        w = re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower())
        return {tuple(w[s : s + 5]) for s in range(max(1, len(w) - 4))}

    sets = {i: shingles(t) for i, t in kept}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    kept = [(i, t) for i, t in kept if root(i) == i]
    words = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.encode().lower())
    wins = {tuple(words(t)[s : s + 13]) for _, t in items for s in range(max(1, len(words(t)) - 12))}

    def clean(t):
        w, hit = words(t), set()
        for s in range(len(w) - 12):
            if tuple(w[s : s + 13]) in wins:
                hit |= set(range(s, s + 13))
        return not hit or 20 * len(hit) < len(w)

    return [(i, t) for i, t in kept if clean(t)]


def test_run(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    rows, items = corpus()
    odd = ("own_sha", "kept", "row", "gone_id", "h1")
    spark.createDataFrame([(i, t, lang, "s", len(t or ""), *odd) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in odd)).repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = brute(rows, items)
    gone = {i for i, _, _ in rows} - {i for i, _ in want}
    assert {42, 43, 44, 30, 31, 1, 40, 41} <= gone and len(want) > 10
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = Counter()
    for i, t in want:
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4")
        for k, s in enumerate(range(0, len(ids), 2048)):
            pieces[(i, k, s, len(ids[s : s + 2048]), zlib.crc32(ids[s : s + 2048].tobytes()))] += 1
    got = corpus_pipeline.run(spark, f"file://{tmp_path}").collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == pieces
    docs = spark.read.parquet(f"file://{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, f"file://{tmp_path}")
        assert left.schema.simpleString() == docs.schema.simpleString()
        assert {tuple(r)[-5:] for r in left.collect()} == {odd}


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() == 0


def test_rows_of_one_id_keep_the_first_by_other_columns(spark):
    rows = [(1, "a b", "z"), (1, "a  b", "y"), (1, "a c", "x"), (2, "a b", "a"), (None, "a b", "b"), (None, None, "c"), (None, "", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    left = {tuple(r) for r in corpus_pipeline.exact_dedup(spark, docs, "").collect()}
    assert left == {(1, "a  b", "y"), (1, "a c", "x"), (None, None, "c")}
