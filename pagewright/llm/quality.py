"""Quality classifier by weak labels.

Overlapping heuristics vote good, bad or nothing on every document. How often each combination of votes occurs (at most 3**labellers
numbers, however many documents) is all that expectation-maximisation needs to estimate each labeller's accuracy and each
combination's posterior. Posteriors of a bounded sample of documents (the ``SAMPLE`` distinct rows with the least hashes of id and text) train a linear scorer over hashed words, word endings and
shape features, which then scores the whole text of every document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm import scratch
from pagewright.llm.text import LOWER, Texts, U, mix, releasing, texts

SAMPLE = 6000
DIMS = 1 << 16
#: Very frequent short words of the languages that are expected.
COMMON = "the and of to in a is that it for on was with as be der die und das ist von zu den mit sich auf für de la le les et des un une que est dans el los en y que las por con para al".split()
LABELLERS = ("signs", "letters", "capitals", "common", "lines", "variety", "stutter", "shouts")
_code = np.arange(256)
_LETTER = (((_code | 32) >= 97) & ((_code | 32) <= 122)) | (_code >= 128)
_UPPER = (_code >= 65) & (_code <= 90)
_SPACE = (_code == 32) | ((_code >= 9) & (_code <= 13))
_SIGN = np.isin(_code, list(b"#$%&*!?<>{}[]|=~^_\\@+"))


def _sums(flag: np.ndarray, offs: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flag)])[offs])


class Shape:
    """What the labellers and the scorer see of some texts."""

    def __init__(self, part: Texts):
        size = np.maximum(np.diff(part.offs), 1)
        self.words = part.words()
        low = Texts(part.first, LOWER[part.buf], part.offs)
        self.lower = low.words()
        self.hash = self.lower.hashes()
        n = np.maximum(self.words.counts, 1)
        black = np.maximum(_sums(~_SPACE[part.buf], part.offs), 1)
        letters = _sums(_LETTER[part.buf], part.offs)
        common = np.sort(Texts(0, *_joined(COMMON)).words().hashes())
        known = np.isin(self.hash, common)
        first = self.words.first
        pairs = np.unique(self.words.doc.astype(U) * U(0x9E3779B97F4A7C15) ^ self.hash)
        distinct = np.zeros(len(n))
        if len(pairs):
            _, one = np.unique(self.words.doc.astype(U) * U(0x9E3779B97F4A7C15) ^ self.hash, return_index=True)
            distinct = np.bincount(self.words.doc[one], minlength=len(n))
        stutter = np.zeros(len(self.hash), bool)
        stutter[1:] = (self.hash[1:] == self.hash[:-1]) & (self.words.doc[1:] == self.words.doc[:-1])
        lines, repeated = _lines(part)
        shouts = _sums((part.buf == 33) | (part.buf == 63), part.offs)
        self.values = np.stack([
            _sums(_SIGN[part.buf], part.offs) / n,
            letters / black,
            _sums(_UPPER[part.buf], part.offs) / np.maximum(letters, 1),
            np.diff(np.concatenate([[0], np.cumsum(known)])[first]) / n,
            repeated / np.maximum(lines, 1),
            distinct / np.sqrt(n) / np.sqrt(np.minimum(n, 400)),
            np.diff(np.concatenate([[0], np.cumsum(stutter)])[first]) / n,
            shouts / n,
        ], 1)
        self.size = size

    def votes(self) -> np.ndarray:
        """1 good, -1 bad, 0 nothing, for each text and labeller."""
        v = self.values.T
        cut = lambda x, good, bad: np.where(good(x), 1, np.where(bad(x), -1, 0))
        return np.stack([
            cut(v[0], lambda x: x < 0.1, lambda x: x > 0.5),
            cut(v[1], lambda x: x > 0.9, lambda x: x < 0.75),
            cut(v[2], lambda x: (x > 0.005) & (x < 0.2), lambda x: x > 0.4),
            cut(v[3], lambda x: x > 0.15, lambda x: x < 0.03),
            cut(v[4], lambda x: x < 0.05, lambda x: x > 0.3),
            cut(v[5], lambda x: x > 0.45, lambda x: x < 0.15),
            cut(v[6], lambda x: x < 0.02, lambda x: x > 0.15),
            cut(v[7], lambda x: x < 0.1, lambda x: x > 0.4),
        ], 1)

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """The text and the place of each hashed feature: words, their last two bytes, and the shape in steps."""
        w, buf = self.lower, self.lower.texts.buf
        ends = buf[w.ends - 1].astype(U) << U(8) | buf[np.maximum(w.ends - 2, w.starts)]
        steps = np.floor(np.log2(self.values + 1e-3) * 2).astype(np.int64) + 64
        shape = (steps + 1000 * np.arange(steps.shape[1])).astype(U)
        place = np.concatenate([self.hash, mix(ends + U(1 << 20)), mix(shape.ravel() + U(1 << 40))]) % U(DIMS)
        doc = np.concatenate([w.doc, w.doc, np.repeat(np.arange(len(self.values)), steps.shape[1])])
        return doc, place.astype(np.int64)


def _joined(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = " ".join(words).encode()
    return np.frombuffer(raw, np.uint8), np.array([0, len(raw)])


def _lines(part: Texts) -> tuple[np.ndarray, np.ndarray]:
    """How many non-empty lines each text has, and how many of them repeat an earlier one of it."""
    table = np.ones(256, bool)
    table[10] = table[13] = False
    lines = part.words(table)
    key = lines.hashes() ^ (lines.doc.astype(U) * U(0x9E3779B97F4A7C15))
    _, one = np.unique(key, return_index=True)
    return lines.counts, lines.counts - np.bincount(lines.doc[one], minlength=len(lines.counts))


def code(votes: np.ndarray) -> np.ndarray:
    return ((votes + 1) * 3 ** np.arange(votes.shape[1])).sum(1)


def decode(codes: np.ndarray, labellers: int = len(LABELLERS)) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(labellers) % 3 - 1


def expectation_maximisation(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of each combination, each labeller's chances [class, labeller, vote], and the share of good documents."""
    q = 1 / (1 + np.exp(-votes.sum(1)))
    chances = np.zeros((2, votes.shape[1], 3))
    prior = 0.5
    for _ in range(rounds):
        weight = np.stack([(1 - q) * counts, q * counts])
        prior = float((weight[1].sum() + 1) / (counts.sum() + 2))
        for v in (-1, 0, 1):
            chances[:, :, v + 1] = weight @ (votes == v) + 1
        chances /= chances.sum(2, keepdims=True)
        ll = np.stack([np.log(chances[y][np.arange(votes.shape[1]), votes + 1]).sum(1) for y in (0, 1)])
        new = 1 / (1 + np.exp(np.clip(ll[0] + np.log(1 - prior) - ll[1] - np.log(prior), -500, 500)))
        if np.abs(new - q).max() < 1e-9:
            break
        q = new
    return q, chances, prior


def fit_linear(doc: np.ndarray, place: np.ndarray, target: np.ndarray, rounds: int = 150, rate: float = 2.0, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a logistic scorer with a bias (the last one) over features of unit length; gradient descent on soft targets."""
    n = np.bincount(doc, minlength=len(target))
    x = 1 / np.sqrt(np.maximum(n, 1))[doc]
    w, memory = np.zeros(DIMS + 1), np.full(DIMS + 1, 1e-8)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(np.bincount(doc, w[place] * x, minlength=len(target)) + w[-1])))
        error = (p - target) / len(target)
        g = np.append(np.bincount(place, error[doc] * x, minlength=DIMS), error.sum()) + ridge * w / len(target)
        memory += g * g
        w -= rate * 0.1 * g / np.sqrt(memory)
    return w


def classify(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, quality_score, kept, weak_posterior``.

    ``kept`` is a score of at least one half. A null or empty text has no words: its score and posterior are 0. Repeated rows are judged each on its own; other columns
    are ignored. With no documents at all the result is empty.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spark = docs.sparkSession
    scratch.modest(spark)

    def vote(batches):
        total = np.zeros(3 ** len(LABELLERS), np.int64)
        for b in batches:
            for part in texts(b.column(0)):
                shape = Shape(part)
                total += np.bincount(code(shape.votes())[shape.words.counts > 0], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["code", "n"])

    table = docs.select("text").mapInArrow(releasing(vote), "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").toArrow()
    codes, counts = table["code"].to_numpy().astype(np.int64), table["n"].to_numpy()
    posterior = np.zeros(3 ** len(LABELLERS))
    weights = np.zeros(DIMS + 1)
    if len(codes):
        posterior[codes], _, _ = expectation_maximisation(decode(codes), counts)

        def featured(batches):
            for b in batches:
                for part in texts(b.column(0)):
                    shape = Shape(part)
                    doc, place = shape.features()
                    key, own = doc[np.argsort(doc, kind="stable")], place[np.argsort(doc, kind="stable")]
                    cut = np.searchsorted(key, np.arange(len(shape.values) + 1))
                    some = np.flatnonzero(shape.words.counts > 0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(code(shape.votes())[some], pa.int32()), pa.array([np.unique(own[cut[i] : cut[i + 1]]).astype(np.int32) for i in some], pa.list_(pa.int32())), b.column(1).take(pa.array(some + part.first))], names=["code", "places", "hash"]
                    )

        # The same rows whatever the order they come in; only their hashes meet in one place.
        hashed = docs.withColumn("hash", F.xxhash64("doc_id", "text")).where("text is not null")
        cut = hashed.select("hash").distinct().orderBy("hash").limit(sample).agg(F.max("hash")).first()[0]
        chosen = hashed.where(F.col("hash") <= F.lit(cut)).dropDuplicates(["hash"])
        got = chosen.select("text", "hash").mapInArrow(releasing(featured), "code int, places array<int>, hash long").toArrow().sort_by("hash")
        places = [np.array(x, np.int64) for x in got["places"].to_pylist()]
        target = posterior[got["code"].to_numpy()]
        if len(target):
            weights = fit_linear(np.repeat(np.arange(len(places)), [len(x) for x in places]), np.concatenate(places), target)
    model = scratch.broadcast(spark, (posterior, weights))
    schema = pa.schema([("doc_id", pa.int64()), ("quality_score", pa.float64()), ("kept", pa.bool_()), ("weak_posterior", pa.float64())])

    def score(batches):
        posterior, weights = model.value
        for b in batches:
            scores, weak = [], []
            for part in texts(b.column(1)):
                shape = Shape(part)
                doc, place = shape.features()
                pair = np.unique(doc * DIMS + place)
                doc, place = pair // DIMS, pair % DIMS
                n = np.maximum(np.bincount(doc, minlength=len(shape.values)), 1)
                full = shape.words.counts > 0
                raw = np.bincount(doc, weights[place], minlength=len(n)) / np.sqrt(n) + weights[-1]
                scores.append(np.where(full, 1 / (1 + np.exp(-np.clip(raw, -500, 500))), 0.0))
                weak.append(np.where(full, posterior[code(shape.votes())], 0.0))
            s, w = np.concatenate([*scores, np.zeros(0)]), np.concatenate([*weak, np.zeros(0)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array(s >= 0.5), pa.array(w)], schema=schema)

    return docs.mapInArrow(releasing(score), "doc_id long, quality_score double, kept boolean, weak_posterior double")
