"""Quality by ordinal regression: a cumulative-link model over hashed words.

``P(grade >= k) = sigmoid(w . x - t_k)`` with one weight vector for all grades and ordered thresholds
``t_1 < t_2 < ...``. From it follow the expected grade and the tail probability of any grade. A
text's features are the hashed forms of its words (letters, capitals and digits folded, other signs kept), the
hashed words themselves and the share of words repeated at once, each as a share of the text's words; so every word of the
whole text counts, and a score costs one look-up for each word.

The model is fitted on a bounded sample of the graded rows (``max_rows``, taken by a hash of the
identifier); an identifier on several rows gives one text, taken by a hash, for each of its labels. Scores cover all rows.

Defined cases: a null text is empty and gets the thresholds' own probabilities; a null grade or an
identifier that appears in one table only is not used for the fit; repeated rows give repeated rows;
without graded rows, or with one grade only, every text passes; other columns are carried along.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.tasks import map_batches, slices

DIM = 1 << 16
FORMS = 1 << 12  # the first places are for words' forms
REPEAT = DIM  # one more place: words equal to the one before
MEMO_WORDS = 250_000
#: Graded rows that a fit uses at most.
MAX_ROWS = 4000

LOWER, UPPER, DIGIT = re.compile(r"[^\W\d_A-Z]+"), re.compile(r"[A-Z]+"), re.compile(r"\d+")


def form_of(word: str) -> str:
    """The word with runs of small letters, capitals and digits folded; case by ASCII and Unicode rules."""
    if word.isalpha():
        return "A" if word.isupper() else "Aa" if word[0].isupper() else "a"
    small = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word[:64])
    return re.sub(r"(.)\1+", r"\1", small)


def places(word: str) -> tuple[int, int]:
    """Where a word's form and the word itself count."""
    form = zlib.crc32(b"f" + form_of(word).encode()) % FORMS
    return form, FORMS + zlib.crc32(b"w" + word.lower().encode()) % (DIM - FORMS)


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray
    grades: list[int]

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= grades[k]) for k = 1, 2, ...: one column for each threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - np.asarray(scores, float)[:, None], -40, 40)))

    def expected(self, scores: np.ndarray) -> np.ndarray:
        steps = np.diff(np.array(self.grades, float))
        return self.grades[0] + self.tails(scores) @ steps


def fit_ordinal(rows: list[tuple[np.ndarray, np.ndarray, int]], dim: int, rounds: int = 300, ridge: float = 1e-4, rate: float = 0.3) -> OrdinalModel:
    """Maximum likelihood with a ridge by Adam over (places, values, grade) rows.

    The thresholds are a first one and positive steps, so they stay ordered.
    """
    grades = sorted({g for _, _, g in rows})
    if len(grades) < 2:
        return OrdinalModel(np.zeros(dim), np.zeros(0), grades or [0])
    index = np.concatenate([p for p, _, _ in rows])
    value = np.concatenate([v for _, v, _ in rows])
    owner = np.repeat(np.arange(len(rows)), [len(p) for p, _, _ in rows])
    used, column = np.unique(index, return_inverse=True)
    level = np.searchsorted(grades, [g for _, _, g in rows])
    count = np.bincount(level, minlength=len(grades))
    above = 1 - np.cumsum(count)[:-1] / len(rows)
    # Spread features to a like scale: rare places get larger steps.
    scale = 1 / np.sqrt(np.bincount(column, weights=value**2, minlength=len(used)) / len(rows) + 1e-6)
    value = value * scale[column]
    start = np.log((1 - above) / above)
    theta = np.concatenate([np.zeros(len(used)), start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    steps = len(grades) - 1
    for t in range(1, rounds + 1):
        w, cuts = theta[: len(used)], np.cumsum(np.concatenate([theta[len(used) : len(used) + 1], np.exp(theta[len(used) + 1 :])]))
        score = np.bincount(owner, weights=value * w[column], minlength=len(rows))
        # cdf[:, k] = P(level < k); the ends are 0 and 1.
        cdf = np.concatenate([np.zeros((len(rows), 1)), 1 / (1 + np.exp(np.clip(score[:, None] - cuts[None, :], -40, 40))), np.ones((len(rows), 1))], axis=1)
        slope = cdf * (1 - cdf)
        at = np.arange(len(rows))
        p = np.maximum(cdf[at, level + 1] - cdf[at, level], 1e-12)
        d_score = (slope[at, level + 1] - slope[at, level]) / p / len(rows)
        grad_w = np.bincount(column, weights=value * d_score[owner], minlength=len(used)) + ridge * w
        grad_cut = np.zeros(steps)
        for k in range(steps):
            grad_cut[k] = (-(slope[at, k + 1] / p)[level == k].sum() + (slope[at, k + 1] / p)[level == k + 1].sum()) / len(rows)
        tail = np.cumsum(grad_cut[::-1])[::-1]
        grad = np.concatenate([grad_w, tail[:1], tail[1:] * np.exp(theta[len(used) + 1 :])])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8) / np.sqrt(1 + t / 30)
    weights = np.zeros(dim)
    weights[used] = theta[: len(used)] * scale
    return OrdinalModel(weights, np.cumsum(np.concatenate([theta[len(used) : len(used) + 1], np.exp(theta[len(used) + 1 :])])), grades)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a whole text."""
    words = (text or "").split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    at = np.array([places(w) for w in words]).ravel()
    found, count = np.unique(at, return_counts=True)
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    if repeats:
        found, count = np.append(found, REPEAT), np.append(count, repeats)
    return found, count / len(words)


def fit_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", grade: str = "quality", max_rows: int = MAX_ROWS) -> OrdinalModel:
    """A model from at most ``max_rows`` graded rows; their features and the weights are what the driver gets."""
    graded = labels.select(F.col(key).alias("key"), F.col(grade).cast("int").alias("grade")).where("key is not null and grade is not null")
    sample = graded.orderBy(F.xxhash64("key"), "key", "grade").limit(max_rows).groupBy("key", "grade").agg(F.count("*").alias("times"))
    texts = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("value"))
    rows = texts.join(F.broadcast(sample), "key").select("key", "grade", "times", "value")  # sample: max_rows rows at most

    def counted(batches):
        for batch in slices(batches):
            found = [features(t) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([f.astype("<i4").tobytes() for f, _ in found], pa.binary()), pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary())], ["key", "grade", "times", "places", "shares"])

    # One text for each graded identifier, by a hash of the text: an identifier on many rows takes no places from others.
    kind = rows.schema["key"].dataType.simpleString()
    first = F.min(F.struct(F.sha2("places", 256).alias("digest"), "places", "shares")).alias("first")
    texts_once = map_batches(rows, counted, f"key {kind}, grade int, times bigint, places binary, shares binary").groupBy("key", "grade", "times").agg(first)
    found = texts_once.orderBy("grade", "first.digest", "key").select("grade", "times", "first.places", "first.shares").collect()
    return fit_ordinal([(np.frombuffer(p, "<i4"), np.frombuffer(s, "<f4").astype(float), g) for g, n, p, s in found for _ in range(n)], DIM + 1)


def score_quality(df: DataFrame, model: OrdinalModel, text: str = "text", at_least: int | None = None, tail: float = 0.5) -> DataFrame:
    """``df`` as ``row`` (all columns), ``expected_grade``, ``tail_probability`` and ``kept``.

    The tail probability is that of a grade of ``at_least`` or more, the second lowest grade if not given. Rows with at
    least ``tail`` are kept.
    """
    weights = model.weights.astype(np.float32)
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast((weights, model.thresholds, model.grades))  # DIM + 1 floats
    level = next((k for k, g in enumerate(model.grades[1:]) if at_least is None or g >= at_least), len(model.grades) - 2)

    def scored(batches):
        weights, thresholds, grades = shared.value
        own = OrdinalModel(weights, thresholds, grades)
        memo: dict[str, float] = {}
        for batch in slices(batches):
            scores = []
            for value in batch.column(1).to_pylist():
                words = (value or "").split()
                if not words or not len(thresholds):
                    scores.append(0.0)
                    continue
                if len(memo) > MEMO_WORDS:
                    memo.clear()
                for word in set(words).difference(memo):
                    a, b = places(word)
                    memo[word] = float(weights[a]) + float(weights[b])
                total = sum(map(memo.__getitem__, words))
                if weights[REPEAT]:
                    total += float(weights[REPEAT]) * sum(map(str.__eq__, words, words[1:]))
                scores.append(total / len(words))
            scores = np.array(scores)
            if len(thresholds):
                expected, tails = own.expected(scores), own.tails(scores)[:, level]
            else:
                expected, tails = np.full(len(scores), float(grades[0])), np.ones(len(scores))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(expected, pa.float64()), pa.array(tails, pa.float64())], ["row", "expected_grade", "tail_probability"])

    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(text).cast("string").alias("value"))
    schema = T.StructType([rows.schema["row"], T.StructField("expected_grade", T.DoubleType()), T.StructField("tail_probability", T.DoubleType())])
    return map_batches(rows, scored, schema).withColumn("kept", F.col("tail_probability") >= tail)
