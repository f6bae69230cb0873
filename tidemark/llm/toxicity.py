"""Toxicity by the nearest labelled examples.

1. Terms are all words of the whole text, known by 64-bit digests. In how many labelled texts of either label each term
   occurs is counted over all training rows; copies of a text count once.
2. A text's vector has ``(1 + log tf) * idf * relevance`` for each of its terms, at length 1 over all of them, those that no
   example has included. The idf is that of the indexed examples. The relevance goes from ``BASE`` for terms that do not
   speak for label 1 to ``1 + BASE``, by the likelihood ratio of the counts without any floor, so every term counts.
3. A bounded sample of labelled examples (``max_examples``, by a hash of the identifier) is the index: all their terms in
   inverted lists with block maxima. Examples with like terms are neighbours in it, which makes the maxima tight.
4. The ``neighbours`` examples of greatest cosine are found exactly: blocks are scored in the order of their bounds, as far
   as these can reach the best. They vote with the square of the cosine as weight, beside a prior vote of weight ``prior``;
   so far examples count little.
5. Votes become probabilities by isotonic regression on the votes that the examples get from the others. For it the words of
   an example are weighed as if its own label had not been counted. A text without words gets the rate of label 1 among
   training texts without words.

Defined cases: null and empty texts are texts without words; very long texts count whole, their terms in one array; of equal
cosines (to 12 digits) the example first in the index is the nearer; a text that shares no term with an example gets the rate of
label 1; null labels and null identifiers are not learned from; repeated labels of one document count each; repeated rows
give repeated rows; without labels of both kinds every score is the rate of label 1 (0 if there are none); other columns
are carried along.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.tasks import map_batches, slices
from tidemark.llm.wand import BlockMaxMatrix
from tidemark.workspace import broadcast_if_small, shared_table

MAX_EXAMPLES, NEIGHBOURS, PRIOR = 6000, 15, 0.05
#: Weight of terms that do not speak for label 1, and the likelihood ratio (natural units, times two) of half the weight above it.
BASE, HALF_RATIO = 0.03, 17.3
MEMO_WORDS, COUNTED_TEXTS = 200_000, 1024
MARKS = re.compile(r"[\W_]+")
ASCII_MARKS = bytes(c for c in range(128) if not chr(c).isalnum() and not chr(c).isspace())


def tokens_of(text: str | None) -> list[bytes]:
    """Pieces between white space in lower case, without ASCII punctuation; ``words_in`` tells their words."""
    return (text or "").lower().encode().translate(None, ASCII_MARKS).split()


def words_in(token: bytes) -> list[str]:
    """The words of a piece: other white space splits it too, and all punctuation goes."""
    text = token.decode()
    return [text] if text.isalnum() else [w for w in (MARKS.sub("", part) for part in text.split()) if w]


def held_out(key: str = "doc_id") -> Column:
    """Rows that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


class FeatureIds(dict):
    """For each piece of text the digests of its words, eight bytes each; a piece is worked out when first met."""

    def __missing__(self, token: bytes) -> bytes:
        found = b"".join(hashlib.blake2b(word.encode(), digest_size=8).digest() for word in words_in(token))
        self[token] = found
        return found

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The terms of a whole text, ascending, and how often each occurs."""
        if len(self) > MEMO_WORDS:
            self.clear()
        return np.unique(np.frombuffer(b"".join(map(self.__getitem__, tokens_of(text))), "<i8"), return_counts=True)


@dataclass
class ToxicityModel:
    terms: np.ndarray  # the examples' terms, ascending
    idf: np.ndarray  # of each
    ones: np.ndarray  # training texts of label 1 that have it
    zeros: np.ndarray  # training texts of label 0 that have it
    n1: int  # training texts of label 1
    n0: int  # training texts of label 0
    other: float  # weight of a term that no example has
    examples: list[tuple[int, int]]  # id, label
    places: list[np.ndarray]  # places of the terms of each example
    counts: list[np.ndarray]  # how often each occurs
    empty_rate: float
    rate: float
    steps: list[tuple[float, float]]  # votes and probabilities, both ascending

    @cached_property
    def weights(self) -> np.ndarray:
        """idf and relevance of each term."""
        return self.idf * (BASE + relevance(self.ones, self.zeros, self.n1, self.n0))

    @cached_property
    def vectors(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Those of the examples. They and the index are made in each worker: only the counts are sent there."""
        return [self.vector(self.terms[p], c) for p, c in zip(self.places, self.counts)]

    @cached_property
    def index(self) -> BlockMaxMatrix:
        owner = np.repeat(np.arange(len(self.places)), [len(p) for p in self.places])
        return BlockMaxMatrix((owner, *(np.concatenate([v[k] for v in self.vectors]) for k in (0, 1))), len(self.terms), len(self.places), block=128)

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and values of the terms that the index has; the length goes over all terms."""
        places = np.searchsorted(self.terms, terms)
        places[places == len(self.terms)] = 0
        known = self.terms[places] == terms
        values = (1 + np.log(counts.astype(float))) * np.where(known, self.weights[places], self.other)
        return places[known], values[known] / np.sqrt(values @ values)

    def query_of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The vector of an example, weighed as if its label had not been counted."""
        places, label = self.places[n], self.examples[n][1]
        ones, zeros = (np.maximum(seen[places] - own, 0) for seen, own in ((self.ones, label), (self.zeros, 1 - label)))
        values = (1 + np.log(self.counts[n].astype(float))) * self.idf[places] * (BASE + relevance(ones, zeros, self.n1 - label, self.n0 - 1 + label))
        return places, values / np.sqrt(values @ values)

    def vote(self, near: list[tuple[int, float]], prior: float) -> float:
        weights = [(cosine * cosine, self.examples[n][1]) for n, cosine in near]
        return (prior * self.rate + sum(w * y for w, y in weights)) / (prior + sum(w for w, _ in weights))

    def calibrated(self, vote: float) -> float:
        if not self.steps:
            return vote
        return float(np.interp(vote, [v for v, _ in self.steps], [p for _, p in self.steps]))


def isotonic(votes: list[float], labels: list[int]) -> list[tuple[float, float]]:
    """Increasing steps (mean vote, share of label 1) of least squares; shares are drawn in by one vote for either label."""
    blocks: list[list[float]] = []  # votes, labels, count
    for vote, label in sorted(zip(votes, labels)):
        blocks.append([vote, label, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    steps: list[tuple[float, float]] = []
    for vote, label, n in blocks:
        share = (label + 0.5) / (n + 1)
        steps.append((vote / n, max(share, steps[-1][1] if steps else 0.0)))
    return steps


def word_ratios(labelled: DataFrame) -> DataFrame:
    """``term``, ``n0``, ``n1``: distinct texts of either label with each term, over all of ``labelled`` (``key``, ``value``, ``label``)."""

    def counted(batches):
        known = FeatureIds()
        for batch in slices(batches, COUNTED_TEXTS):
            found = [known.of(t)[0] for t in batch.column(0).to_pylist()]
            labels = np.repeat(batch.column(1).to_numpy(), [len(f) for f in found])
            terms, place = np.unique(np.concatenate(found), return_inverse=True)
            ones = np.bincount(place, labels, len(terms)).astype(np.int64)
            every = np.bincount(place, minlength=len(terms)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(every - ones), pa.array(ones)], ["term", "n0", "n1"])

    # The copies are told apart by narrow rows; the texts themselves are not shuffled.
    first = labelled.groupBy(F.sha2("value", 256), "label").agg(F.min("key").alias("key")).select("key", "label").distinct()
    once = labelled.join(broadcast_if_small(first, "first-texts"), ["key", "label"], "left_semi").select("value", "label")
    return map_batches(once, counted, "term bigint, n0 bigint, n1 bigint").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def relevance(a: np.ndarray, b: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """What terms in ``a`` of ``n1`` texts of label 1 and ``b`` of ``n0`` others say for label 1: from 0 to 1, without a floor."""

    def part(seen, of, share):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(of * share, 1e-9)), 0.0)

    if not n1 or not n0:
        return np.zeros(len(a))
    share = (a + b) / (n0 + n1)
    ratio = 2 * (part(a, n1, share) + part(b, n0, share) + part(n1 - a, n1, 1 - share) + part(n0 - b, n0, 1 - share))
    return np.where(a * n0 > b * n1, ratio**2 / (ratio**2 + HALF_RATIO**2), 0.0)


def fit_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", max_examples: int = MAX_EXAMPLES, neighbours: int = NEIGHBOURS, prior: float = PRIOR) -> ToxicityModel:
    """A model from the labelled rows that are not held out."""
    spark = docs.sparkSession
    marks = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where(~held_out("key") & F.col("key").isNotNull() & F.col("label").isin(0, 1))
    labelled = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("value")).join(broadcast_if_small(marks, "labels"), "key").select("key", "value", "label")
    wordless = ~F.coalesce(F.col("value").rlike(r"[\p{L}\p{N}]"), F.lit(False))
    n0, n1, empty = labelled.agg(F.sum(1 - F.col("label")), F.sum("label"), F.avg(F.when(wordless, F.col("label")))).first()
    n0, n1 = n0 or 0, n1 or 0
    rate = n1 / (n0 + n1) if n0 + n1 else 0.0
    none = np.zeros(0, np.int64)
    model = ToxicityModel(none, none, none, none, n1, n0, 1.0, [], [], [], rate if empty is None or not n0 or not n1 else float(empty), rate, [])
    if not n0 or not n1:
        return model

    def vectors(batches):
        known = FeatureIds()
        for batch in slices(batches):
            found = [known.of(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([t.tobytes() for t, _ in found], pa.binary()), pa.array([c.astype("<i4").tobytes() for _, c in found], pa.binary())], ["key", "label", "terms", "counts"])

    # The hash up to which rows are taken comes from narrow rows; the limit after it is for repeated identifiers.
    worded = labelled.where(~wordless)
    place = F.xxhash64("key")
    last = worded.select(place.alias("place")).orderBy("place").limit(max_examples).agg(F.max("place")).first()[0]
    if last is None:
        return model
    kind = labelled.schema["key"].dataType.simpleString()
    sample = map_batches(worded.where(place <= last), vectors, f"key {kind}, label int, terms binary, counts binary")
    found = sample.orderBy(place, "key", "label", F.xxhash64("terms", "counts")).limit(max_examples).collect()
    rows = [(r["key"], r["label"], np.frombuffer(r["terms"], "<i8"), np.frombuffer(r["counts"], "<i4")) for r in found if len(r["terms"])]
    if not rows:
        return model
    model.terms, places = np.unique(np.concatenate([r[2] for r in rows]), return_inverse=True)

    counts = shared_table(word_ratios(labelled), "label-words")
    examples_terms = spark.sparkContext.broadcast(model.terms)

    def of_examples(batches):
        for batch in batches:
            terms = batch.column(0).to_numpy()
            at = np.minimum(np.searchsorted(examples_terms.value, terms), len(examples_terms.value) - 1)
            yield batch.filter(pa.array(examples_terms.value[at] == terms))

    seen = map_batches(counts, of_examples, counts.schema).toArrow()
    at = np.searchsorted(model.terms, seen["term"].to_numpy())
    model.ones, model.zeros = np.zeros(len(model.terms), np.int64), np.zeros(len(model.terms), np.int64)
    model.ones[at], model.zeros[at] = seen["n1"].to_numpy(), seen["n0"].to_numpy()
    model.idf = np.log((len(rows) + 1) / (np.bincount(places) + 1)) + 1
    model.other = (np.log(len(rows) + 1) + 1) * BASE

    # Texts of like words are put beside each other: by the most frequent term, then by the weightiest.
    ready = []
    for name, mark, terms, times in rows:
        at, values = model.vector(terms, times)
        ready.append((int(at[times.argmax()]), int(at[values.argmax()]), name, mark, at.astype(np.int32), times.astype(np.min_scalar_type(times.max()))))
    ready.sort(key=lambda r: r[:4])
    model.examples, model.places, model.counts = [r[2:4] for r in ready], [r[4] for r in ready], [r[5] for r in ready]
    shared = spark.sparkContext.broadcast(model)  # max_examples vectors

    def others(batches):
        model = shared.value
        for batch in slices(batches):
            votes, kinds, numbers = [], [], batch.column(0).to_pylist()
            for n, best in zip(numbers, model.index.nearest_of([model.query_of(n) for n in numbers], neighbours + 1)):
                votes.append(model.vote([x for x in best if x[0] != n][:neighbours], prior))
                kinds.append(model.examples[n][1])
            yield pa.RecordBatch.from_arrays([pa.array(votes, pa.float64()), pa.array(kinds, pa.int32())], ["vote", "label"])

    numbers = spark.range(len(ready), numPartitions=max(1, min(len(ready) // 200 + 1, 24)))
    votes = map_batches(numbers, others, "vote double, label int").collect()
    shared.destroy()
    examples_terms.destroy()
    model.steps = isotonic([v["vote"] for v in votes], [v["label"] for v in votes])
    return model


def score_toxicity(df: DataFrame, model: ToxicityModel, text: str = "text", neighbours: int = NEIGHBOURS, prior: float = PRIOR) -> DataFrame:
    """``df`` as ``row`` (all columns), ``score`` from 0 to 1, and ``evidence``: identifiers of the five nearest examples."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        model, known = shared.value, FeatureIds()
        for batch in slices(batches):
            scores, evidence = [], []
            found = [known.of(value) for value in batch.column(1).to_pylist()]
            queries = [model.vector(*own) if len(own[0]) and model.examples else (own[0][:0], np.zeros(0)) for own in found]
            nearest = model.index.nearest_of(queries, neighbours) if model.examples else [[]] * len(found)
            for (terms, _), near in zip(found, nearest):
                score = model.calibrated(model.vote(near, prior)) if near else model.rate if len(terms) else model.empty_rate
                scores.append(min(max(score, 0.0), 1.0))
                evidence.append([model.examples[n][0] for n, _ in near[:5]])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(evidence, pa.list_(pa.int64()))], ["row", "score", "evidence"])

    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(text).cast("string").alias("value"))
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType()), T.StructField("evidence", T.ArrayType(T.LongType()))])
    return map_batches(rows, scored, schema)
