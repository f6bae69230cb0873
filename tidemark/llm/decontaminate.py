"""Benchmark decontamination: every training passage as a query to a BM25 index of the test items.

An item's BM25 impacts are divided by the item's score for its own words, so 1 means that a passage holds all of them
and one threshold fits items of all lengths. A passage is a window of twice the longest item, each starting
half a window after the one before; so a copy of an item lies within one passage as a whole. Sums of the terms'
block maxima over half windows rule out most passages (no block of items can reach the threshold there, so WAND
would skip them all); in the others WAND finds all items above the threshold.

A hit is verified on its passage: of the item's question and of its answer, each at least ``overlap`` of the word
shingles must be there. The answer is the last sentence, or the last quarter where little else would be
left.

The index is as large as the items, so items are taken in parts of at most ``max_index_bytes`` of text, with the
statistics of all items; each part is one pass over the documents.

Words are split by white space, compared in lower case without punctuation. Defined cases: texts and items that
are null or without words hit nothing; repeated items are items of their own; repeated rows give repeated hits; without items or
documents there are no hits; other columns are carried along.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.tasks import map_batches, slices
from tidemark.llm.wand import BlockMaxIndex

K1, B = 1.2, 0.75
SHINGLE = 5
MARKS = re.compile(r"[\W_]+")
SENTENCE_END = re.compile(r"(?<=[.!?])\s+|\n+")
MEMO_WORDS = 250_000
#: Halves of windows whose bounds are computed at a time.
PORTION = 64
LEAKS = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("question_overlap", T.DoubleType()), T.StructField("answer_overlap", T.DoubleType())]))


def plain(word: str) -> str:
    """A word without punctuation, in lower case."""
    return MARKS.sub("", word.lower())


def words_of(text: str | None) -> list[str]:
    return [p for p in map(plain, (text or "").split()) if p]


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The item's words without its last sentence, and those of its last sentence."""
    parts = [w for w in (words_of(s) for s in SENTENCE_END.split(text)) if w]
    whole = [w for p in parts for w in p]
    answer = len(parts[-1]) if len(parts) > 1 and len(whole) - len(parts[-1]) >= SHINGLE else max(1, len(whole) // 4)
    cut = len(whole) - answer
    return whole[:cut], whole[cut:]


def shingle_set(words: list, width: int = SHINGLE) -> set[tuple]:
    width = min(width, len(words))
    return set(zip(*(words[k:] for k in range(width)))) if width else set()


def share_found(wanted: set[tuple], words: list) -> float:
    """The share of shingles, all of one width, that a passage has; nothing wanted counts as found."""
    if not wanted:
        return 1.0
    width = len(next(iter(wanted)))
    return len(wanted & set(zip(*(words[k:] for k in range(width))))) / len(wanted)


class ItemIndex:
    """BM25 over some items; ``frequency``, ``total`` and ``mean_length`` are those of all items."""

    def __init__(self, items: list[tuple[int, str]], frequency: dict[str, int], total: int, mean_length: float, threshold: float, overlap: float):
        self.threshold, self.overlap = threshold, overlap
        rows = [(i, t, words_of(t)) for i, t in sorted(items, key=lambda x: (x[0] is None, x[0], x[1]))]
        rows = [r for r in rows if r[2]]
        self.keys = [r[0] for r in rows]
        self.terms: dict[str, int] = {}
        postings, self.questions, self.answers, longest = [], [], [], 0
        for number, (_, text, words) in enumerate(rows):
            impacts = {}
            for word, tf in Counter(words).items():
                df = frequency.get(word, 1)
                idf = math.log(1 + (total - df + 0.5) / (df + 0.5))
                impacts[self.terms.setdefault(word, len(self.terms) + 1)] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean_length))
            whole = sum(impacts.values())
            postings.extend((number, term, impact / whole) for term, impact in impacts.items())
            question, answer = ([self.terms[w] for w in part] for part in question_and_answer(text))
            self.questions.append(shingle_set(question))
            self.answers.append(shingle_set(answer))
            longest = max(longest, len(words))
        self.stride = max(16, longest)
        self.index = BlockMaxIndex(postings, block=4)
        self.blocks = self.index.top_matrix(len(self.terms) + 1, len(rows))
        self.memo: dict[str, int] = {}

    def _terms(self, text: str | None) -> np.ndarray:
        """Term numbers of a text's words; 0 for words of no item."""
        words = (text or "").split()
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        for word in set(words).difference(memo):
            own = plain(word)
            memo[word] = self.terms.get(own, 0) if own else -1
        found = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
        return found[found >= 0]

    def _passages(self, terms: np.ndarray):
        """Windows in which some block of items could reach the threshold.

        The bounds count repeated words each time and add the two halves of a window, so they are never too low.
        """
        step, size = self.stride, len(terms)
        for first in range(0, size, PORTION * step):
            # One half more than the portion, for its last window.
            part = terms[first : first + (PORTION + 1) * step]
            half = np.add.reduceat(self.blocks[part], np.arange(0, len(part), step), axis=0)
            whole = half.copy()
            whole[:-1] += half[1:]
            for at in np.flatnonzero((whole >= self.threshold * (1 - 1e-5)).any(axis=1)).tolist():
                start = first + at * step
                if at < PORTION and (start + step < size or not start):
                    yield start, min(start + 2 * step, size)

    def leaks(self, text: str | None) -> list[dict]:
        """Verified items of a text, one entry for each item: its best passage."""
        if not self.keys:
            return []
        terms = self._terms(text)
        if not len(terms):
            return []
        best: dict[int, dict] = {}
        for start, end in self._passages(terms):
            passage = terms[start:end]
            own = np.unique(passage)
            if not (self.blocks[own].sum(axis=0) >= self.threshold * (1 - 1e-5)).any():
                continue
            for number, score in self.index.above(dict.fromkeys(own.tolist(), 1.0), self.threshold):
                words = passage.tolist()
                question, answer = share_found(self.questions[number], words), share_found(self.answers[number], words)
                if question >= self.overlap and answer >= self.overlap:
                    hit = {"item_id": self.keys[number], "score": min(score, 1.0), "question_overlap": question, "answer_overlap": answer}
                    if number not in best or (hit["score"], question, answer) > (best[number]["score"], best[number]["question_overlap"], best[number]["answer_overlap"]):
                        best[number] = hit
        return [best[n] for n in sorted(best)]


def item_parts(items: DataFrame, key: str, text: str, max_index_bytes: int):
    """Items in parts of bounded size, each with the statistics of all items for its words."""
    rows = items.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("value")).where(F.trim("value") != "")

    def split(batches):
        for batch in slices(batches):
            own = [words_of(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([sorted(set(w)) for w in own], pa.list_(pa.string())), pa.array(list(map(len, own)), pa.int64())], ["key", "value", "terms", "length"])

    split_rows = map_batches(rows, split, "key bigint, value string, terms array<string>, length bigint").where("length > 0")
    total, length, size = split_rows.agg(F.count("*"), F.avg("length"), F.coalesce(F.sum(F.octet_length("value")), F.lit(0))).first()
    if not total:
        return
    frequency = split_rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    parts = -(-size // max_index_bytes)
    for part in range(parts):
        own = split_rows.where(F.pmod(F.xxhash64("key", "value"), F.lit(parts)) == part)
        used = own.select(F.explode("terms").alias("term")).distinct()
        counts = {r["term"]: r["n"] for r in frequency.join(used, "term").collect()}
        yield [(r["key"], r["value"]) for r in own.select("key", "value").collect()], counts, total, length


def find_leaks(df: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", threshold: float = 0.5, overlap: float = 0.6, max_index_bytes: int = 16 << 20) -> DataFrame:
    """``df`` as ``row`` (all columns) and ``leaks``: item, score and overlaps of each verified benchmark item."""
    spark = df.sparkSession
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(text).cast("string").alias("value"))
    schema = T.StructType([rows.schema["row"], T.StructField("value", T.StringType()), T.StructField("leaks", LEAKS)])
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())]))
    result = rows.withColumn("leaks", F.array().cast(LEAKS))
    for part in item_parts(items, item_key, item_text, max_index_bytes):
        shared = spark.sparkContext.broadcast(part)  # at most max_index_bytes of text and its words' counts

        def searched(batches, shared=shared):
            index = ItemIndex(*shared.value, threshold, overlap)
            for batch in slices(batches):
                values = batch.column(1).to_pylist()
                leaks = [index.leaks(t) for t in values]
                if any(batch.column(2).value_lengths().to_pylist()):
                    leaks = [a + b for a, b in zip(batch.column(2).to_pylist(), leaks)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaks, kind)], ["row", "value", "leaks"])

        result = map_batches(result, searched, schema)
    return result.select("row", "leaks")
