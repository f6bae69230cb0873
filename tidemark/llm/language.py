"""Language by prediction by partial matching: frozen byte context trees with escapes, exact code lengths.

Each language has a tree of the contexts of up to ``order`` bytes that precede a byte in its texts. With frozen
counts, byte ``s`` after context ``c`` has the probability (escape method C, with exclusion)

    n(c, s) / (N(c) + q(c))                                         if the tree has s after c
    e(c) * P(s | c without its first byte) / (1 - the sum of that P over the bytes that the tree has after c)

where ``N`` counts the bytes seen after ``c``, ``q`` the different ones, and the escape ``e(c)`` is what the bytes of the
tree leave. A context that the tree lacks costs no escape. Below the empty context all 256 bytes are alike. So
the probabilities after any context sum to one, and the sum of ``-log2`` over a text is the length of its code, to
which the language's share of the learnt rows adds ``-log2`` as the cost of naming it. The shortest code wins; the score
is the language's part of the sum of 2^-length over all.

Code lengths are integers (1/65536 bit), so a text's sum is exact whatever the order. Texts are folded first:
lower case, every run of ASCII signs that are no letters one space.

Counts cover all learnt rows: tasks count the longest contexts, Spark adds them and derives the shorter ones. The
tree's size has a proven bound at any size of corpus: a byte after a context is a node if it makes up at least ``share`` of its
language's bytes, where ``share = languages^2 * (order + 1) / max_cells``, so the tables that go to the workers have at most
``max_cells`` numbers for nodes. What is no node adds to its context's escape; totals stay those of all texts.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; without any learnt row every text is. Rows with a
null language or text teach nothing. Of languages with equal code lengths the first by name wins. Repeated rows count, and are
answered, as often as they occur; very long texts are read in pieces of :data:`PIECE` bytes, which changes no sum; an empty
table gives an empty one; other columns are carried along whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.tasks import map_batches, slices
from tidemark.workspace import shared_table

#: Bytes of the longest context.
ORDER = 4
#: Numbers in the workers' tables, at most: 4 bytes each.
MAX_CELLS = 1 << 24
#: Parts of a bit that code lengths are counted in.
UNIT = 1 << 16
#: Bytes that are looked up at a time.
PIECE = 1 << 20
#: Different contexts that a task holds before it gives out their counts.
HELD = 1 << 20
UNKNOWN = "und"

LETTER = regex.compile(r"\p{L}")
SMALL = bytes(range(0x61, 0x7B))
#: ASCII letters in lower case, other ASCII as spaces; the bytes of further characters stay.
FOLD = bytes(b if b >= 0x80 or b in SMALL else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def folded(text: str) -> np.ndarray:
    """The bytes of a text that are learnt and coded; it begins with a space."""
    data = np.frombuffer(b" " + text.lower().encode().translate(FOLD), np.uint8)
    blank = data == 32
    return data[np.append(True, ~(blank[1:] & blank[:-1]))]


def has_letter(text: str | None) -> bool:
    return bool(text) and LETTER.search(text) is not None


def grams(data: np.ndarray, width: int) -> np.ndarray:
    """For each byte: it and the ``width - 1`` before it as one number, the byte lowest. Spaces come before the text."""
    padded = np.concatenate([np.full(width - 1, 32, np.uint8), data]).astype(np.uint64)
    codes = np.zeros(len(data), np.uint64)
    for k in range(width):
        codes = (codes << np.uint64(8)) | padded[k : k + len(data)]
    return codes


def _found(table: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``codes`` in the sorted ``table``, and which are there."""
    if not len(table):
        return np.zeros(len(codes), np.int64), np.zeros(len(codes), bool)
    at = np.minimum(np.searchsorted(table, codes), len(table) - 1)
    return at, table[at] == codes


class Tree:
    """One language's nodes by order: (context, byte) with its count, and each context's totals."""

    def __init__(self, nodes: list[tuple[np.ndarray, np.ndarray]], contexts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.codes, self.probability, self.contexts, self.backoff = [], [], [], []
        for order, ((codes, counts), (names, totals, kinds)) in enumerate(zip(nodes, contexts)):
            owner, known = _found(names, codes >> np.uint64(8))
            assert known.all()
            weight = (totals + kinds).astype(float)
            p = counts / weight[owner]
            below = self.of(order - 1, codes & np.uint64((1 << 8 * order) - 1)) if order else np.full(len(codes), 1 / 256)
            escape = 1 - np.bincount(owner, p, len(names))
            # Bytes that the tree has nowhere keep this at a positive value; the floor is for rounding.
            rest = np.maximum(1 - np.bincount(owner, below, len(names)), 1e-12)
            self.codes.append(codes)
            self.probability.append(p)
            self.contexts.append(names)
            self.backoff.append(np.maximum(escape, 1e-12) / rest)

    def of(self, order: int, codes: np.ndarray) -> np.ndarray:
        """P(byte | context of ``order`` bytes) for numbers made of both."""
        if order < 0:
            return np.full(len(codes), 1 / 256)
        at, known = _found(self.codes[order], codes)
        result = np.zeros(len(codes))
        result[known] = self.probability[order][at[known]]
        other = ~known
        if other.any():
            context, has = _found(self.contexts[order], codes[other] >> np.uint64(8))
            factor = np.where(has, self.backoff[order][context] if len(self.backoff[order]) else 1.0, 1.0)
            result[other] = factor * self.of(order - 1, codes[other] & np.uint64((1 << 8 * order) - 1))
        return result

    def escape_of(self, order: int, contexts: np.ndarray) -> np.ndarray:
        at, has = _found(self.contexts[order], contexts)
        return np.where(has, self.backoff[order][at] if len(self.backoff[order]) else 1.0, 1.0)


def _lengths(probability: np.ndarray) -> np.ndarray:
    return np.rint(-np.log2(probability) * UNIT).astype(np.int32)


@dataclass
class LanguageModel:
    """Code lengths of all languages at once: one table of nodes and one of contexts for each order."""

    names: list[str]
    naming: np.ndarray
    nodes: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, trees: dict[str, Tree], rows: dict[str, int], order: int) -> LanguageModel:
        names = sorted(trees, key=str.encode)
        total = sum(rows[n] for n in names)
        naming = _lengths(np.array([rows[n] / total for n in names])).astype(np.int64)
        nodes, contexts = [], []
        for k in range(order + 1):
            codes = np.arange(256, dtype=np.uint64) if k == 0 else np.unique(np.concatenate([trees[n].codes[k] for n in names]))
            nodes.append((codes, np.array([_lengths(trees[n].of(k, codes)) for n in names])))
            found = np.unique(np.concatenate([trees[n].contexts[k] for n in names]))
            contexts.append((found, np.array([_lengths(trees[n].escape_of(k, found)) for n in names])))
        return cls(names, naming, nodes, contexts)

    def lengths(self, texts: list[np.ndarray]) -> np.ndarray:
        """Code lengths, a row for each text (not empty) and a column for each language; names are not counted."""
        order = len(self.nodes) - 1
        total = np.zeros((len(texts), len(self.names)), np.int64)
        pieces, owners, size = [], [], 0
        for number, data in enumerate(texts):
            for start in range(0, len(data), PIECE):
                # The bytes before a piece are its first contexts; their own numbers are left out.
                before = min(start, order)
                pieces.append(grams(data[start - before : start + PIECE], order + 1)[before:])
                owners.append(number)
                size += len(pieces[-1])
                if size >= PIECE:
                    self._add(pieces, owners, total)
                    pieces, owners, size = [], [], 0
        self._add(pieces, owners, total)
        return total

    def _add(self, pieces: list[np.ndarray], owners: list[int], total: np.ndarray) -> None:
        if not pieces:
            return
        codes = np.concatenate(pieces)
        places = np.cumsum([0, *map(len, pieces[:-1])])
        left = np.arange(len(codes))
        bits = np.zeros((len(self.names), len(codes)), np.int32)
        for order in range(len(self.nodes) - 1, -1, -1):
            table, values = self.nodes[order]
            at, known = _found(table, codes)
            where = left[known]
            for own, value in zip(bits, values):
                own[where] += value[at[known]]
            codes, left = codes[~known], left[~known]
            if not len(codes):
                break
            table, values = self.contexts[order]
            at, known = _found(table, codes >> np.uint64(8))
            for own, value in zip(bits, values):
                own[left[known]] += value[at[known]]
            codes = codes & np.uint64((1 << 8 * order) - 1)
        for language, own in enumerate(bits):
            np.add.at(total[:, language], owners, np.add.reduceat(own, places, dtype=np.int64))

    def best(self, texts: list[str | None]) -> list[tuple[str, float, list[int]]]:
        """Language, score and code lengths (in :data:`UNIT`) of each text."""
        result: list[tuple[str, float, list[int]]] = [(UNKNOWN, 0.0, [])] * len(texts)
        asked = [k for k, t in enumerate(texts) if self.names and has_letter(t)]
        if not asked:
            return result
        lengths = self.lengths([folded(texts[k]) for k in asked]) + self.naming
        first = lengths.argmin(axis=1)
        gap = (lengths - lengths.min(axis=1, keepdims=True)) / UNIT
        score = 1 / np.exp2(-np.minimum(gap, 1000)).sum(axis=1)
        for k, language, value, own in zip(asked, first.tolist(), score.tolist(), lengths.tolist()):
            result[k] = (self.names[language], value, own)
        return result


def gram_counts(docs: DataFrame, text: str, lang: str, width: int) -> DataFrame:
    """``lang``, ``code``, ``n``: how often each byte with its context occurs; several rows for one code."""

    def counted(batches):
        held: dict[str, list] = defaultdict(list)
        size = 0

        def merged():
            for name, parts in held.items():
                codes, owner = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
                yield name, codes, np.bincount(owner, np.concatenate([n for _, n in parts]), len(codes)).astype(np.int64)

        def given(found):
            for name, codes, counts in found:
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(counts)], ["lang", "code", "n"])

        for batch in slices(batches):
            texts = defaultdict(list)
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = folded(value)
                # Each text begins with spaces, in place of what precedes it.
                texts[name].extend(grams(data[max(s - width + 1, 0) : s + PIECE], width)[min(s, width - 1) :] for s in range(0, len(data), PIECE))
            for name, parts in texts.items():
                codes, counts = np.unique(np.concatenate(parts), return_counts=True)
                held[name].append((codes, counts))
                size += len(codes)
            if size >= HELD:
                found = list(merged())
                held.clear()
                size = sum(len(c) for _, c, _ in found)
                if size >= HELD // 2:
                    yield from given(found)
                    size = 0
                else:
                    for name, codes, counts in found:
                        held[name].append((codes, counts))
        yield from given(merged())

    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("value")).where("lang is not null and value is not null")
    return map_batches(rows, counted, "lang string, code bigint, n bigint")


def fit_languages(docs: DataFrame, text: str = "text", lang: str = "lang", order: int = ORDER, max_cells: int = MAX_CELLS) -> LanguageModel:
    """The model of all rows of ``docs`` that have a language; the driver gets its bounded tables only."""
    if not 1 <= order <= 6:
        raise ValueError("order is 1 to 6")
    learnt = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = {r.lang: r.n for r in learnt.groupBy(F.col(lang).cast("string").alias("lang")).agg(F.count("*").alias("n")).collect()}
    counts = gram_counts(learnt, text, lang, order + 1).groupBy("lang", "code").agg(F.sum("n").alias("n"))
    counts = shared_table(counts, "language-grams")
    share = len(rows) ** 2 * (order + 1) / max_cells
    sizes = counts.groupBy("lang").agg((F.sum("n") * share).alias("least"))  # a row for each language
    nodes, contexts = {}, {}
    for k in range(order + 1):
        code = F.col("code").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1))
        level = counts.groupBy("lang", code.alias("code")).agg(F.sum("n").alias("n")).join(F.broadcast(sizes), "lang")
        kept = F.col("n") >= F.col("least")
        found = (
            level.groupBy("lang", F.shiftright("code", 8).alias("context"))
            .agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.collect_list(F.when(kept, F.struct(F.col("code"), F.col("n")))).alias("nodes"))
            .where(F.size("nodes") > 0)  # at most 256 in each
        )
        table = found.toArrow()  # no more rows than nodes, whose number is bounded
        owner = np.array(table.column("lang").to_pylist(), dtype=object)
        context = table.column("context").to_numpy().astype(np.uint64)
        total, kinds = table.column("total").to_numpy(), table.column("kinds").to_numpy()
        lists = table.column("nodes").combine_chunks()
        lists = lists if isinstance(lists, pa.ListArray) else pa.concat_arrays(lists.chunks)
        sizes_of = lists.value_lengths().to_numpy()
        inner = lists.flatten()
        own = np.repeat(owner, sizes_of)
        codes, n = inner.field("code").to_numpy().astype(np.uint64), inner.field("n").to_numpy()
        for name in rows:
            pick = np.flatnonzero(own == name)
            pick = pick[np.argsort(codes[pick])]
            nodes[name, k] = (codes[pick], n[pick])
            pick = np.flatnonzero(owner == name)
            pick = pick[np.argsort(context[pick])]
            contexts[name, k] = (context[pick], total[pick], kinds[pick])
    levels = range(order + 1)
    trees = {name: Tree([nodes[name, k] for k in levels], [contexts[name, k] for k in levels]) for name in rows}
    return LanguageModel.of(trees, rows, order) if rows else LanguageModel([], np.zeros(0), [], [])


def identify_languages(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``df`` as ``row`` (all columns), ``lang_pred``, ``score`` and ``bits``, each language's code length by its name."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # at most max_cells numbers of nodes, and their contexts

    def identified(batches):
        own = shared.value
        for batch in slices(batches):
            found = own.best(batch.column(1).to_pylist())
            bits = [list(zip(own.names, (x / UNIT for x in lengths))) for _, _, lengths in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array(bits, pa.map_(pa.string(), pa.float64()))],
                ["row", "lang_pred", "score", "bits"],
            )

    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(text).cast("string").alias("value"))
    schema = T.StructType([rows.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits", T.MapType(T.StringType(), T.DoubleType()))])
    return map_batches(rows, identified, schema)
