"""Inverted index with block maxima, and exact searches in it by WAND.

Documents have small integers as numbers; a posting is a document and the impact of the term in it. Each
list knows its largest impact, and the largest in every block of document numbers. A search walks the
lists together, always to the first document that could pass by the lists' maxima (the pivot), and skips
whole blocks that can't pass by the blocks' maxima. It leaves nothing out: what is skipped is below the bar.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable

import numpy as np

END = 1 << 62
#: Upper bounds are sums in another order than scores; this covers the rounding.
ROUND = 1 + 1e-9


class BlockMaxIndex:
    def __init__(self, postings: Iterable[tuple[int, int, float]], block: int = 16):
        """``postings``: (document, term, impact), impacts not negative."""
        self.block = block
        lists: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for doc, term, impact in postings:
            lists[term].append((doc, impact))
        self.docs: dict[int, list[int]] = {}
        self.impacts: dict[int, list[float]] = {}
        self.tops: dict[int, float] = {}
        self.block_tops: dict[int, dict[int, float]] = {}
        for term, own in lists.items():
            own.sort()
            self.docs[term] = [d for d, _ in own]
            self.impacts[term] = [i for _, i in own]
            self.tops[term] = max(i for _, i in own)
            tops: dict[int, float] = defaultdict(float)
            for doc, impact in own:
                tops[doc // block] = max(tops[doc // block], impact)
            self.block_tops[term] = dict(tops)

    def top_matrix(self, terms: int, documents: int) -> np.ndarray:
        """The block maxima as a matrix (term, block)."""
        matrix = np.zeros((terms, -(-documents // self.block) or 1), np.float32)
        for term, tops in self.block_tops.items():
            for block, top in tops.items():
                matrix[term, block] = top
        return matrix

    def above(self, weights: dict[int, float], threshold: float) -> list[tuple[int, float]]:
        """All documents that score ``threshold`` or more, in ascending order."""
        found: list[tuple[int, float]] = []

        def take(doc: int, score: float) -> float:
            if score >= threshold:
                found.append((doc, score))
            return threshold

        self._walk(weights, threshold, take)
        return found

    def nearest(self, weights: dict[int, float], count: int) -> list[tuple[int, float]]:
        """The ``count`` best documents, best first; of equal scores the smaller number comes first."""
        heap: list[tuple[float, int]] = []

        def take(doc: int, score: float) -> float:
            if score > 0:
                heapq.heappush(heap, (score, -doc))
                if len(heap) > count:
                    heapq.heappop(heap)
            # A later document must score more than the last of a full list.
            return np.nextafter(heap[0][0], np.inf) if len(heap) == count else 0.0

        self._walk(weights, 0.0, take)
        return [(-doc, score) for score, doc in sorted(heap, key=lambda x: (-x[0], -x[1]))]

    def _walk(self, weights: dict[int, float], bar: float, take) -> None:
        cursors = []
        for term in sorted(t for t in weights if t in self.docs and weights[t] > 0):
            docs = self.docs[term]
            cursors.append([docs[0], 0, docs, self.impacts[term], weights[term], weights[term] * self.tops[term] * ROUND, self.block_tops[term]])
        block = self.block
        while cursors:
            cursors.sort(key=lambda c: c[0])
            reach, pivot = 0.0, -1
            for place, cursor in enumerate(cursors):
                reach += cursor[5]
                if reach >= bar:
                    pivot = place
                    break
            if pivot < 0:
                return
            doc = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == doc:
                pivot += 1
            here = doc // block
            bound = sum(c[4] * c[6].get(here, 0.0) for c in cursors[: pivot + 1]) * ROUND
            if bound < bar:
                # Nothing in this block can pass, as far as the next list doesn't join.
                goal = (here + 1) * block
                if pivot + 1 < len(cursors):
                    goal = min(goal, cursors[pivot + 1][0])
                goal = max(goal, doc + 1)
                moved = cursors[: pivot + 1]
            elif cursors[0][0] == doc:
                score = 0.0
                for cursor in cursors[: pivot + 1]:
                    score += cursor[4] * cursor[3][cursor[1]]
                bar = take(doc, score)
                goal, moved = doc + 1, cursors[: pivot + 1]
            else:
                goal, moved = doc, [c for c in cursors[:pivot] if c[0] < doc]
            ended = False
            for cursor in moved:
                if cursor[0] < goal:
                    place = bisect_left(cursor[2], goal, cursor[1])
                    cursor[1] = place
                    cursor[0] = cursor[2][place] if place < len(cursor[2]) else END
                    ended = ended or cursor[0] == END
            if ended:
                cursors = [c for c in cursors if c[0] != END]


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers from each start to its end, one range after the other."""
    sizes = ends - starts
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class BlockMaxMatrix:
    """Inverted lists with block maxima, held as arrays: exact nearest documents for long queries, many at a time.

    A sparse list has an entry for each block of documents that has its term: the block, its largest impact and where its
    postings start. Lists of more than ``DENSE`` of all documents are rows of a matrix instead: their part of the scores
    of many queries is one product. It is a lower bound of each score, so the last of the best by it is the first bar; a
    block's bound is the largest of these parts in it and the sum of the maxima of the query's sparse lists. Blocks are opened
    in the order of their bounds, those below the bar never. Memory goes with the postings: a row of the matrix takes at most
    four times what its postings would.
    """

    FIRST, DENSE = 6, 0.125

    def __init__(self, postings: Iterable[tuple[int, int, float]] | tuple[np.ndarray, np.ndarray, np.ndarray], terms: int, documents: int, block: int = 32):
        """``postings``: (document, term, impact), at most one for a document and term, or a tuple of three arrays of these."""
        if not isinstance(postings, tuple):
            rows = list(postings)
            postings = tuple(np.array([r[k] for r in rows], kind) for k, kind in enumerate((np.int64, np.int64, np.float64)))
        docs, term, impacts = postings
        frequent = np.bincount(term, minlength=terms) > self.DENSE * documents
        self.rows = np.where(frequent, np.cumsum(frequent) - 1, -1)
        self.matrix = np.zeros((int(frequent.sum()), documents))
        dense = frequent[term]
        self.matrix[self.rows[term[dense]], docs[dense]] = impacts[dense]
        docs, term, impacts = docs[~dense], term[~dense], impacts[~dense]
        order = np.lexsort((docs, term))
        docs, term, self.impacts = docs[order], term[order], impacts[order]
        self.documents, self.blocks = documents, max(1, -(-documents // block))
        self.block_starts = np.arange(0, documents, block)
        first = np.flatnonzero(np.diff(term * self.blocks + docs // block, prepend=-1))
        self.docs = docs.astype(np.int64)
        self.entry_blocks = docs[first] // block
        self.entry_tops = np.maximum.reduceat(self.impacts, first) if len(first) else np.zeros(0)
        self.entry_starts = np.append(first, len(docs))
        self.starts = np.searchsorted(term[first], np.arange(terms + 1))

    def nearest(self, query: dict[int, float], count: int) -> list[tuple[int, float]]:
        """The ``count`` best documents of positive score, best first; of equal scores (to 12 digits) the smaller number first."""
        terms = np.array(sorted(query), np.int64)
        return self.nearest_of([(terms, np.array([query[t] for t in terms.tolist()], np.float64))], count)[0]

    def nearest_of(self, queries: list[tuple[np.ndarray, np.ndarray]], count: int) -> list[list[tuple[int, float]]]:
        """``nearest`` for many queries: ascending terms and their weights, not negative."""
        if not self.documents:
            return [[] for _ in queries]
        shares, sparse = np.zeros((len(queries), len(self.matrix))), []
        for n, (terms, weights) in enumerate(queries):
            rows = self.rows[terms]
            shares[n, rows[rows >= 0]] = weights[rows >= 0]
            sparse.append((terms[rows < 0], weights[rows < 0]))
        return [self._search(scores, *own, count) for scores, own in zip(shares @ self.matrix, sparse)]

    def _search(self, scores: np.ndarray, terms: np.ndarray, weights: np.ndarray, count: int) -> list[tuple[int, float]]:
        """The best, where ``scores`` has the part of the dense lists."""
        starts, ends = self.starts[terms], self.starts[terms + 1]
        entries, weights = ranges(starts, ends), np.repeat(weights, ends - starts)
        blocks = self.entry_blocks[entries]
        rest = np.bincount(blocks, weights * self.entry_tops[entries], self.blocks)
        bounds = np.maximum.reduceat(scores, self.block_starts) + rest
        order = np.argsort(-bounds, kind="stable")
        order, size = order[rest[order] > 0], self.FIRST
        while True:
            bar = np.partition(scores, -count)[-count] if len(scores) >= count else 0.0
            order = order[bounds[order] >= bar * (1 - 1e-9)]
            if not len(order):
                break
            chosen = np.zeros(self.blocks, bool)
            chosen[order[:size]] = True
            own = chosen[blocks]
            a, b = self.entry_starts[entries[own]], self.entry_starts[entries[own] + 1]
            posts = ranges(a, b)
            # All postings of a document are added here, in the order of the terms.
            scores += np.bincount(self.docs[posts], np.repeat(weights[own], b - a) * self.impacts[posts], self.documents)
            order, size = order[size:], 4 * size
        scores = np.round(scores, 12)
        docs = np.flatnonzero(scores > 0)
        if len(docs) > count:
            docs = docs[scores[docs] >= np.partition(scores[docs], -count)[-count]]
        best = docs[np.lexsort((docs, -scores[docs]))[:count]]
        return list(zip(best.tolist(), scores[best].tolist()))
