"""Periodic runs of words by an online sparse dynamic programme over diagonals.

A run is a stretch of words whose smallest period is ``q`` (words ``q`` apart are the same), at least ``least`` words
and ``times`` periods long, that no neighbouring word extends. The words are read once from left to right. A diagonal
is a lag ``d``; its cell at word ``i`` is the number of words before and at ``i`` that equal the word ``d`` places
earlier. Only diagonals in use are kept: an earlier occurrence of a word's context opens one, every word that matches
adds one to it, and at the first that doesn't match it ends and gives its run at once, if that is long enough.

Which occurrences open a diagonal keeps the programme sparse and still exact. With windows of ``W`` = 16, 32, 64, ...
words, the nearest earlier occurrence of the window that ends at a word opens its lag ``d`` if ``W/2 < d <= W`` (any
``d <= 16`` for the first). Every run opens its diagonal: a run of period ``q`` in ``(W/2, W]`` holds windows whose shift by ``q`` is in it
as well. One of them has no period up to ``W/2``, else all share one, and it would be a smaller period of the
run; its occurrences are more than ``W/2`` apart, so the one at lag ``q`` is the nearest. (For ``q <= 8`` a window of 16
holds two periods, which allow no nearer occurrence.) A diagonal that is opened late is counted back to
its beginning. So a word repeated a million times has one diagonal, not a million, and time is n log n.

Windows are compared by 64-bit hashes, only to open diagonals; lengths are counted on the words themselves.

Defined cases: a null text has no words, like an empty one; repeated rows give repeated rows; an empty table gives an
empty one; other columns are carried along whatever their names; the order of runs is by start, then period, so ties are
settled. Texts are never cut: a task holds the words of one slice of rows, and of one text of any length, at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.tasks import map_batches, slices

#: Words of the shortest window. Any run of 24 words and three periods has that many matches in a row.
WINDOW = 16
LEAST, TIMES = 24, 3
_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _nearest(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose key occurs earlier, and how far back the nearest occurrence is."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = np.flatnonzero(ordered[1:] == ordered[:-1])
    return order[same + 1], order[same + 1] - order[same]


def _doubled(keys: np.ndarray, width: int, step: int) -> np.ndarray:
    """Hashes of windows of twice ``width`` words by those of ``width``."""
    with np.errstate(over="ignore"):
        mixed = keys[:-width] * _STEPS[step % 4] + np.uint64(2 * step + 1)
        return (mixed ^ (mixed >> np.uint64(29))) * _STEPS[(step + 1) % 4] + keys[width:]


def _windows(words: list) -> tuple[np.ndarray, int]:
    """Hashes of the windows of :data:`WINDOW` words, by their first word, and the number of doublings."""
    keys, width, step = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64), 1, 0
    while width < WINDOW:
        keys = _doubled(keys, width, step)
        width, step = 2 * width, step + 1
    return keys, step


def openings(words: list, keys: np.ndarray | None = None, step: int = 4) -> dict[int, list[int]]:
    """For each word at which a diagonal can open: the lags."""
    found: dict[int, list[int]] = {}
    if len(words) < LEAST:
        return found
    if keys is None:
        keys, step = _windows(words)
    width = WINDOW
    while True:
        places, lags = _nearest(keys)
        if not len(places):
            return found
        use = (lags <= width) & ((lags > width // 2) | (width == WINDOW)) & (TIMES * lags <= len(words))
        for place, lag in zip((places[use] + width - 1).tolist(), lags[use].tolist()):
            found.setdefault(place, []).append(lag)
        if 2 * width + width > len(words):
            return found
        keys = _doubled(keys, width, step)
        width, step = 2 * width, step + 1


def primitive(words: list, start: int, period: int) -> bool:
    """Whether no smaller period divides the words from ``start`` on, which repeat after ``period``."""
    for part in range(1, period // 2 + 1):
        if period % part == 0 and words[start : start + period - part] == words[start + part : start + period]:
            return False
    return True


def find_runs(words: list, opened: dict[int, list[int]] | None = None, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """The runs as (start, length, period), by start and then period."""
    if least < LEAST or times < TIMES:
        raise ValueError(f"runs shorter than {LEAST} words or {TIMES} periods are not searched for")
    opened = openings(words) if opened is None else opened
    runs, active = [], {}
    if not opened:
        return runs
    places = sorted(opened)
    position, following = places[0], 0
    while True:
        if position == len(words) or not active:
            # Without diagonals nothing happens before the next opening.
            while following < len(places) and places[following] < position:
                following += 1
            if position < len(words) and following < len(places):
                position = places[following]
            elif not active:
                break
        ended = active if position == len(words) else [d for d in active if words[position] != words[position - d]]
        for lag in list(ended):
            matches = active.pop(lag)
            length, start = matches + lag, position - matches - lag
            if length >= max(least, times * lag) and primitive(words, start, lag):
                runs.append((start, length, lag))
        if position == len(words):
            break
        for lag in active:
            active[lag] += 1
        for lag in opened.get(position, ()):
            if lag not in active:
                back = position
                while back >= lag and words[back] == words[back - lag]:
                    back -= 1
                if back < position:
                    active[lag] = position - back
        position += 1
    return sorted(runs, key=lambda run: (run[0], run[2]))


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run has after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[k] for k in np.flatnonzero(keep).tolist()]


def runs_of_texts(texts: list[bytes | None]) -> list[tuple[list, list[tuple[int, int, int]]]]:
    """Words and runs of each text; one sort finds the texts in which any window of 16 words occurs twice."""
    split = [(t or b"").split() for t in texts]  # bytes: white space is space and U+0009 to U+000D
    prepared, keys, owners = {}, [], []
    for number, words in enumerate(split):
        if len(words) >= LEAST:
            prepared[number] = _windows(words)
            keys.append(prepared[number][0])
            owners.append(np.full(len(keys[-1]), number))
    found: list = [[]] * len(split)
    if keys:
        owner, joined = np.concatenate(owners), np.concatenate(keys)
        places, lags = _nearest(joined ^ (owner.astype(np.uint64) * _STEPS[0]))
        for number in np.unique(owner[places]).tolist():
            found[number] = find_runs(split[number], openings(split[number], *prepared[number]))
    return list(zip(split, found))


RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


def detect_runs(df: DataFrame, text: str | Column = "text") -> DataFrame:
    """``df`` as ``row`` (all columns), ``n_words``, ``runs`` (start, length, period) and ``collapsed``.

    ``collapsed`` is the text's words joined by one space, without those that a run has after its first period.
    """

    def detected(batches):
        for batch in slices(batches):
            results = runs_of_texts(batch.column(1).to_pylist())
            runs = [[{"start": s, "length": n, "period": q} for s, n, q in found] for _, found in results]
            collapsed = [b" ".join(collapse(words, found)).decode() for words, found in results]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(w) for w, _ in results], pa.int64()), pa.array(runs, kind), pa.array(collapsed, pa.string())],
                ["row", "n_words", "runs", "collapsed"],
            )

    value = F.col(text) if isinstance(text, str) else text
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), value.cast("string").cast("binary").alias("value"))
    schema = T.StructType([rows.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    return map_batches(rows, detected, schema)


def strongest(runs: str = "runs") -> Column:
    """The run with the greatest exact length / period; of equal ones the first. Null without a run."""
    stronger = lambda best, run: F.when(run.length * best.period > best.length * run.period, run).otherwise(best)
    return F.when(F.size(runs) > 0, F.reduce(F.col(runs), F.element_at(runs, 1), stronger))


def made_periodic(key: str = "doc_id", text: str = "text") -> Column:
    """The words of ``text``, joined by one space; in a tenth of the rows the last ones repeat with a period.

    With ``h`` the CRC-32 of the decimal key, ``g = floor(h / 10)`` and ``n`` words, rows with ``h % 10 = 0`` get at place ``i >= a``
    their word at ``a + (i - a) % p``, where ``a = g % n`` and ``p = 1 + floor((n - a) / (3 + g % 8))``. Others are as they are.
    """
    h = F.crc32(F.col(key).cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeated(parts: Column) -> Column:
        n = F.size(parts).cast("bigint")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.element_at(parts, (F.lit(1) + a + (i - a) % p).cast("int")))
        return F.array_join(F.concat(F.slice(parts, F.lit(1), a.cast("int")), tail), " ")

    # The words are bound once for each row, not split anew for every place.
    bound = F.element_at(F.transform(F.array(words), lambda parts: F.when(F.size(parts) > 0, repeated(parts)).otherwise("")), 1)
    return F.when(h % 10 == 0, bound).otherwise(F.col(text))
