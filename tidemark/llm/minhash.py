"""Near duplicates: banded candidates from MinHash, b-bit signatures, links confirmed on full shingle sets.

1. Each text gives its set of word shingles, ``HASHES`` minima, a key for each band of them and a signature that keeps
   ``BITS`` low bits of every minimum, packed.
2. Equal sets are one node, so exact copies cost nothing later.
3. Nodes that share a band key are compared by their signatures: the bits that differ are counted and the share of
   chance agreements, 2^-BITS, is taken out. Estimates down to ``SLACK`` below the threshold join nodes into
   clusters. A band key's nodes are walked, not paired: a node that is in the cluster is not compared again.
4. Within a cluster the full sets decide. A cluster is dealt to tasks in pairs of blocks of bounded size; a task
   counts common shingles as a matrix product and gives a spanning forest of the links, never all pairs.
5. Components of the links.

A pair at the threshold shares no band with a chance of (1 - 0.8^4)^32 < 1e-7, and its estimate is too low with
one below 1e-5; smaller and larger similarities are decided exactly by step 4. The compares in steps 3 and 4 grow with
the square of a cluster's distinct texts over the block size where they are not linked to each other.

Defined cases: texts without words have no shingles and no links; fewer words than a shingle make
one shingle; rows with equal identifiers are one node; null identifiers are one node that comes last; an empty
table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.tasks import map_batches, slices
from tidemark.workspace import broadcast_if_small, shared_table

BANDS, ROWS, BITS = 32, 4, 4
HASHES = BANDS * ROWS
#: How far an estimate may fall short of the threshold: 4.6 standard deviations.
SLACK = 0.17
LAST_ID = (1 << 63) - 1
#: Nodes of one band key, and shingles and nodes of one cluster, that meet in a task as one block.
BUCKET_BLOCK, SET_BLOCK, NODE_BLOCK = 20_000, 400_000, 512

_RANDOM = np.random.default_rng(20_240_229)
_MULTIPLIERS = _RANDOM.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_BAND_MIX = _RANDOM.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WORD_MIX = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOW = np.uint64(0x1111111111111111)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, kept for words seen before."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) < self.LIMIT:
            self[word] = value
        return value


class Shingles:
    """Distinct hashed shingles of texts: words between white space, A-Z in lower case."""

    def __init__(self, width: int):
        self.width, self.words = width, WordHashes()

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        hashes = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(hashes))
        count = len(hashes) - width + 1
        mixed = np.full(count, len(words) if width < self.width else self.width, np.uint64)
        for k in range(width):
            mixed = mixed + hashes[k : k + count] * _WORD_MIX[k]
            mixed = mixed ^ (mixed >> np.uint64(29))
        return np.unique(_mixed(mixed))


def minima(shingles: np.ndarray, chunk: int = 2048) -> np.ndarray:
    """The least value of each hash function over the shingles."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), chunk):
        part = shingles[start : start + chunk, None] * _MULTIPLIERS[None, :]
        part += _SHIFTS
        np.minimum(least, part.min(axis=0), out=least)
    return least


def packed(least: np.ndarray) -> np.ndarray:
    """Signatures of BITS bits for each minimum, from a matrix of minima: 64-bit words."""
    low = (_mixed(least) & np.uint64((1 << BITS) - 1)).reshape(len(least), -1, 64 // BITS)
    shift = (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))[None, None, :]
    return np.bitwise_or.reduce(low << shift, axis=2)


def band_keys(least: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band; the band's number is part of it."""
    rows = least.reshape(len(least), BANDS, ROWS)
    return _mixed((rows * _BAND_MIX[None, :, :]).sum(axis=2, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)[None, :]).view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity by the signatures: the share of equal values without those equal by chance."""
    d = a ^ b
    d = d | (d >> np.uint64(1))
    d = d | (d >> np.uint64(2))
    differ = np.bitwise_count(d & _LOW).sum(axis=-1)
    chance = 2.0**-BITS
    return (1 - differ / HASHES - chance) / (1 - chance)


def signatures(df: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``id``, ``n_shingles``, ``digest`` of the set, ``signature`` and ``bands``; the last three null without words."""

    def signed(batches):
        shingles = Shingles(width)
        for batch in slices(batches):
            sizes, digests, least = [], [], []
            for value in batch.column(1).to_pylist():
                own = shingles(value)
                sizes.append(len(own))
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                if len(own):
                    least.append(minima(own))
            has = np.array([n > 0 for n in sizes], bool)
            signs, keys = iter(()), iter(())
            if least:
                matrix = np.stack(least)
                signs, keys = (x.tobytes() for x in packed(matrix)), iter(band_keys(matrix).tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array([next(signs) if h else None for h in has], pa.binary()),
                    pa.array([next(keys) if h else None for h in has], pa.list_(pa.int64())),
                ],
                ["id", "n_shingles", "digest", "signature", "bands"],
            )

    rows = df.select(F.coalesce(F.col(key).cast("bigint"), F.lit(LAST_ID)).alias("id"), F.col(text).cast("string").alias("value"))
    return shared_table(map_batches(rows, signed, "id bigint, n_shingles bigint, digest binary, signature binary, bands array<bigint>"), "signatures")


def _groups(batches: Iterator[pa.RecordBatch], keys: int, row) -> Iterator[list]:
    """Rows (by ``row``) of consecutive equal keys, the batch's first ``keys`` columns; tasks get them sorted."""
    last, held = None, []
    for batch in slices(batches, 4096):
        columns = [c.to_pylist() for c in batch.columns]
        for values in zip(*columns):
            if values[:keys] != last:
                if held:
                    yield held
                last, held = values[:keys], []
            held.append(row(values[keys:]))
    if held:
        yield held


def _walk(count: int, near) -> Iterator[tuple[int, int]]:
    """A spanning forest of the graph where ``near(i, others)`` marks the neighbours of i among others."""
    left = np.arange(count)
    while len(left):
        stack, left = [int(left[0])], left[1:]
        while stack and len(left):
            here = stack.pop()
            found = near(here, left)
            for other in left[found].tolist():
                yield here, other
                stack.append(other)
            left = left[~found]


def candidate_edges(nodes: DataFrame, threshold: float) -> DataFrame:
    """Edges (``a``, ``b``) between nodes that share a band key and whose estimate is near the threshold or above."""
    exploded = nodes.select("id", F.explode("bands").alias("band"))
    multiple = exploded.groupBy("band").agg(F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("band", F.ceil(F.col("n") / BUCKET_BLOCK).cast("int").alias("blocks"))
    members = exploded.join(broadcast_if_small(multiple, "band-keys"), "band").distinct()
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = members.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "id")
    rows = dealt.join(nodes.select("id", "signature"), "id").select("band", "i", "j", "id", "signature")
    sent = rows.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "id")
    limit = threshold - SLACK

    def walked(batches):
        seen: set[tuple[int, int]] = set()
        edges: list[tuple[int, int]] = []
        for group in _groups(batches, 3, lambda v: v):
            ids = [g[0] for g in group]
            signs = np.frombuffer(b"".join(g[1] for g in group), np.uint64).reshape(len(ids), -1)
            for a, b in _walk(len(ids), lambda i, others, s=signs: estimate(s[i], s[others]) >= limit):
                edge = (max(ids[a], ids[b]), min(ids[a], ids[b]))
                if edge not in seen:
                    seen.add(edge)
                    edges.append(edge)
            if len(edges) >= 50_000:
                yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.int64()), pa.array([e[1] for e in edges], pa.int64())], ["a", "b"])
                edges = []
                seen.clear()
        yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.int64()), pa.array([e[1] for e in edges], pa.int64())], ["a", "b"])

    return map_batches(sent, walked, "a bigint, b bigint")


def common_counts(sets: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Sizes of all intersections of some sets as one matrix."""
    counts = np.zeros((len(sets), len(sets)), np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, place, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = often > 1
    number = np.cumsum(shared) - 1
    keep = shared[place]
    owner, place = owner[keep], number[place[keep]]
    total = int(shared.sum())
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    for start in range(0, total, columns):
        a, b = np.searchsorted(place, [start, start + columns])
        matrix = np.zeros((len(sets), min(columns, total - start)), np.float32)
        matrix[owner[a:b], place[a:b] - start] = 1
        counts += (matrix @ matrix.T).astype(np.int64)
    return counts


def confirmed_links(clusters: DataFrame, df: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """A spanning forest (``a``, ``b``) of the links within ``clusters`` (``id``, ``cluster``, ``n_shingles``), on full sets."""
    weight = F.greatest(F.col("n_shingles"), F.lit(SET_BLOCK // NODE_BLOCK))
    blocks = clusters.groupBy("cluster").agg(F.ceil(F.sum(weight) / SET_BLOCK).cast("int").alias("blocks"))
    members = broadcast_if_small(clusters.join(blocks, "cluster").select("id", "cluster", "blocks"), "clusters")
    texts = df.select(F.coalesce(F.col(key).cast("bigint"), F.lit(LAST_ID)).alias("id"), F.col(text).cast("string").alias("value"))
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = texts.join(members, "id").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "id", "value")
    sent = dealt.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "id")

    def linked(batches):
        shingles = Shingles(width)
        for group in _groups(batches, 3, lambda v: (v[0], shingles(v[1]))):
            ids, sets = [g[0] for g in group], [g[1] for g in group]
            if len(ids) < 2:
                continue
            common, size = common_counts(sets), np.array([len(s) for s in sets])

            def near(i, others, common=common, size=size):
                both = common[i, others]
                return 100 * both >= percent * np.maximum(size[i] + size[others] - both, 1)

            edges = list(_walk(len(ids), near))
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array([ids[a] for a, _ in edges], pa.int64()), pa.array([ids[b] for _, b in edges], pa.int64())], ["a", "b"])

    return map_batches(sent, linked, "a bigint, b bigint")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row for each row of ``df``: ``key``, ``n_shingles``, ``component_id`` and ``kept``.

    Two texts are linked if ``100 * common shingles >= percent * all shingles``.
    """
    signed = signatures(df, key, text, width)
    classes = signed.where("n_shingles > 0").groupBy("digest").agg(F.min("id").alias("rep"))
    members = shared_table(signed.select("id", "n_shingles", "digest").join(classes, "digest", "left").select("id", "n_shingles", "digest", F.coalesce("rep", "id").alias("rep")), "set-classes")
    copies = members.where("id <> rep").select("id", "digest").distinct()
    nodes = shared_table(signed.where("n_shingles > 0").join(copies, ["id", "digest"], "left_anti").select("id", "n_shingles", "signature", "bands"), "nodes")
    near = connected_components(candidate_edges(nodes, percent / 100)).withColumnRenamed("node", "id").withColumnRenamed("component", "cluster")
    clusters = shared_table(near.join(nodes.groupBy("id").agg(F.max("n_shingles").alias("n_shingles")), "id"), "clusters")
    # Repeated identifiers with other sets are one node already.
    same = members.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    links = confirmed_links(clusters, df, key, text, width, percent).unionByName(same)
    components = connected_components(links)
    smallest = F.coalesce("component", "id")
    return (
        members.join(components.withColumnRenamed("node", "id"), "id", "left")
        .select(
            F.when(F.col("id") < LAST_ID, F.col("id")).alias(key),
            "n_shingles",
            F.when(smallest < LAST_ID, smallest).alias("component_id"),
            (F.col("id") == smallest).alias("kept"),
        )
    )
