"""Merkle manifest, language identification and periodic runs against brute force, with odd rows."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import language, merkle, periodic, queries

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, grp string, ord string, part string, path string, row string, value string, runs string"
DE, EN = "der hund läuft über die straße und bellt laut", "the dog runs over the street and barks loudly"
LOOP = " ".join(f"w{k % 7}" for k in range(60))
ROWS = [
    (1, "a", "de", 3, DE), (2, "a", "de", None, DE.upper()), (3, "a", "en", 3, EN), (4, None, "en", 0, None), (5, None, None, 0, ""), (6, "", "en", 1, " \t\n"),
    (7, "ä", "en", 5, "12 34 !!"), (None, "a", "de", 2, DE), (None, "a", "de", 2, DE), (None, None, None, None, None), (9, "b", "en", 1, EN), (9, "b", "en", 1, EN + " x"),
    (-3, "b", "en", 1, "long word " * 30_000), (10, "b", "en", 1, LOOP), (11, "b", "en", 1, "x " * 100 + LOOP + "\x85y\x1cz"), (20, "b", "de", 1, LOOP), (30, "b", "de", 1, DE),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, *[None] * 7) for r in rows], SCHEMA)


@pytest.fixture
def folder(spark, tmp_path):
    def write(rows, parts=3):
        frame(spark, rows).repartition(parts).write.parquet(str(tmp_path / "documents.parquet"))
        return str(tmp_path)

    return write


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(fields):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([h("".join(found[-1][k : k + 16])) for k in range(0, len(found[-1]), 16)])
    return found


def siblings(tree, place):
    path = []
    for row in tree[:-1]:
        start = place // 16 * 16
        path.append(("".join(row[start:place]), "".join(row[place + 1 : start + 16])))
        place //= 16
    return path


def manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(((r[0] is not None, r[0] or 0), leaf(r), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[1] for x in sorted(groups[g], key=lambda x: x[:2])]) for g in order}
    top, found = levels([trees[g][-1][0] for g in order]), []
    for at, g in enumerate(order):
        for place, (_, digest, r) in enumerate(sorted(groups[g], key=lambda x: x[:2])):
            path, folded = siblings(trees[g], place) + siblings(top, at), digest
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                folded = leaf((*r[:4], r[4] and r[4].encode().lower().decode()))
            for left, right in path:
                folded = h(left + folded + right)
            found.append((r[0], digest, trees[g][-1][0], top[-1][0], h("".join(a + b for a, b in path)), folded, folded == top[-1][0]))
    return found


def many(n):
    # A third of all rows in one group; 100 groups, so the tree over groups has three levels.
    return [(k, "hot" if k % 3 == 0 else f"s{k * 7 % 100}", "en", k, f"Text {k}") for k in range(n)]


@pytest.mark.parametrize("rows", [ROWS, many(1200), many(1), []], ids=["odd", "hot", "one", "none"])
def test_manifest_equals_brute_force(spark, folder, rows):
    got = queries.op11_merkle_manifest(spark, folder(rows)).collect()
    assert Counter(map(tuple, got)) == Counter(manifest(rows))


def test_the_octopus_is_the_least_that_derives_the_root():
    rng = random.Random(2)
    for _ in range(200):
        size, fan = rng.randint(1, 400), rng.choice([2, 3, 16])
        first = rng.randrange(size)
        stop = rng.randint(first + 1, size)
        sizes = merkle.level_sizes(size, fan)
        missing = merkle.missing_nodes(first, stop, sizes, fan)
        known = {(0, k) for k in range(first, stop)} | set(missing)
        for level, below in enumerate(sizes[:-1]):
            touched = {k // fan for lv, k in known if lv == level}
            for k in touched:
                assert all((level, c) in known for c in range(k * fan, min(k * fan + fan, below)))
                known.add((level + 1, k))
        assert (len(sizes) - 1, 0) in known and len(set(missing)) == len(missing) <= 2 * (fan - 1) * len(sizes)


def test_code_lengths_are_those_of_a_distribution(spark):
    model_rows = frame(spark, ROWS)
    model = language.fit_languages(model_rows, order=2)
    assert model.names == ["de", "en"]
    texts = [language.folded(t) for t in (EN, "q", "über zzz", "x" * 50)]
    whole = model.lengths(texts)
    # After any context the 256 bytes have probabilities that add up to one.
    for data in texts:
        base = model.lengths([data])
        more = model.lengths([np.append(data, np.uint8(b)) for b in range(256)]) - base
        assert np.allclose(np.exp2(-more / language.UNIT).sum(axis=0), 1, atol=2e-3)
    # Pieces change nothing.
    piece, language.PIECE = language.PIECE, 7
    try:
        assert (model.lengths(texts) == whole).all()
    finally:
        language.PIECE = piece


def brute_probability(texts, context, byte):
    """Escape method C with exclusion, straight from counts."""
    seen = Counter()
    for data in texts:
        padded = b" " * len(context) + data
        seen.update(padded[k + len(context)] for k in range(len(data)) if padded[k : k + len(context)] == context)
    shorter = (lambda b: brute_probability(texts, context[1:], b)) if context else (lambda b: 1 / 256)
    if not seen:
        return shorter(byte)
    weight = sum(seen.values()) + len(seen)
    if byte in seen:
        return seen[byte] / weight
    return len(seen) / weight * shorter(byte) / (1 - sum(map(shorter, seen)))


def test_code_lengths_equal_brute_force(spark):
    rows = [(k, None, "en", 0, t) for k, t in enumerate([EN, "The cat", "aaa  b!"])] + [(9, None, "de", 0, DE)]
    model = language.fit_languages(frame(spark, rows), order=2)
    texts = [bytes(language.folded(t)) for _, _, lang, _, t in rows if lang == "en"]
    for text in ("the dagger", "öx", "aab aab"):
        data = bytes(language.folded(text))
        want = [-np.log2(brute_probability(texts, (b"  " + data)[k : k + 2], data[k])) for k in range(len(data))]
        got = model.lengths([language.folded(text)])[0, model.names.index("en")] / language.UNIT
        assert abs(got - sum(want)) < 1e-3


def test_language_rows(spark, folder):
    got = {r.doc_id: r for r in queries.op12_language_id(spark, folder(ROWS)).collect()}
    assert len(got) == len({r[0] for r in ROWS})
    assert {k: got[k].lang_pred for k in (1, 2, 3, 9, 30)} == {1: "de", 2: "de", 3: "en", 9: "en", 30: "de"}
    for k in (4, 5, 6, 7):
        assert (got[k].lang_pred, got[k].score) == ("und", 0.0)
    assert all(got[k].held_out == (zlib.crc32(str(k).encode()) % 4 == 2) for k in got if k is not None) and got[None].held_out is False
    assert all(0 <= r.score <= 1 for r in got.values())


@pytest.mark.parametrize("rows", [[], [(1, "a", None, 1, EN)], [(1, "a", "en", 1, None)]], ids=["no rows", "no language", "no text"])
def test_nothing_to_learn_from(spark, folder, rows):
    assert [(r.lang_pred, r.score) for r in queries.op12_language_id(spark, folder(rows)).collect()] == [("und", 0.0)] * len(rows)


def test_a_smaller_tree_keeps_the_totals(spark):
    model = language.fit_languages(frame(spark, ROWS), order=2, max_cells=2000)
    assert sum(len(c) for c, _ in model.nodes[1:]) * len(model.names) <= 2000
    more = model.lengths([np.append(language.folded(EN), np.uint8(b)) for b in range(256)]) - model.lengths([language.folded(EN)])
    assert np.allclose(np.exp2(-more / language.UNIT).sum(axis=0), 1, atol=2e-3)


def runs_by_brute_force(words, least=24, times=3):
    found = []
    for q in range(1, len(words) // times + 1):
        k = 0
        while k + q < len(words):
            stop = k
            while stop + q < len(words) and words[stop] == words[stop + q]:
                stop += 1
            length = stop - k + q
            if stop > k and length >= max(least, times * q) and not any(all(words[x] == words[x + p] for x in range(k, k + length - p)) for p in range(1, q)):
                found.append((k, length, q))
            k = max(stop, k) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng, total = random.Random(5), 0
    for _ in range(1500):
        words, kinds = [], rng.choice([1, 2, 3, 40])
        while len(words) < rng.randint(0, 200):
            block = [b"%d" % rng.randrange(kinds) for _ in range(rng.randint(1, rng.choice([3, 9, 40])))]
            words += block * rng.choice([1, 1, 2, 4, 9])
            if rng.random() < 0.4:
                words = words[: len(words) - rng.randint(0, 4)]
            elif rng.random() < 0.3:
                words += words[rng.randrange(len(words)) :] * rng.randint(1, 3)
        want = runs_by_brute_force(words)
        total += len(want)
        assert periodic.find_runs(words) == want
        assert periodic.runs_of_texts([b"one", b" ".join(words), None]) == [([b"one"], []), (words, want), ([], [])]
    assert total > 1000


def test_long_repetitions_stay_cheap():
    assert periodic.find_runs([b"x"] * 300_000) == [(0, 300_000, 1)]
    blocks = ([b"a"] * 50 + [b"b"]) * 2_000
    assert periodic.find_runs(blocks)[1] == (0, len(blocks), 51) and len(periodic.find_runs(blocks)) == 2_001


def test_period_query_equals_brute_force(spark, folder):
    rng = random.Random(8)
    rows = ROWS + [(100 + k, "s", "en", 0, " ".join(f"w{rng.randrange(9)}" for _ in range(rng.randint(0, 150)))) for k in range(120)]
    want, changed = [], 0
    for doc_id, _, _, _, text in rows:
        words = (text or "").encode().split()
        n = len(words)
        if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
            g = zlib.crc32(str(doc_id).encode()) // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            changed += 1
        runs = runs_by_brute_force(words) if n < 1000 else [(0, n, 2)]
        dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = None
        for s, length, q in runs:
            if best is None or length * best[2] > best[1] * q:
                best = (s, length, q)
        digests = [h("".join(f"{s},{length},{q}\n" for s, length, q in runs)), h(b" ".join(w for i, w in enumerate(words) if i not in dropped).decode())]
        want.append((doc_id, len(runs), *(best or [None] * 3), best and 1000 * best[1] // best[2], *digests))
    assert changed > 5
    assert Counter(map(tuple, queries.op13_periodic_runs(spark, folder(rows)).collect())) == Counter(want)


def test_no_rows_and_other_columns(spark):
    assert periodic.detect_runs(frame(spark, [])).count() == 0
    kept = periodic.detect_runs(frame(spark, ROWS)).select("row.*", "n_words")
    assert kept.columns == [*frame(spark, []).columns, "n_words"] and kept.count() == len(ROWS)
