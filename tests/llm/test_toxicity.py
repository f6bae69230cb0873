"""The nearest labelled examples over all words of the texts, against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from tidemark.llm import toxicity

SCHEMA = "doc_id bigint, text string"
WORDS = [f"w{k}" for k in range(400)]


def frames(spark, rows):
    return spark.createDataFrame([(i, t) for i, t, _ in rows], SCHEMA), spark.createDataFrame([(i, y) for i, _, y in rows if y is not None], "doc_id bigint, toxic int")


def scored(spark, rows):
    docs, labels = frames(spark, rows)
    return {r.row.doc_id: r for r in toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels)).collect()}


def corpus(size, share, seed):
    rng = random.Random(seed)
    return [(k, " ".join(rng.choices(WORDS, k=rng.randint(20, 60)) + rng.choices(["vile", "nasty", "awful"], k=8) * (k % share == 0)), int(k % share == 0)) for k in range(size)]


def brute_force(rows):
    """Cosines of every text with every example, from the definition."""
    def features(text):
        return Counter(re.findall(r"[a-z0-9]+", text.lower()))

    train = [(i, features(t), y) for i, t, y in rows if y is not None and zlib.crc32(str(i).encode()) % 4 != 2]
    n1 = sum(y for _, _, y in train)
    n0 = len(train) - n1
    ones, zeros = Counter(f for _, c, y in train for f in c if y), Counter(f for _, c, y in train for f in c if not y)

    def weight(f):
        a, b = ones[f], zeros[f]
        share = (a + b) / len(train)
        part = lambda seen, of, s: seen * math.log(seen / (of * s)) if seen else 0.0
        ratio = 2 * (part(a, n1, share) + part(b, n0, share) + part(n1 - a, n1, 1 - share) + part(n0 - b, n0, 1 - share))
        says = ratio**2 / (ratio**2 + toxicity.HALF_RATIO**2) if a * n0 > b * n1 else 0.0
        return (math.log((len(train) + 1) / (a + b + 1)) + 1) * (toxicity.BASE + says)

    known = {}

    def unit(counts):
        values = {f: (1 + math.log(c)) * known.setdefault(f, weight(f)) for f, c in counts.items()}
        size = math.sqrt(sum(v * v for v in values.values()))
        return {f: v / size for f, v in values.items()}

    examples = [(i, unit(c)) for i, c, _ in train]
    return {i: {j: sum(v * e.get(f, 0.0) for f, v in own.items()) for j, e in examples} for i, own in ((i, unit(features(t))) for i, t, _ in rows)}


def test_neighbours_equal_brute_force(spark):
    rows = corpus(120, 6, 1) + [(1000 + k, t.replace("w1", "zz"), None) for k, (_, t, _) in enumerate(corpus(40, 3, 2))]
    got, want = scored(spark, rows), brute_force(rows)
    assert set(got) == set(want)
    for key, cosines in want.items():
        best = sorted(cosines.values(), reverse=True)[:5]
        assert np.allclose([cosines[j] for j in got[key].evidence], best, atol=1e-9)


def test_few_labelled_texts_are_enough(spark):
    """Four toxic examples: no count is a floor that all terms have to reach."""
    rows = [(i, t, y) for i, t, y in corpus(60, 12, 3) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert 0 < sum(y for _, _, y in rows) < 5
    new = [(1000 + k, t, None) for k, (_, t, _) in enumerate(corpus(24, 2, 4))]
    got = scored(spark, rows + new)
    toxic, clean = ([got[1000 + k].score for k in range(24) if k % 2 == odd] for odd in (0, 1))
    assert min(toxic) > max(clean)
    assert all(got[i].evidence for i, _, _ in rows + new)


def test_the_rest_of_the_text_counts(spark):
    """One such word in a clean text of 20,000 words is not an insult of one word, and twice is not once."""
    rng = random.Random(5)
    long = " ".join([*rng.choices(WORDS, k=20_000), "vile"])
    short = " ".join(WORDS[:30])
    got = scored(spark, corpus(240, 6, 6) + [(1000, long, None), (1001, "vile", None), (1002, short + " vile", None), (1003, short + " vile" * 3, None)])
    assert got[1000].score < 0.3 < got[1001].score
    docs, labels = frames(spark, corpus(240, 6, 6))
    model = toxicity.fit_toxicity(docs, labels)
    known = toxicity.FeatureIds()
    once, thrice = (dict(zip(*(x.tolist() for x in model.vector(*known.of(short + " vile" * k))))) for k in (1, 3))
    place = int(np.searchsorted(model.terms, known.of("vile")[0][0]))
    other = int(np.searchsorted(model.terms, known.of("w7")[0][0]))
    assert np.isclose(thrice[place] / thrice[other], (1 + math.log(3)) * once[place] / once[other])
    neutral = toxicity.score_toxicity(*[spark.createDataFrame([(1, short)], SCHEMA), model]).first()
    assert len(neutral.evidence) == 5
