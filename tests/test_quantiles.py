"""Quantiles by exact histograms and by sketches."""

import random

import pytest

from tidemark.operators import quantiles


def exact(rows, shares):
    found = []
    for key in {k for k, _ in rows}:
        values = sorted(v for k, v in rows if k == key and v is not None)
        found += [(key, s, values[(len(values) * s + 999) // 1000 - 1]) for s in shares if values]
    return sorted(found, key=repr)


@pytest.mark.parametrize("bins", [2, 7, 1024])
def test_exact_quantiles(spark, records, monkeypatch, bins):
    monkeypatch.setattr(quantiles, "BINS", bins)
    rng = random.Random(bins)
    # A key with most of the rows, a null key, one value only, nulls only, negative values, ties.
    rows = [(rng.choice(["hot", "hot", "hot", None, "b"]), rng.choice([None, rng.randrange(-300, 300) / 100, 1.0])) for _ in range(400)]
    rows += [("one", 2.5), ("none", None), ("far", -1e6), ("far", 1e6)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(3)
    shares = [1, 250, 500, 501, 999, 1000]
    assert records(quantiles.key_quantiles(df, ["k"], "v", shares, 2)) == exact(rows, shares)


def test_whole_range_of_numbers(spark, records):
    low, high = -(2**62), 2**62
    df = spark.createDataFrame([(1, float(low)), (1, 0.0), (1, float(high))], "k int, v double")
    assert records(quantiles.key_quantiles(df, ["k"], "v", [1, 500, 1000], 0)) == sorted([(1, 1, float(low)), (1, 500, 0.0), (1, 1000, float(high))], key=repr)
    assert quantiles.key_quantiles(df.limit(0), ["k"], "v", [500], 2).count() == 0
    with pytest.raises(ValueError):
        quantiles.key_quantiles(df, ["k"], "v", [0], 2)


def test_merged_sketches_are_within_their_bound(spark):
    df = spark.range(60_000, numPartitions=6).selectExpr("if(id % 3 = 0, 'a', 'hot') as k", "cast((id * 7919) % 60000 as double) as v", "id")
    parts = [quantiles.key_sketches(df.where(f"id % 5 {op} 0"), ["k"], "v") for op in ("=", "<>")]
    merged = quantiles.merge_sketches(*parts, ["k"])
    found = quantiles.sketch_quantiles(merged, ["k"], [0.01, 0.25, 0.5, 0.99]).collect()
    values = {}
    for k, v in df.select("k", "v").collect():
        values.setdefault(k, []).append(v)
    assert {(r.k, r.n) for r in found} == {(k, len(v)) for k, v in values.items()} and len(found) == 8
    for r in found:
        rank = sum(v <= r.quantile for v in values[r.k]) / r.n
        assert abs(rank - r.share) < quantiles.rank_error()
    assert len(merged.first().sketch) < 20_000
