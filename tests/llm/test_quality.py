"""The fit of the quality model on rows whose identifiers repeat."""

import random

from tidemark.llm import quality


def test_a_repeated_identifier_does_not_push_out_a_grade(spark):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join(w + "$$" * (k % 2 == 0) for w in rng.choices(words, k=40))) for k in range(40)]
    hot = [(0, " ".join(w + "$$" for w in rng.choices(words, k=40))) for _ in range(60)]
    docs = spark.createDataFrame(rows + hot, "doc_id bigint, text string")
    labels = spark.createDataFrame([*((k, k % 2) for k in range(40)), (1, 1)], "doc_id bigint, quality int")
    model = quality.fit_quality(docs, labels, max_rows=50)
    assert model.grades == [0, 1]
    kept = quality.score_quality(docs, model).select("row.doc_id", "kept").collect()
    assert all(r.kept == (r.doc_id % 2 == 1) for r in kept)
