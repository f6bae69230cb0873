"""The near-copy stage of the pipeline on null and repeated identifiers."""

import corpus_pipeline

TEXTS = {name: " ".join(f"{name}{k}" for k in range(60)) for name in "abcd"}


def test_rows_are_dropped_not_identifiers(spark):
    near = TEXTS["a"].replace("a59", "other")
    rows = [(1, TEXTS["a"]), (2, TEXTS["b"]), (None, near), (None, TEXTS["b"]), (3, TEXTS["c"]), (5, TEXTS["c"]), (5, TEXTS["d"]), (6, ""), (None, None), (7, "d"), (8, near)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = corpus_pipeline.one_of_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    want = [(1, TEXTS["a"]), (2, TEXTS["b"]), (3, TEXTS["c"]), (5, TEXTS["d"]), (6, ""), (None, None), (7, "d")]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(want, key=repr)
