"""What the code of the training-data operators does without."""

import re
from pathlib import Path

import corpus_pipeline


def test_no_local_checkpoints_cross_joins_or_pandas():
    root = Path(corpus_pipeline.__file__).parent
    for path in [*(root / "tidemark/llm").rglob("*.py"), root / "corpus_pipeline.py"]:
        assert not re.search(r"localCheckpoint|crossJoin|\.rdd\b|toPandas", path.read_text()), path
