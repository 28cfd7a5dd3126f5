"""Fixtures of small tables with the awkward rows every operator must bear."""

import pytest
from pyspark.sql import Row

TEXTS = [None, "", " \n\t ", "one", "a b c d", "a b c d", "x" * 5000, "word " * 3000, "Ünïcode täxt — …   end", "<b> \\ & </turn>"]


@pytest.fixture
def awkward(spark):
    """Null ids and texts, ties, repeated rows, long texts, and columns whose names clash with internal ones."""
    rows = [
        Row(doc_id=None if i == 3 else i // 2, text=t, lang="en", source=None if i % 4 == 0 else f"s{i % 2}", n_chars=len(t or ""), row=i, node=1,
            key="k", id=7, token=2, score=0.5, n=1, label="x", size=3, block=0, file=1)
        for i, t in enumerate(TEXTS)
    ]
    shape = (
        "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, node int, key string, id int, token int, "
        "score double, n int, label string, size int, block int, file int"
    )
    return spark.createDataFrame(rows, shape)


@pytest.fixture
def empty(awkward):
    return awkward.filter("false")
