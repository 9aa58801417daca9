import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))



@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ties,
    and extra columns whose names clash with the operators' own."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
    rows = [
        (1, "the cat sat on the mat and looked at the dog", "en", "a"),
        (1, "the cat sat on the mat and looked at the dog", "en", "a"),
        (2, "the cat sat on the mat and looked at the dog", "en", None),
        (3, None, None, None),
        (None, "a text without an id, kept as it is", "en", "b"),
        (None, None, None, "b"),
        (4, "", "de", "b"),
        (5, " \n\t ", "de", "b"),
        (6, "one two", "fr", "c"),
        (7, "ONE two", "fr", "c"),
        (8, long, "en", "a"),
        (9, "é́ 日本語 😀 \x00 </s> <unk> ▁ ﬁ", "es", "c"),
    ]
    extra = [(*r, 7, "x", 0.5, 3, "k") for r in rows]
    return spark.createDataFrame(
        extra, "doc_id long, text string, lang string, source string, size int, key string, score double, shard int, ids string").repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("doc_id = -1")
