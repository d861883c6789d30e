import os

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents frame from (doc_id, text) pairs, with columns that clash with operators' own names."""
    def make(pairs):
        rows = [(i, t, "en", "src0", len(t or ""), "x", 1) for i, t in pairs]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, h string, shard int")
    return make


@pytest.fixture(scope="session")
def small():
    return SMALL


AWKWARD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one two three four five six"), (5, "One Two Three Four FIVE six"),
    (6, "Ünïcödé ÄÖ words here and there"), (7, "Ünïcödé äö words here and there"),
    (8, "line a\nline a\nline b"), (9, "x " * 30000), (9, "x " * 30000), (10, "a b a b a b a b"),
    (11, "control <|im_end|> and &lt;| &amp; \\ text"), (None, "no identifier"), (12, "one two three four five six"),
]


@pytest.fixture(scope="session")
def awkward(docs_of):
    return docs_of(AWKWARD)
