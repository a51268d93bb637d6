"""Small frames with what the corpus operators must survive."""

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "lorem ipsum dolor sit amet " * 20_000


@pytest.fixture
def docs(spark):
    def make(pairs):
        rows = [(i, t, "en", "s", len(t) if t is not None else None) for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture
def odd(docs):
    """NULLs, empty and very long texts, ties, repeated rows and ids, odd characters."""
    return docs(
        [
            (1, None),
            (2, ""),
            (3, LONG),
            (4, "same words here and there again"),
            (5, "same words here and there again"),
            (6, "same words here and there again"),
            (6, "same words here and there again"),
            (None, "a row without an id"),
            (7, "\x00 \x1f 　 <|endoftext|> ÀÉ ß 𝒳 \r\n"),
            (8, " \t\n "),
        ]
    )


@pytest.fixture
def clashing(odd):
    """The same with columns named like those that the operators add."""
    from pyspark.sql import functions as F

    names = "key label hash row at n size bucket slot shard node component_id kept base learned p_toxic n_tokens ids todo hashes ready spans"
    return odd.withColumns({c: F.lit("x") for c in names.split()})
