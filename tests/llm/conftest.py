from __future__ import annotations

import pytest
from made_up import prose
from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside; a table may have them too.
CLASHING = [
    "start", "n_tokens", "size", "shard", "slot", "score", "node", "hash", "hashes", "bucket",
    "batch", "payload", "head", "context", "place", "doc", "kind", "word", "words", "n", "w",
    "topic", "weight", "probability", "license", "window", "item_id", "key_a", "_text", "_at",
]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or full rows."""

    def make(rows, extra: bool = False):
        full = [r if len(r) == 5 else (*r, "en", "src0", len(r[1] or "")) for r in rows]
        docs = spark.createDataFrame(full, DOCS)
        if extra:
            docs = docs.select("*", *[F.lit("x").alias(c) for c in CLASHING])
        return docs

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, blank, short and very long texts, repeated rows, ties, odd characters."""
    long_text = prose(1, 30_000)
    return [
        (3, prose(3)), (4, prose(3)), (5, None), (6, ""), (7, " \n\t "), (8, "One two"),
        (9, long_text), (10, long_text + " more"), (11, prose(11)), (11, prose(11)), (None, prose(3)),
        (None, None), (12, "é ü\x0b日本 \x85 <|endoftext|> 'tis"), (-5, "A  b\n\n c " * 30),
        (13, "a b c d"), (14, "A B C D"), (15, prose(3).upper()), (2**40, prose(3) + " tail end"),
    ]


@pytest.fixture(scope="session")
def odd_docs(make_docs, odd_rows):
    return make_docs(odd_rows, extra=True)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
