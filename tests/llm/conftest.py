from __future__ import annotations

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCUMENTS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()),
    StructField("lang", StringType()), StructField("source", StringType()),
    StructField("n_chars", LongType()),
    # Names that the operators use themselves.
    *[StructField(name, StringType()) for name in (
        "key", "__key", "score", "quality", "size", "copies", "label", "block", "shard", "rank")],
])


def make_docs(spark, rows):
    """Rows of (doc_id, text, source) as documents with columns of clashing names."""
    return spark.createDataFrame(
        [(i, t, "en", s, None if t is None else len(t), *["own"] * 10) for i, t, s in rows],
        DOCUMENTS)


LONG = " ".join(f"word{k % 977}x{k % 13}" for k in range(30_000))
ODD_ROWS = [
    (1, "one two three four five six seven eight nine ten eleven", "a"),
    (1, "one two three four five six seven eight nine ten eleven", "a"),   # a repeated row
    (2, "one two three four five six seven eight nine ten eleven", "b"),   # a copy
    (None, "no id at all but some words here", "a"),
    (3, None, "a"), (4, "", "b"), (5, " \t\n\x0b\r ", None), (None, None, None),
    (6, "x" * 30_000, "a"),                                               # one endless word
    (7, LONG, "b"), (8, "same same " * 500, None), (9, "Ünïcödé 日本語 🙂\nzweite Zeile", "c"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return make_docs(spark, ODD_ROWS).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return make_docs(spark, [])


@pytest.fixture(scope="session")
def small(spark):
    from pathlib import Path

    folder = "/root/testdata/sf0.01"
    if not Path(folder).is_dir():
        pytest.skip("no test tables")
    return folder
