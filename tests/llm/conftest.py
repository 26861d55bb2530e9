import pytest
from pyspark.sql import functions as F

# Columns beside id and text that carry names the operators use themselves.
CLASHING = ["__at", "__doc", "__k1", "__spans", "__copy", "row", "parts", "key", "first", "spans", "k1", "score", "label", "n", "start", "length", "root", "node", "bucket", "words"]
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
PROSE = "A plain text of some words about nothing, long enough to count as text. It goes on for a while."
EDGES = [
    (1, PROSE), (2, PROSE), (3, None), (4, ""), (5, " \n\t "), (6, LONG), (6, LONG), (None, PROSE + " Without an id."),
    (7, "one"), (8, "日本語のテキスト。" * 12), (9, "né " * 40), (10, "the same line\n" * 5), (None, None),
]


@pytest.fixture
def edges(spark):
    """Nulls, empty and very long texts, copies, repeated rows and clashing columns."""
    rows = spark.createDataFrame(EDGES, "doc_id bigint, text string")
    return rows.select("doc_id", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)], "text")


@pytest.fixture
def nothing(edges):
    return edges.limit(0)
