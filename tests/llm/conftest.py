import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def llm(spark):
    from portrait.llm.ship import ship
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def edge(llm):
    """Documents with nulls in every column, empty, white, very long and repeated
    texts, and extra columns whose names the operators use themselves."""
    words = [f"w{i}" for i in range(90)]
    copy = " ".join(words)
    near = " ".join([*words[:88], "other"])
    passage = " ".join(f"passage{i}" for i in range(70))
    rows = [(0, copy, "a"), (1, copy, "a"), (2, near, None), (3, None, "a"), (4, "", "b"), (5, " \n\t ", "b"),
            (6, "one two", "b"), (7, "One  TWO", None), (8, "x" * 1000 + " é ñ " + passage, "c"),
            (9, "start " + passage + " end", "c"), (None, copy, "a"), (10, "same row " * 30, "d"),
            (10, "same row " * 30, "d"), (11, " ".join(f"u{i}" for i in range(30_000)), "e")]
    docs = llm.createDataFrame(rows, "doc_id long, text string, source string")
    return docs.select("doc_id", "text", "source", *[F.lit("clash").alias(c) for c in (
        "key", "block", "runs", "node", "tokens", "host", "line", "words", "kept", "row", "n_words", "part")])


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)
