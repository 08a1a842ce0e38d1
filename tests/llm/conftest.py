import pytest

LONG = " ".join(f"word{i % 977} of the text" for i in range(6000))
#: Nulls, empty and long texts, repeated rows and ids, and columns whose names the operators use themselves.
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "Same text in the row\nand a second line of it"), (4, "Same text in the row\nand a second line of it"),
    (4, "another text of the same id is here"), (None, "a text without an id is here"), (None, None), (5, LONG), (6, "x" * 20000),
    (7, "Ünï <|endoftext|> \x1c \x85 Σς 😀\nthe end of it is near"), (8, "a text without an id is here"),
]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="session")
def odd(spark):
    from pyspark.sql import functions as F

    return spark.createDataFrame(ODD, SCHEMA).withColumns({x: F.lit("own") for x in (
        "id", "key", "h1", "score", "removed", "place", "text_hash", "component", "item", "lang", "_bad_id", "digests")})


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def small(spark):
    """The documents of the smallest tables, as a frame and by id."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    return docs, {row.doc_id: row.text for row in docs.collect()}
