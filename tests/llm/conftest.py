import pytest

EDGE_TEXTS = [
    None, "", " ", "\n", "a", "Hello  world\n\n  x\ty", "it's 1234 they'll!!", "é ß 日本 語　x y\x85z\xa0",
    "\x00 \x00a\x00", " lead", "trail ", "a\n b \nc", "\x1c \x1d!", "a" * 700, "ab" * 3000, "= = ==" * 50,
    "<|endoftext|> x", "\U0001d4b3́ \U0001f600\U0001f600", "same text", "same text",
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Documents with nulls, repeats and columns whose names clash with results."""
    rows = [(i, t, "x", 1, None, 2) for i, t in enumerate(EDGE_TEXTS)]
    rows += [(None, "no id", None, 1, None, 2), (3, "\n", "x", 1, None, 2)]
    schema = "doc_id BIGINT, text STRING, labels STRING, n_words INT, kept BOOLEAN, score INT"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id BIGINT, text STRING, labels STRING")


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
