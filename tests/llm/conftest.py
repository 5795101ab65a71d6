import datetime

import pytest

LONG = "a long text of many words, é ü 漢字. " * 4000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start int, ids string, kept string, n_lines int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and blank texts, a very long one, equal and repeated rows, columns with clashing names."""
    def row(doc_id, text):
        return (doc_id, text, None, "s", None, 1, "x", "y", 2)

    texts = [None, "", " ", "\n\n", LONG, "one", "one", "two  words", "two\twords", LONG + "!", "<|endoftext|> x"]
    rows = [row(k, t) for k, t in enumerate(texts)] + [row(5, "one"), row(None, "one"), row(None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def given(spark):
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")


AT = datetime.datetime(2024, 1, 1)
