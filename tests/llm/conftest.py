import itertools

import pytest

_count = itertools.count()


@pytest.fixture
def stored(spark, tmp_path_factory):
    """Rows to a table on disk, as operators that number rows need, in a few files."""

    def make(rows, schema, files=3):
        path = str(tmp_path_factory.mktemp(f"t{next(_count)}"))
        spark.createDataFrame(rows, schema).repartition(files).write.mode("overwrite").parquet(path)
        return spark.read.schema(schema).parquet(path)

    return make


DOCS = "doc_id long, text string, source string, size int, row string"


@pytest.fixture
def odd_docs():
    """Nulls, empty and very long texts, repeated rows, and columns whose names operators use themselves."""
    long = " ".join(f"w{i % 7919}" for i in range(60_000))
    return [
        (1, None, "a", 1, "x"), (2, "", "a", 1, "x"), (3, "one", None, 1, "x"), (4, long, "b", 1, "x"), (4, long, "b", 1, "x"),
        (None, "no id here", "b", 1, "x"), (None, "no id here", "b", 1, "x"), (7, " \n\t ", None, 1, "x"), (8, "é" * 300, "a", None, None),
        (9, "The idiot said password=abcdefgh1 to the moron", "a", 1, "x"),
    ]
