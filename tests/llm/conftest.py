import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, kept string, _row string, size string"

LONG = " ".join(f"word{i % 5000}" for i in range(30_000))
PROSE = " ".join(f"alpha{i} beta{i % 7}" for i in range(60))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows and clashing names."""
    rows = [
        (1, None, None, None, None, None, None, None, None),
        (2, "", "en", "s", 0, "x", "y", "z", "w"),
        (3, " \t\n\x0b ", "en", "s", 5, "x", "y", "z", "w"),
        (4, LONG, "en", "s", 1, "x", "y", "z", "w"),
        (5, PROSE, "en", "s", 1, "x", "y", "z", "w"),
        (6, PROSE, "fr", "s", 1, "x", "y", "z", "w"),
        (6, PROSE, "fr", "s", 1, "x", "y", "z", "w"),
        (7, "one", None, "s", 3, "x", "y", "z", "w"),
        (None, "no id here", "en", None, 3, None, "y", None, "w"),
        (None, None, None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(5, 1, 0), (6, 0, 0), (4, 1, None), (None, 1, 0), (99, 0, 1)], "doc_id long, quality int, toxic int"
    )


@pytest.fixture(scope="session")
def table():
    """Rows of a table of the smallest test data, as dictionaries."""

    def read(spark, name, folder="/root/testdata/sf0.001"):
        return [r.asDict() for r in spark.read.parquet(f"{folder}/{name}.parquet").collect()]

    return read
