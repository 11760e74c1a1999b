"""Small tables with awkward rows, shared by the tests."""

import pytest

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

LONG = "word " * 30_000
AWKWARD = [
    (1, "one two three four five six seven eight nine ten", "en", "a", 48),
    (1, "one two three four five six seven eight nine ten", "en", "a", 48),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, " \t\n \r", "en", "b", 5),
    (5, LONG, "de", "b", len(LONG)),
    (6, LONG, "de", "b", len(LONG)),
    (7, "password=abcdef12 mail ann.lee@mail.example.com é 2024-02-29", "en", "c", None),
    (None, "a row without an id", "fr", "a", 19),
    (-8, "ünïcödé 漢字 🙂 text", "", "", 17),
]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark, awkward):
    """The awkward rows with more columns, named like ones made on the way."""
    from pyspark.sql import functions as F

    names = """_text _row _key _source _tokens _draw _kept _found _gaps _made _words
    _hashes _stratum _slice _class fp size shard slot kept score n_words n_email
    tokens weight topic curve start length component_id quality""".split()
    return awkward.select("*", *(F.lit("x").alias(name) for name in names))


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(1, 1, 0), (2, 0, 0), (3, 0, 1), (5, 1, 0), (7, None, None), (None, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {row["doc_id"]: row["text"] for row in documents.collect()}
