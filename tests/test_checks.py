from codeset.functions.naming import EMPTY_BLOB
from codeset.operators import checks
from codeset.operators.splits import Quotas
from helpers import rows

FILES = "repository_dirname string, filename string, dedup_key string, usage string"


def test_unique(spark):
    df = spark.createDataFrame(
        [("r", "a", "k", "train"), ("s", "b", "k", "train"), ("s", "c", "l", "test")], FILES
    )
    assert rows(checks.check_unique(df)) == [("k", 2)]
    assert rows(checks.check_one_split(df)) == [("s", 2)]


def test_not_empty(spark):
    df = spark.createDataFrame(
        [("r", "a", EMPTY_BLOB, "train"), ("r", "b", "k", "train")], FILES
    )
    assert rows(checks.check_not_empty(df)) == [("r", "a")]
    contents = spark.createDataFrame(
        [("r", "a", "k", b""), ("r", "b", "k", b"x")],
        "repository_dirname string, filename string, dedup_key string, content binary",
    )
    assert rows(checks.check_not_empty(contents)) == [("r", "a")]


def test_quota_and_suffix(spark, dictionary):
    df = spark.createDataFrame(
        [("C", "train", "x.c", "EXTRACTED"), ("Go", "test", "y.py", "EXTRACTED")],
        "language string, usage string, extract_to string, status string",
    )
    bad = {r[:2]: r[2:] for r in rows(checks.check_quota(df, dictionary, Quotas(1, 0, 0)))}
    assert ("C", "train") not in bad
    assert bad["Go", "train"] == (0, 1) and bad["Go", "test"] == (1, 0)
    assert rows(checks.check_suffix(df, dictionary)) == [("Go", "y.py")]
