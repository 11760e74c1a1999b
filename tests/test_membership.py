"""Bitmaps of keys: every key passes, few others do, whatever the number of keys."""

import pytest
from pyspark.sql import functions as F

from codeset.operators import membership
from codeset.session import land


def passed(df):
    return {row[0] for row in df.where("_member").select("k").collect()}


@pytest.mark.parametrize("n", [0, 1, 100, 20_000])
def test_all_keys_and_few_others_pass(spark, n):
    keys = land(spark.range(n).select(F.concat(F.lit("key "), "id").alias("k")), "keys")
    rows = spark.range(60_000).select(F.concat(F.lit("key "), "id").alias("k"))
    found = passed(membership.with_membership(rows, ["k"], keys))
    wanted = {f"key {i}" for i in range(n)}
    assert wanted <= found
    assert len(found - wanted) <= 0.04 * (60_000 - n)


def test_more_keys_than_the_bitmaps_hold(spark, monkeypatch):
    """The bitmaps stay as small; more other rows pass, and no key is lost."""
    monkeypatch.setattr(membership, "MAX_BITMAPS", 1)
    keys = land(spark.range(30_000).withColumnRenamed("id", "k"), "keys")
    made, buckets = membership.bitmaps(keys, ["k"])
    assert buckets == 1 and made.count() == 1
    found = passed(membership.with_membership(spark.range(40_000).withColumnRenamed("id", "k"), ["k"], keys))
    assert set(range(30_000)) <= found


def test_rows_are_neither_lost_nor_repeated(spark):
    keys = land(spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "k string, n int"), "keys")
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 2), (None, None)], "k string, n int")
    found = membership.with_membership(rows, ["k", "n"], keys)
    assert found.columns == ["k", "n", "_member"] and found.count() == rows.count()
    assert all(row["_member"] for row in found.where("k = 'a'").collect())
    other = membership.with_membership(rows, [F.upper("k")], keys, [F.upper("k")], "known")
    assert {row["k"]: row["known"] for row in other.where("k is not null").collect()} == {"a": True, "b": False}
