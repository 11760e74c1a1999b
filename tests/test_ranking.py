"""Top-n and running counts against plain windows, with tiny limits."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from codeset.functions.order import shuffle_key, slice_of
from codeset.operators import ranking
from helpers import rows


@pytest.fixture(scope="module")
def table(spark):
    """One hot group, some small ones, and one without a name."""
    group = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 101 == 0, None)
        .otherwise(F.concat(F.lit("g"), F.col("id") % 200))
    )
    return (
        spark.range(3000, numPartitions=13)
        .withColumn("g", group)
        .withColumn("h", shuffle_key(F.col("id").cast("string")))
    )


def plain(table, n):
    place = F.row_number().over(Window.partitionBy("g").orderBy("h", "id"))
    return rows(table.withColumn("rank", place).where(F.col("rank") <= n))


@pytest.mark.parametrize("n, spread", [(1, 4), (7, 2), (50, 64), (5000, 3)])
def test_first_n(table, n, spread):
    found = ranking.first_n(table, ["g"], ["h", "id"], n, spread=spread)
    assert rows(found) == plain(table, n)


def test_first_n_is_limited_before_the_shuffle(table):
    plan = ranking.first_n(table, ["g"], ["h", "id"], 7)
    text = plan._jdf.queryExecution().executedPlan().toString()
    lines = [l for l in text.splitlines() if "WindowGroupLimit" in l or "Exchange" in l]
    kinds = ["limit" if "WindowGroupLimit" in l else "shuffle" for l in lines]
    assert kinds == ["limit", "shuffle", "limit"] * 2


def test_numbered(table):
    known = table.where("g is not null").withColumn("s", slice_of("h", 1))
    found = ranking.numbered(known, ["g"], ["s"], ["h", "id"])
    whole = Window.partitionBy("g")
    wanted = known.withColumn(
        "position", F.row_number().over(whole.orderBy("h", "id")).cast("bigint")
    ).withColumn("total", F.count(F.lit(1)).over(whole))
    columns = ["id", "position", "total"]
    assert rows(found, *columns) == rows(wanted, *columns)


def test_slice_totals_of_values(spark):
    df = spark.createDataFrame(
        [("a", 1, 5), ("a", 1, 2), ("a", 3, 1), ("b", 2, 4)], "g string, s int, v int"
    )
    found = ranking.slice_totals(df, ["g"], ["s"], F.col("v"))
    assert rows(found) == [("a", 1, 7, 0, 8), ("a", 3, 1, 7, 8), ("b", 2, 4, 0, 4)]


@pytest.mark.parametrize("digits", [1, 4])
@pytest.mark.parametrize("n", [0, 1, 7, 500, 5000])
def test_first_by_hash(table, n, digits):
    """Slices below the cut whole, the slice of the cut sorted."""
    found = ranking.first_by_hash(table, ["g"], "h", ["id"], n, digits)
    assert found.columns == table.columns
    assert rows(found) == [row[:3] for row in plain(table, n)]


def test_first_by_hash_sorts_one_slice(spark, monkeypatch):
    """The window sees the rows of the slice that holds the cut alone."""
    hot = spark.range(20_000).select(F.lit("g").alias("g"), "id", shuffle_key(F.col("id").cast("string")).alias("h"))
    found = ranking.first_by_hash(hot, ["g"], "h", ["id"], 12_345, 2)
    assert found.count() == 12_345
    text = found._jdf.queryExecution().executedPlan().toString()
    window = text[text.index("Window [row_number"):]
    assert "_slice" in window[: window.index("Exchange")] or "_cut" in window
    largest = hot.groupBy(F.substring("h", 1, 2)).count().agg(F.max("count")).first()[0]
    assert largest < 200
