"""Ranks and running counts inside groups of any size.

A plain window sorts each group in one task.  Here a group may hold a third
of the table, so its work is spread over several tasks first.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codeset.session import land

# Tasks a hot group is spread over before its final top-n.
SPREAD = 64
HASH_DIGITS = 4  # hex digits of a hash that name a slice
_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def limit_before_shuffle(spark: SparkSession, n: int) -> None:
    """Let a top-n of ``n`` rows run before its shuffle; Spark does so up to a limit."""
    if int(spark.conf.get(_LIMIT)) < n:
        spark.conf.set(_LIMIT, str(n))


def first_n(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    n: int,
    rank: str = "rank",
    spread: int = SPREAD,
) -> DataFrame:
    """The first ``n`` rows of each group, numbered from 1 in ``rank``.

    The first pass keeps the first ``n`` rows of each (group, share), where
    the share is a hash of the order: the limit runs before the shuffle, and
    a hot group is split over ``spread`` tasks.  The second pass sees at most
    ``spread * n`` rows per group.  The windows run over the group as one
    struct, so that an input partitioned by its columns, as after a join, does
    not pass for one that is spread already.
    """
    limit_before_shuffle(df.sparkSession, n)
    share = Window.partitionBy("_group", "_share").orderBy(*order)
    whole = Window.partitionBy("_group").orderBy(*order)
    return (
        df.withColumn("_group", F.struct(*group))
        .withColumn("_share", F.pmod(F.xxhash64(*order), F.lit(spread)))
        .withColumn("_place", F.row_number().over(share))
        .where(F.col("_place") <= n)
        .drop("_share", "_place")
        .withColumn(rank, F.row_number().over(whole))
        .where(F.col(rank) <= n)
        .drop("_group")
    )


def slice_totals(
    df: DataFrame,
    group: Sequence[str],
    slices: Sequence[str],
    value: Column | None = None,
) -> DataFrame:
    """Counts per (group, slice) with the running sums before each slice.

    Adds ``in_slice``, ``before`` (sum over the earlier slices of the group)
    and ``total`` (sum over the group).  Rows are summed before the shuffle;
    the windows run over one row per slice.
    """
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy(*slices).rowsBetween(Window.unboundedPreceding, -1)
    amount = F.count(F.lit(1)) if value is None else F.sum(value)
    return (
        df.groupBy(*group, *slices)
        .agg(amount.alias("in_slice"))
        .withColumn("before", F.coalesce(F.sum("in_slice").over(earlier), F.lit(0)))
        .withColumn("total", F.sum("in_slice").over(whole))
    )


def first_by_hash(
    df: DataFrame, group: Sequence[str], hash_: str, order: Sequence[str | Column], n: int,
    digits: int = HASH_DIGITS,
) -> DataFrame:
    """The first ``n`` rows of each group by a hex hash, then ``order``, for any n.

    Counts per slice of the hash, landed, find the slice in which the n-th row
    lies.  Slices below it are taken whole, and only the rows of that slice
    are sorted: one of 16 ** ``digits`` parts of a group, whatever n is.  The
    rows are scanned twice: give a stored table or a short plan.
    """
    sliced = df.withColumn("_slice", F.substring(hash_, 1, digits))
    totals = slice_totals(sliced, group, ["_slice"])
    cuts = totals.where((F.col("before") <= n) & (F.col("before") + F.col("in_slice") > n)).select(
        *(F.col(c).alias(f"_{c}") for c in group), F.col("_slice").alias("_cut"), (n - F.col("before")).alias("_nth")
    )
    cuts = land(cuts, "hash_cuts")  # one row per group at most
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group))
    placed = sliced.join(cuts, same, "left").drop(*(f"_{c}" for c in group))
    below = placed.where("_cut is null or _slice < _cut").select(df.columns)
    inside = Window.partitionBy(*group).orderBy(hash_, *order)
    at_cut = (
        placed.where("_slice = _cut").withColumn("_place", F.row_number().over(inside))
        .where("_place <= _nth").select(df.columns)
    )
    return below.unionByName(at_cut)


def numbered(
    df: DataFrame,
    group: Sequence[str],
    slices: Sequence[str],
    order: Sequence[str | Column],
    position: str = "position",
) -> DataFrame:
    """Number all rows of each group from 1, with the group's ``total``.

    ``slices`` cuts a group into consecutive pieces of ``order``; each piece
    is sorted alone and shifted by the size of the earlier ones.
    """
    piece = Window.partitionBy(*group, *slices).orderBy(*order)
    totals = slice_totals(df, group, slices)
    return (
        df.withColumn("_place", F.row_number().over(piece))
        .join(totals, [*group, *slices])
        .withColumn(position, F.col("before") + F.col("_place"))
        .drop("_place", "in_slice", "before")
    )


def numbered_in_order(
    df: DataFrame, order: Sequence[str | Column], position: str = "position"
) -> DataFrame:
    """Number all rows from 1 by ``order``, with their ``total``.

    Rows are dealt to ranges of the order and landed; each range is sorted
    alone and shifted by the size of the earlier ones.
    """
    ranges = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    return numbered(land(ranges, "ranges"), [], ["_range"], order, position).drop("_range")
