"""Exact quantiles of probabilities inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeset.operators.ranking import slice_totals
from codeset.session import broadcast_if_small, land

SMALLEST = 5e-324  # the smallest positive double
SLICES_PER_DOUBLING = 128  # of the distance; at most 150,000 slices in all
WHISKER_REACH = 1.5  # box-plot whiskers reach this many quartile ranges


def probability_slice(prob: str | Column) -> Column:
    """Slice number that never falls as the probability grows.

    Classifier scores crowd near 0 and 1, so slices are even in the logarithm
    of the distance to the nearer end.  Values outside [0, 1] join the ends.
    """
    prob = F.col(prob) if isinstance(prob, str) else prob
    low = F.log2(F.greatest(prob, F.lit(SMALLEST)))
    high = -F.log2(F.greatest(1 - prob, F.lit(SMALLEST)))
    place = F.when(prob < 0.5, low).otherwise(high)
    return F.floor(place * SLICES_PER_DOUBLING).cast("int")


def value_counts(
    probs: DataFrame, group: Sequence[str], value: str = "prob"
) -> DataFrame:
    """Equal values counted, landed.

    The table is read once, and rows are combined before the shuffle as far as
    values repeat.
    """
    counts = (
        probs.where(F.col(value).isNotNull() & ~F.isnan(value))
        .groupBy(*group, F.col(value).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("_slice", probability_slice("value"))
    )
    return land(counts, "value_counts")


def quantiles(
    counts: DataFrame, group: Sequence[str], probabilities: Sequence[float]
) -> DataFrame:
    """Interpolated quantiles: one array column ``quantiles`` per group.

    Sums per slice tell which slices hold the wanted positions; only these
    slices' values are sorted.  The few wanted slices are landed, so the call
    runs jobs, and the values are not shuffled to find them.
    """
    group = list(group)
    each = F.explode(
        F.array(
            *[
                F.struct(F.lit(i).alias("i"), F.lit(float(q)).alias("q"))
                for i, q in enumerate(probabilities)
            ]
        )
    )
    totals = slice_totals(counts, group, ["_slice"], F.col("n"))
    at = (F.col("total") - 1) * F.col("_w.q")
    # 0-based positions below and above each quantile, in the slice they are in
    positions = (
        totals.withColumn("_w", each)
        .withColumn("_at", at)
        .withColumn("_side", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumn(
            "_pos",
            F.when(F.col("_side") == 0, F.floor("_at")).otherwise(F.ceil("_at")),
        )
        .where("before <= _pos and _pos < before + in_slice")
        .select(
            *group,
            "_slice",
            F.col("_w.i").alias("_i"),
            "_side",
            (F.col("_at") - F.floor("_at")).alias("_part"),
            (F.col("_pos") - F.col("before")).alias("_pos"),
        )
    )
    # at most two positions per wanted quantile
    wanted = positions.groupBy(*group, "_slice").agg(
        F.collect_list(F.struct("_i", "_side", "_part", "_pos")).alias("_wanted")
    )
    inside = Window.partitionBy(*group, "_slice").orderBy("value")
    upto = F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    wanted = broadcast_if_small(land(wanted, "wanted"))
    found = (
        counts.join(wanted, [*group, "_slice"])
        .withColumn("_upto", upto)
        .withColumn("_w", F.explode("_wanted"))
        .where("_upto - n <= _w._pos and _w._pos < _upto")
        .select(*group, "value", "_w.*")
    )
    ends = found.groupBy(*group, "_i").agg(
        F.max("_part").alias("_part"),
        F.max(F.when(F.col("_side") == 0, F.col("value"))).alias("_low"),
        F.max(F.when(F.col("_side") == 1, F.col("value"))).alias("_high"),
    )
    estimate = F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")
    return ends.groupBy(*group).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_i", estimate.alias("value")))),
            lambda item: item["value"],
        ).alias("quantiles")
    )


def label_medians(probs: DataFrame) -> DataFrame:
    """Median probability of each class within each label, highest first."""
    group = ["label", "class"]
    medians = quantiles(value_counts(probs, group), group, [0.5])
    return medians.select(
        *group, F.col("quantiles")[0].alias("median")
    ).orderBy("label", F.desc("median"), "class")


def box_stats(probs: DataFrame) -> DataFrame:
    """Box-plot numbers of each (label, class) without outliers.

    Whiskers are the furthest values within 1.5 quartile ranges of the box,
    never inside it.
    """
    group = ["label", "class"]
    counts = value_counts(probs, group)
    boxes = quantiles(counts, group, [0.25, 0.5, 0.75]).select(
        *group,
        F.col("quantiles")[0].alias("q1"),
        F.col("quantiles")[1].alias("median"),
        F.col("quantiles")[2].alias("q3"),
    )
    boxes = broadcast_if_small(land(boxes, "boxes"))
    reach = (F.col("q3") - F.col("q1")) * WHISKER_REACH
    return (
        counts.join(boxes, group)
        .where(F.col("value").between(F.col("q1") - reach, F.col("q3") + reach))
        .groupBy(*group)
        .agg(
            *[F.max(c).alias(c) for c in ("q1", "median", "q3")],
            F.min("value").alias("_low"),
            F.max("value").alias("_high"),
        )
        .withColumn("whisker_low", F.least("_low", "q1"))
        .withColumn("whisker_high", F.greatest("_high", "q3"))
        .drop("_low", "_high")
    )
