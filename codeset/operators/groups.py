"""Groups of labels that a classifier confuses with each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeset.operators.evaluation import (
    MIN_CONFUSION,
    labels_of,
    confusion_links,
    mutual_confusions,
)
from codeset.operators.ranking import numbered_in_order
from codeset.session import land


def connected_labels(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(name, root): the smallest name each node is connected to.

    ``edges`` has (a, b) both ways round.  Each round takes the smallest root
    among the neighbours and then the root's own root, so long chains shrink
    by half.  Rounds are written to the shared folder: the plan stays short
    and a lost executor costs one round.  Roots only ever get smaller, so the
    loop ends.
    """
    edges = land(edges.select("a", "b"), "edges")
    roots = nodes.select("name", F.col("name").alias("root"))
    while True:
        neighbours = (
            edges.join(roots.withColumnRenamed("name", "b"), "b")
            .groupBy(F.col("a").alias("name"))
            .agg(F.min("root").alias("_near"))
        )
        nearer = roots.join(neighbours, "name", "left").select(
            "name",
            F.col("root").alias("_old"),
            F.least("root", F.coalesce("_near", "root")).alias("_next"),
        )
        jumps = roots.select(
            F.col("name").alias("_next"), F.col("root").alias("_jump")
        )
        step = nearer.join(jumps, "_next").select(
            "name", "_old", F.least("_next", "_jump").alias("root")
        )
        done = land(step, "roots")
        roots = done.select("name", "root")
        if done.where("_old <> root").isEmpty():
            return roots


def confusion_groups(
    counts: DataFrame, min_share: float = MIN_CONFUSION
) -> DataFrame:
    """(name, group): labels linked by mutual confusion share a group.

    Group 0 takes all labels that stand alone; the others are numbered from 1
    in the order of their smallest label.  The call runs jobs and writes to
    the shared folder; ``counts`` is read several times, so give a stored table.
    """
    labels = labels_of(counts)
    pairs = mutual_confusions(counts, min_share)
    edges = pairs.select(F.col("actual").alias("a"), F.col("predicted").alias("b"))
    roots = connected_labels(edges, labels.select(F.col("label").alias("name")))
    several = (
        roots.groupBy("root").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    )
    numbers = numbered_in_order(several.select("root"), ["root"])
    return roots.join(numbers, "root", "left").select(
        "name", F.coalesce("position", F.lit(0)).cast("int").alias("group")
    )


def confusion_graph(
    counts: DataFrame, min_share: float = MIN_CONFUSION
) -> tuple[DataFrame, DataFrame]:
    """Nodes (name, group) and links (source, target, value)."""
    counts = land(counts, "counts")
    return confusion_groups(counts, min_share), confusion_links(counts)
