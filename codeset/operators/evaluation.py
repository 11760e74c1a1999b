"""Model scores, prediction reports and confusion tables."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codeset.dictionary import Dictionary
from codeset.functions.naming import suffix
from codeset.operators.ranking import numbered_in_order

# The results depend on exactly these.
MIN_CONFUSION = 0.02
EPSILON = 1e-16
REPORT_TYPE = "map<string,map<string,bigint>>"

# A scorer takes texts and returns one {class: probability} per text.
Scorer = Callable[[list[str]], list[dict[str, float]]]


def label_by_extension(
    files: DataFrame, dictionary: Dictionary, name: str = "name"
) -> DataFrame:
    """Add ``label`` from the file's suffix, case counts; others are left out."""
    labels = dictionary.languages_df(files.sparkSession).select(
        F.col("language").alias("label"), F.col("primary_ext").alias("_ext")
    )
    labels = dictionary.small(labels)
    return files.join(labels, suffix(name) == F.col("_ext")).drop("_ext")


def score_files(
    files: DataFrame, scorer_factory: Callable[[], Scorer], key: str = "name"
) -> DataFrame:
    """Score ``text`` with a model: (key, label, probs map).

    The factory loads the model once per task; texts go through in batches.
    """

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = scorer_factory()
        for batch in batches:
            yield pd.DataFrame(
                {
                    key: batch[key],
                    "label": batch["label"],
                    "probs": scorer(batch["text"].tolist()),
                }
            )

    rows = files.select(key, "label", "text")
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInPandas(
        score, f"`{key}` {kind}, label string, probs map<string,double>"
    )


def long_probabilities(scores: DataFrame, *keep: str) -> DataFrame:
    """One row per (file, class): label, class, prob."""
    return scores.select(*keep, "label", F.explode("probs").alias("class", "prob"))


def wide_report(
    probs: DataFrame, classes: Sequence[str], key: Sequence[str] = ("name",)
) -> DataFrame:
    """One row per file: ``_label_`` and one probability column per class.

    One maximum per class takes a single shuffle; a pivot takes two.
    """
    return probs.groupBy(*key, F.col("label").alias("_label_")).agg(
        *[
            F.max(F.when(F.col("class") == c, F.col("prob"))).alias(c)
            for c in classes
        ]
    )


def unpivot_report(report: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Back from a wide report to label, class, prob."""
    return report.unpivot(
        [F.col("_label_").alias("label")],
        [F.col(f"`{c}`") for c in classes],
        "class",
        "prob",
    )


def label_index(labels: DataFrame) -> DataFrame:
    """(label, index) with labels numbered from 0 in name order."""
    distinct = labels.select("label").distinct()
    return numbered_in_order(distinct, ["label"]).select(
        (F.col("position") - 1).cast("int").alias("index"), "label"
    )


def labels_of(counts: DataFrame) -> DataFrame:
    """Distinct names among the actual and predicted labels."""
    both = F.explode(F.array("actual", "predicted")).alias("label")
    return counts.select(both).distinct()


def confusion_counts(predictions: DataFrame) -> DataFrame:
    """How often each label was predicted as each label, where it ever was."""
    return predictions.groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("n"))


def confusion_shares(counts: DataFrame) -> DataFrame:
    """Add ``value``: the cell's share of its row."""
    row = F.sum("n").over(Window.partitionBy("actual"))
    guarded = F.coalesce(F.nullif(row.cast("double"), F.lit(0.0)), F.lit(EPSILON))
    return counts.withColumn("value", F.col("n") / guarded)


def confusion_links(counts: DataFrame) -> DataFrame:
    """Links of the confusion graph: source and target index, share."""
    index = label_index(labels_of(counts))
    source = index.select(F.col("label").alias("actual"), F.col("index").alias("source"))
    target = index.select(F.col("label").alias("predicted"), F.col("index").alias("target"))
    return (
        confusion_shares(counts)
        .join(source, "actual")
        .join(target, "predicted")
        .select("source", "target", "value")
    )


def mutual_confusions(counts: DataFrame, min_share: float = MIN_CONFUSION) -> DataFrame:
    """Pairs of labels, both ways round, that are each taken for the other."""
    strong = confusion_shares(counts).where(F.col("value") > min_share)
    there = strong.select("actual", "predicted")
    back = strong.select(
        F.col("predicted").alias("actual"), F.col("actual").alias("predicted")
    )
    return there.join(back, ["actual", "predicted"], "left_semi")


def confusion_matrix(counts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """One row per actual label, one column per predicted label, zeros included."""
    cells = counts.groupBy("actual").pivot("predicted", list(labels)).agg(F.sum("n"))
    return cells.na.fill(0)


def matrix_cells(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """Non-zero cells with opacity, tooltip and whether both ends share a group."""
    row = groups.select(F.col("name").alias("actual"), F.col("group").alias("_row"))
    column = groups.select(F.col("name").alias("predicted"), F.col("group").alias("_column"))
    tenfold = F.least(F.greatest(F.col("value") * 10, F.lit(0.0)), F.lit(4.0))
    return (
        confusion_shares(counts)
        .where("value <> 0")
        .join(row, "actual")
        .join(column, "predicted")
        .select(
            "actual",
            "predicted",
            (tenfold / 4).alias("opacity"),
            F.format_string("%.2f%%", F.col("value") * 100).alias("tooltip"),
            (F.col("_row") == F.col("_column")).alias("same_group"),
        )
    )


def matrix_orders(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """Positions of the labels by name, by row total and by group.

    Totals and groups go down; equal ones are in name order.
    """
    totals = counts.groupBy(F.col("actual").alias("name")).agg(F.sum("n").alias("_n"))
    nodes = groups.join(totals, "name", "left").select(
        "name", (-F.coalesce("_n", F.lit(0))).alias("_count"), (-F.col("group")).alias("_group")
    )

    def places(column: str, *order: str) -> DataFrame:
        numbers = numbered_in_order(nodes, [*order, "name"])
        return numbers.select("name", F.col("position").cast("int").alias(column))

    return (
        places("by_name")
        .join(places("by_count", "_count"), "name")
        .join(places("by_group", "_group"), "name")
    )


def read_report(reports: DataFrame, column: str = "value") -> DataFrame:
    """Cells of JSON reports ``{actual: {predicted: n}}``."""
    parsed = F.from_json(column, REPORT_TYPE)
    return (
        reports.select(F.explode(parsed).alias("actual", "_row"))
        .select("actual", F.explode("_row").alias("predicted", "n"))
    )


def report_json(counts: DataFrame) -> DataFrame:
    """One row of JSON ``{actual: {predicted: n}}`` per actual label."""
    cells = F.array_sort(F.collect_list(F.struct("predicted", "n")))
    return counts.groupBy("actual").agg(cells.alias("_cells")).select(
        F.to_json(F.create_map("actual", F.map_from_entries("_cells"))).alias("value")
    )


# Tasks get these functions by value, so workers need not install the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
