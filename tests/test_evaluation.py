import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from codeset.operators import evaluation as ev
from codeset.operators import groups, quantiles
from codeset.session import land
from codeset.sources import readers, writers
from helpers import rows

COUNTS = "actual string, predicted string, n bigint"


def counts(spark, cells):
    return spark.createDataFrame([(a, p, n) for (a, p), n in cells.items()], COUNTS)


def matrix(spark, labels, off_diagonal, diagonal=100):
    """Counts on the full grid with the given cells off the diagonal."""
    cells = {
        (a, p): off_diagonal.get((a, p), diagonal if a == p else 0)
        for a in labels
        for p in labels
    }
    return counts(spark, cells)


def test_counts_have_what_occurs(spark):
    df = spark.createDataFrame(
        [("a", "a"), ("a", "b"), ("a", "b"), ("c", "c")], "actual string, predicted string"
    )
    assert rows(ev.confusion_counts(df)) == [("a", "a", 1), ("a", "b", 2), ("c", "c", 1)]
    found = rows(ev.confusion_matrix(ev.confusion_counts(df), ["a", "b", "c"]))
    assert found == [("a", 1, 2, 0), ("c", 0, 0, 1)]


def test_many_labels(spark):
    """Three thousand labels, chained in tens."""
    df = spark.range(3000).select(
        F.format_string("n%04d", "id").alias("actual"),
        F.explode(
            F.array(F.col("id"), F.when(F.col("id") % 10 < 9, F.col("id") + 1),
                    F.when(F.col("id") % 10 > 0, F.col("id") - 1))
        ).alias("to"),
    ).where("to is not null").select("actual", F.format_string("n%04d", "to").alias("predicted"))
    table = land(ev.confusion_counts(df), "counts")
    found = dict(rows(groups.confusion_groups(table)))
    assert found == {f"n{i:04}": i // 10 + 1 for i in range(3000)}
    index = dict(rows(ev.label_index(ev.labels_of(table)), "label", "index"))
    assert index == {f"n{i:04}": i for i in range(3000)}
    orders = ev.matrix_orders(table, spark.createDataFrame(list(found.items()), "name string, group int"))
    assert orders.where("name = 'n0009'").first()["by_name"] == 10


def test_shares_of_an_empty_row(spark):
    df = counts(spark, {("a", "a"): 3, ("a", "b"): 1, ("b", "a"): 0, ("b", "b"): 0})
    found = {r[:2]: r[3] for r in rows(ev.confusion_shares(df))}
    assert found == {("a", "a"): 0.75, ("a", "b"): 0.25, ("b", "a"): 0, ("b", "b"): 0}
    assert rows(ev.confusion_links(df)) == [
        (0, 0, 0.75), (0, 1, 0.25), (1, 0, 0.0), (1, 1, 0.0),
    ]


def test_share_must_exceed_the_threshold(spark):
    df = matrix(spark, "ab", {("a", "b"): 2, ("a", "a"): 98, ("b", "b"): 97, ("b", "a"): 3})
    assert ("a", "b") not in rows(ev.mutual_confusions(df))
    assert dict(rows(groups.confusion_groups(df))) == {"a": 0, "b": 0}


def test_one_sided_confusion_is_no_group(spark):
    df = matrix(spark, "ab", {("a", "b"): 50})
    assert dict(rows(groups.confusion_groups(df))) == {"a": 0, "b": 0}


def test_label_without_itself(spark):
    df = matrix(spark, "abc", {("a", "a"): 0, ("a", "b"): 9})
    assert dict(rows(groups.confusion_groups(df))) == {"a": 0, "b": 0, "c": 0}


def test_path_is_one_group(spark):
    pairs = [("a", "c"), ("c", "d"), ("d", "b"), ("x", "y")]
    cells = {p: 20 for p in pairs} | {(b, a): 20 for a, b in pairs}
    df = matrix(spark, "abcdxyz", cells)
    assert dict(rows(groups.confusion_groups(df))) == {
        "a": 1, "b": 1, "c": 1, "d": 1, "x": 2, "y": 2, "z": 0,
    }


def test_components_of_a_random_graph(spark):
    draw = random.Random(5)
    names = [f"n{i:03}" for i in range(120)]
    edges = {(draw.choice(names), draw.choice(names)) for _ in range(90)}
    edges |= {(names[i], names[i + 1]) for i in range(40)}
    root = {n: n for n in names}

    def find(n):
        return n if root[n] == n else find(root[n])

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    both = list(edges) + [(b, a) for a, b in edges]
    found = groups.connected_labels(
        spark.createDataFrame(both, "a string, b string"),
        spark.createDataFrame([(n,) for n in names], "name string"),
    )
    assert dict(rows(found)) == {n: find(n) for n in names}


def test_matrix_views(spark):
    df = matrix(spark, "ab", {("a", "b"): 300, ("b", "a"): 25, ("b", "b"): 75})
    found = ev.confusion_matrix(df, ["a", "b"])
    assert rows(found) == [("a", 100, 300), ("b", 25, 75)]
    named = groups.confusion_groups(df)
    cells = {r[:2]: r[2:] for r in rows(ev.matrix_cells(df, named))}
    assert cells["a", "b"] == (1.0, "75.00%", True)
    assert cells["a", "a"] == (0.625, "25.00%", True)
    assert rows(ev.matrix_orders(df, named)) == [("a", 1, 1, 1), ("b", 2, 2, 2)]


def test_report_round_trip(spark, tmp_path):
    df = matrix(spark, ['q"uote', "b"], {("b", 'q"uote'): 7})
    lines = [json.loads(r[0]) for r in ev.report_json(df).collect()]
    assert {"b": {"b": 100, 'q"uote': 7}} in lines and len(lines) == 2
    path = tmp_path / "report.json"
    path.write_text(json.dumps(lines[0] | lines[1], indent=2))
    assert rows(readers.read_confusion_report(spark, str(path))) == rows(df)
    ev.report_json(df).write.text(str(tmp_path / "lines"))
    found = readers.read_confusion_report(spark, str(tmp_path / "lines"), lines=True)
    assert rows(found) == rows(df)


def test_graph_rows(spark):
    nodes, links = groups.confusion_graph(matrix(spark, "ab", {("a", "b"): 100}))
    found = [(r["kind"], json.loads(r["value"])) for r in writers.graph_rows(nodes, links).collect()]
    assert sorted((v["name"], v["group"]) for kind, v in found if kind == "node") == [
        ("a", 0), ("b", 0),
    ]
    assert sorted((v["source"], v["target"], v["value"]) for kind, v in found if kind == "link") == [
        (0, 0, 0.5), (0, 1, 0.5), (1, 0, 0.0), (1, 1, 1.0),
    ]


def random_probabilities(spark):
    draw = np.random.default_rng(2)
    groups_ = {
        ("a", "x"): draw.beta(0.05, 3, 501),
        ("a", "y"): 1 - draw.beta(0.05, 3, 500),
        ("b", "x"): draw.random(7),
        ("b", "y"): np.array([0.25]),
        ("c", "x"): np.repeat([0.0, 1.0, 0.5], [10, 5, 6]),
        ("c", "y"): draw.random(2),
        ("d", "x"): 10.0 ** draw.uniform(-40, -15, 300),
        ("d", "y"): 1 - 10.0 ** draw.uniform(-15, -10, 300),
    }
    table = [(*k, float(p)) for k, values in groups_.items() for p in values]
    table += [("a", "x", None), ("a", "x", float("nan"))]
    df = spark.createDataFrame(table, "label string, class string, prob double")
    return groups_, df.repartition(6)


def test_box_stats_equal_numpy(spark):
    values, df = random_probabilities(spark)
    found = {tuple(r[:2]): r[2:] for r in rows(quantiles.box_stats(df))}
    assert found.keys() == values.keys()
    for key, probs in values.items():
        q1, median, q3 = np.percentile(probs, [25, 50, 75])
        reach = 1.5 * (q3 - q1)
        inside = probs[(probs >= q1 - reach) & (probs <= q3 + reach)]
        wanted = [q1, median, q3, min(inside.min(), q1), max(inside.max(), q3)]
        assert found[key] == pytest.approx(wanted, abs=1e-12)


def test_medians_are_sorted(spark):
    values, df = random_probabilities(spark)
    found = [tuple(r) for r in quantiles.label_medians(df).collect()]
    wanted = sorted(
        ((*k, float(np.median(v))) for k, v in values.items()),
        key=lambda r: (r[0], -r[2], r[1]),
    )
    assert [r[:2] for r in found] == [r[:2] for r in wanted]
    assert [r[2] for r in found] == pytest.approx([r[2] for r in wanted])


def test_slices_never_fall(spark):
    df = spark.createDataFrame(
        [
            (float(p),)
            for p in [
                -1, 0, 5e-324, 1e-300, 1e-20, 1e-19, 1e-9, 0.1, 0.49, 0.5,
                0.5000001, 0.999999, 1 - 2**-53, 1, 1.5,
            ]
        ],
        "prob double",
    )
    found = [r[0] for r in df.select(quantiles.probability_slice("prob")).collect()]
    assert found == sorted(found)
    # apart from the ends, only 0.5 and 0.5000001 share a slice
    assert len(set(found)) == 11


def test_scores_and_reports(spark, tmp_path):
    def factory():
        return lambda texts: [
            {"long": float(len(t) > 3), "short": float(len(t) <= 3)} for t in texts
        ]

    files = spark.createDataFrame(
        [("1", "C", "abcdef"), ("2", "Go", "x")], "name string, label string, text string"
    )
    scores = ev.score_files(files, factory)
    assert rows(scores.select("name", "label", F.col("probs")["long"])) == [
        ("1", "C", 1.0), ("2", "Go", 0.0),
    ]
    long = ev.long_probabilities(scores, "name")
    wide = ev.wide_report(long, ["long", "short"])
    assert wide.columns == ["name", "_label_", "long", "short"]
    assert rows(wide) == [("1", "C", 1.0, 0.0), ("2", "Go", 0.0, 1.0)]
    back = ev.unpivot_report(wide, ["long", "short"])
    assert rows(back) == rows(long.drop("name"))
    writers.write_report_csv(wide, str(tmp_path / "report"))
    read = spark.read.csv(str(tmp_path / "report"), header=True)
    assert read.columns == wide.columns and read.count() == 2
