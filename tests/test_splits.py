import pytest
from pyspark.sql import functions as F

from codeset.operators import splits as ops
from codeset.operators.checks import check_one_split
from helpers import rows


def files(spark, sizes, per_repository=3):
    """Files of numbered repositories per language."""
    table = [
        (language, f"{language}{i}", f"f{j}")
        for language, n in sizes.items()
        for i in range(n)
        for j in range(per_repository)
    ]
    return spark.createDataFrame(
        table, "repository_language string, repository_dirname string, filename string"
    )


def counts(splits, language):
    found = splits.where(F.col("repository_language") == language)
    return {r[0]: r[1] for r in rows(found.groupBy("usage").count())}


def test_sizes(spark, dictionary):
    df = files(spark, {"C": 3, "Go": 20, "Java": 100, "Brainfuck": 9})
    splits = ops.split_repositories(df, dictionary, ops.Quotas(27000, 4000, 4000))
    assert counts(splits, "C") == {"test": 1, "valid": 1, "train": 1}
    assert counts(splits, "Go") == {"test": 3, "valid": 3, "train": 14}
    assert counts(splits, "Java") == {"test": 15, "valid": 15, "train": 70}
    assert counts(splits, "Brainfuck") == {}
    even = ops.split_repositories(df, dictionary, ops.Quotas(1, 1, 1))
    assert counts(even, "Java") == {"test": 33, "valid": 33, "train": 34}


def test_zero_quota_keeps_the_floor(spark, dictionary):
    splits = ops.split_repositories(
        files(spark, {"C": 20}), dictionary, ops.Quotas(1, 1, 0)
    )
    assert counts(splits, "C") == {"test": 3, "valid": 10, "train": 7}


def test_quotas_must_not_be_all_zero():
    with pytest.raises(ValueError):
        ops.Quotas(0, 0, 0)


def test_files_follow_their_repository(spark, dictionary):
    df = files(spark, {"C": 40, "Go": 7})
    quotas = ops.Quotas(8, 1, 1)
    splits = ops.split_repositories(df, dictionary, quotas)
    cuts = ops.split_cuts(df.repartition(5), dictionary, quotas)
    assigned = ops.assign_usage(df, cuts)
    assert assigned.count() == 3 * 47
    assert check_one_split(assigned).isEmpty()
    assert rows(assigned.select(*splits.columns).distinct()) == rows(splits)


def test_report_and_problems(spark, dictionary):
    splits = ops.split_repositories(
        files(spark, {"C": 2, "Go": 3}), dictionary, ops.Quotas(1, 1, 1)
    )
    report = ops.split_report(splits, dictionary)
    found = {r.language: r.asDict() for r in report.collect()}
    assert found["Go"] == {
        "language": "Go", "total": 3, "nb_train": 1, "nb_valid": 1, "nb_test": 1,
    }
    bad = {r[0] for r in rows(ops.split_problems(report), "language")}
    assert "Go" not in bad and "C" in bad and len(bad) == 53
    with pytest.raises(RuntimeError, match="Zig|YAML"):
        ops.require_split(report)
    ops.require_split(report.where("language = 'Go'"))
