import json

import pytest
from pyspark.sql import functions as F

from codeset import session
from codeset.operators.quotas import dataset_rows
from codeset.sources import readers, writers
from helpers import rows


def test_stage_tables(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError, match="repo_selected"):
        readers.read_stage(spark, root, "repo_selected")
    writers.write_stage(spark.range(3), root, "repo_selected")
    writers.write_stage(spark.range(2), root, "repo_selected")
    assert readers.read_stage(spark, root, "repo_selected").count() == 2


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    root = str(tmp_path)
    writers.append_batch(spark.range(3), root, "files", "one")
    writers.append_batch(spark.range(5), root, "files", "two")
    writers.append_batch(spark.range(4), root, "files", "one")
    assert readers.read_stage(spark, root, "files").count() == 9


def test_versions(spark, tmp_path):
    root = str(tmp_path)
    assert readers.latest_version(spark, root, "selected") == 0
    assert writers.write_versioned(spark.range(3), root, "selected") == 1
    assert writers.write_versioned(spark.range(4), root, "selected") == 2
    assert readers.read_versioned(spark, root, "selected").count() == 4
    assert spark.read.parquet(f"{root}/selected/v1").count() == 3
    # a write that stopped before it was published is not seen
    spark.range(9).write.parquet(f"{root}/selected/v3")
    assert readers.read_versioned(spark, root, "selected").count() == 4


def test_dataset_is_partitioned(spark, tmp_path):
    path = str(tmp_path / "files")
    table = spark.range(100).select(
        F.when(F.col("id") % 4 == 0, "test").otherwise("train").alias("usage"),
        F.when(F.col("id") % 3 == 0, "C#").otherwise("Go").alias("language"),
        F.concat(F.md5(F.encode(F.col("id").cast("string"), "UTF-8")), F.lit(".x")).alias("extract_to"),
        F.when(F.col("id") < 90, "text").alias("text"),
        F.when(F.col("id") < 80, "EXTRACTED").otherwise("PENDING").alias("status"),
    )
    writers.write_dataset(dataset_rows(table), path)
    back = spark.read.parquet(path)
    assert back.count() == 80
    pruned = back.where("usage = 'test' and language = 'C#'")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(usage" in plan
    assert pruned.count() == len([i for i in range(80) if i % 12 == 0])


def test_promises_are_checked_while_writing(spark, dictionary, tmp_path):
    rows = spark.range(60).select(
        F.when(F.col("id") % 4 == 0, "test").otherwise("train").alias("usage"),
        F.when(F.col("id") % 3 == 0, "Python").otherwise("Go").alias("language"),
        F.concat("id", F.when(F.col("id") % 3 == 0, ".py").otherwise(".go")).alias("extract_to"),
        F.lit("text").alias("text"),
    )
    counts = writers.write_dataset(rows, str(tmp_path / "good"), dictionary)
    assert counts["rows"] == 60 and counts["Python/test"] == 5 and counts["Go/train"] == 30
    assert counts["C/valid"] == 0 and spark.read.parquet(str(tmp_path / "good")).count() == 60
    changes = {
        "1 empty": ("text", ""), "1 not UTF-8": ("text", F.expr("cast(X'ff' as string)")),
        "1 of an unknown language": ("language", "Klingon"), "1 of a wrong suffix": ("extract_to", "7.c"),
    }
    for message, (column, value) in changes.items():
        value = F.lit(value) if isinstance(value, str) else value
        broken = rows.withColumn(column, F.when(F.col("extract_to") == "7.go", value).otherwise(F.col(column)))
        with pytest.raises(ValueError, match=message):
            writers.write_dataset(broken, str(tmp_path / "broken"), dictionary)


def test_files_follow_the_size_of_a_language(spark, tmp_path):
    """A large language is divided, small ones are not; no fixed number of tasks."""
    rows = spark.range(40_000).select(
        F.lit("train").alias("usage"), F.when(F.col("id") % 20 == 0, "Go").otherwise("C").alias("language"),
        F.concat("id", F.lit(".c")).alias("extract_to"), F.repeat(F.sha2(F.col("id").cast("string"), 512), 4).alias("text"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "1m")
    writers.write_dataset(rows, str(tmp_path / "sized"))
    spark.conf.set(size, before)
    files = {name: len(list((tmp_path / "sized" / "usage=train" / f"language={name}").glob("*.parquet"))) for name in ("C", "Go")}
    assert files["C"] >= 6 and files["Go"] <= 2


def test_training_subset_is_replaced(spark, tmp_path):
    for n in (3, 2):
        path = writers.write_training_subset(spark.range(n), str(tmp_path), 7)
    assert path.endswith("train_7")
    assert spark.read.parquet(path).count() == 2


def test_label_map(spark, dictionary):
    text = writers.export_label_map(dictionary.languages_df(spark)).first()[0]
    found = json.loads(text)
    assert found == dictionary.primary
    assert list(found) == sorted(found, key=str.lower)


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == configured
    landed = session.land(spark.range(5), "numbers")
    assert landed.count() == 5
    assert configured in landed.inputFiles()[0]


def test_cluster_without_shared_folder_is_refused():
    class Conf:
        def get(self, name, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_small_frame_is_a_local_relation(spark):
    df = session.small_frame(spark, [("a", 1), ("b", None)], "x string, y int")
    assert rows(df) == [("a", 1), ("b", None)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("LocalRelation")
