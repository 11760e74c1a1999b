"""The plans of the heavy steps: what is shuffled, and what is not."""

import re

import pytest
from pyspark.sql import functions as F

from codeset.functions.naming import content_key
from codeset.functions.text import decode_files, flag_files
from codeset.operators import files as file_ops
from codeset.operators import quantiles, ranking
from codeset.operators import quotas as quota_ops
from codeset.operators import repositories as repo_ops
from codeset.operators import splits as split_ops
from codeset.operators.splits import Quotas
from codeset.plans import dataset
from codeset.session import broadcast_if_small, land


def plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", text)


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning")


@pytest.fixture(scope="module")
def listing(spark):
    return land(
        spark.range(1000).select(
            F.concat(F.lit("r"), F.col("id") % 30).alias("repository_dirname"),
            F.lit("C").alias("repository_language"),
            F.concat(F.lit("f"), "id", F.lit(".py")).alias("filename"),
            F.sha1(F.encode(F.col("id").cast("string"), "UTF-8")).alias("dedup_key"),
            (F.col("id") % 5 > 0).alias("ok"),
        ),
        "listing",
    )


def test_language_lookup_does_not_shuffle(listing, dictionary):
    resolved = file_ops.resolve_language(listing, dictionary)
    assert shuffles(resolved) == 0
    assert plan(resolved).count("BroadcastHashJoin") == 2


def test_ranking_shuffles_twice_after_a_limit(listing, dictionary):
    ranked = file_ops.rank_files(listing, dictionary)
    assert shuffles(ranked) == 2
    assert plan(ranked).count("WindowGroupLimit") == 4


def test_dedup_combines_before_its_shuffle(listing):
    text = plan(file_ops.dedup_files(listing))
    assert "partial_min" in text.split("Exchange hashpartitioning")[1]
    assert text.count("Exchange hashpartitioning") == 1


def test_usage_and_status_do_not_shuffle_the_files(listing, dictionary):
    quotas = Quotas(8, 1, 1)
    cuts = land(split_ops.split_cuts(listing, dictionary, quotas), "cuts")
    files = split_ops.assign_usage(listing, cuts)
    assert shuffles(files) == 0
    files = file_ops.resolve_language(files, dictionary)
    files = files.withColumn("rank", F.lit(1)).withColumn("extract_to", F.col("dedup_key"))
    files = files.withColumn("status", F.lit(quota_ops.PENDING))
    quota = land(quota_ops.quota_cuts(files, dictionary, quotas), "quota_cuts")
    assert shuffles(quota_ops.apply_cuts(files, quota)) == 0


def test_selection_reads_three_columns(spark, dictionary, tmp_path):
    wide = spark.range(100).select(
        F.concat(F.lit("u/p"), "id").alias("name_with_owner"),
        F.lit("GitHub").alias("host_type"),
        F.lit("false").alias("fork"),
        F.lit("C").alias("language"),
        F.lit("long text").alias("description"),
    )
    wide.write.parquet(str(tmp_path / "catalog"))
    shrunk = repo_ops.shrink(spark.read.parquet(str(tmp_path / "catalog")))
    text = plan(shrunk)
    assert "description" not in text
    assert "EqualTo(host_type,GitHub)" in text or "EqualNullSafe(host_type,GitHub)" in text


def test_bytes_are_decoded_once_and_filtered_before_the_shuffle(spark):
    contents = land(
        spark.range(100).select(
            F.lit("r").alias("repository_dirname"),
            F.concat(F.lit("f"), "id").alias("filename"),
            F.encode(F.concat(F.lit("t"), "id"), "UTF-8").alias("content"),
        ),
        "contents",
    )
    assert plan(decode_files(contents)).count("ArrowEvalPython") == 1
    assert shuffles(decode_files(contents)) == 0
    flagged = plan(flag_files(contents))
    assert flagged.count("ArrowEvalPython") == 1
    below = flagged.split("ArrowEvalPython")[1].splitlines()[1]
    assert "Project [repository_dirname, filename, isnull(content) AS _missing" in below
    assert ", content," not in below
    chosen = land(contents.limit(3).drop("content"), "chosen")
    text = plan(quota_ops.chosen_content(chosen, contents))
    assert "bitmap_construct_agg" in text


def test_reports_prune_the_bytes(listing):
    text = plan(repo_ops.present_dirs(listing))
    assert "ReadSchema: struct<repository_dirname:string>" in text


def test_names_are_filtered_below_the_hash(spark, dictionary, listing):
    """The hash of the bytes is projected above the join with the names."""
    contents = listing.withColumn("content", F.encode("filename", "UTF-8")).select(
        "repository_dirname", "repository_language", "filename", "content"
    )
    named = file_ops.resolve_language(land(contents, "contents"), dictionary)
    keyed = named.where("language is not null").select(content_key("content").alias("k"))
    lines = plan(keyed).splitlines()
    hashed = next(i for i, line in enumerate(lines) if "sha1" in line)
    joined = next(i for i, line in enumerate(lines) if "BroadcastHashJoin" in line)
    assert hashed < joined


def test_top_n_spreads_a_repository_after_a_shuffled_join(spark, listing, dictionary):
    """Partitioned by repository, the files are dealt anew by (group, share)."""
    repos = listing.select("repository_dirname").distinct()
    joined = listing.join(
        broadcast_if_small(land(repos, "repos"), max_rows=0).hint("shuffle_hash"),
        "repository_dirname",
    )
    text = plan(file_ops.rank_files(joined, dictionary))
    assert re.search(r"Exchange hashpartitioning\(_group, _share", text)
    one = listing.withColumn("repository_dirname", F.lit("hot"))
    shares = one.select(F.pmod(F.xxhash64("filename"), F.lit(64))).distinct().count()
    assert shares > 1


def test_top_n_of_many_rows_is_cut_before_its_shuffle(listing):
    spark = listing.sparkSession
    spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    text = plan(ranking.first_n(listing, ["repository_language"], ["filename"], 40_000))
    assert text.count("WindowGroupLimit") == 4


@pytest.fixture
def no_automatic_broadcasts(spark):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    yield
    spark.conf.set(threshold, before)


def written_contents(spark, n=50):
    return land(
        spark.range(n).selectExpr(
            "concat('r', id % 5) AS repository_dirname", "concat('f', id, if(id % 2 = 0, '.py', '.xyz')) AS filename",
            "cast(concat('x', id) AS binary) AS content",
        ),
        "contents",
    )


def test_unwanted_bytes_are_dropped_in_one_scan(spark, no_automatic_broadcasts):
    """Bytes meet a filter of the bitmaps before they are shuffled, in one scan of the contents."""
    contents = written_contents(spark)
    for n in (0, 5, 40):
        chosen = land(contents.limit(n).drop("content"), "chosen")
        found = quota_ops.chosen_content(chosen, contents)
        lines = plan(found).splitlines()
        scans = [line for line in lines if "FileScan" in line and "content:binary" in line]
        assert len(scans) == 1
        scan = lines.index(scans[0])
        member = max(i for i in range(scan) if "BroadcastHashJoin" in lines[i])
        shuffled = [i for i in range(scan) if "Exchange hashpartitioning" in lines[i] and i > member]
        assert not shuffled
        assert found.count() == n


def test_bytes_of_a_listing_are_never_shuffled(spark, dictionary, no_automatic_broadcasts, monkeypatch):
    """No exchange lies above the column of bytes, whatever the number of repositories."""
    plans = []

    def remember(df, name):
        plans.append(plan(df))
        return land(df, name)

    monkeypatch.setattr(dataset, "land", remember)
    monkeypatch.setattr(dataset, "broadcast_if_small", lambda df: df)
    contents = written_contents(spark)
    repos = spark.createDataFrame(
        [(f"r{i}", "Python") for i in range(3)], "repository_dirname string, repository_language string"
    )
    settings = dataset.Settings(repositories=5, quotas=Quotas(3, 1, 1))
    listed = dataset.list_contents(repos, contents, settings)
    assert listed.count() == sum(i % 5 < 3 and i % 2 == 0 for i in range(50))
    reading = [text for text in plans if "content:binary" in text]
    assert len(reading) == 1
    above = reading[0][: reading[0].index("content:binary")]
    assert "Exchange hashpartitioning(repository_dirname" not in above
    assert above.count("SortMergeJoin") == 0


def test_values_are_not_shuffled_to_find_quantiles(spark):
    counts = land(
        spark.range(2000).selectExpr("id % 3 AS g", "id / 2000 AS value", "1L AS n", "cast(id / 10 AS int) AS _slice"),
        "counts",
    )
    text = plan(quantiles.quantiles(counts, ["g"], [0.5]))
    joined = text.split("BroadcastHashJoin")[1]
    assert "Exchange hashpartitioning" not in joined
