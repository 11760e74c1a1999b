"""Catalogue to dataset, on generated repositories of every language."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from codeset.functions.naming import EMPTY_BLOB
from codeset.operators import checks
from codeset.operators.quotas import EXTRACTED
from codeset.operators.splits import Quotas
from codeset.plans import dataset
from codeset.plans.dataset import Settings
from helpers import rows

REPOSITORIES = 3
FILES = 3
NOISE = bytes([0x8F, 0x00, 0xC1, 0xFE, 0x93, 0xA7, 0xB2, 0x01, 0xD9, 0xE4]) * 3


@pytest.fixture(scope="module")
def settings():
    return Settings(repositories=REPOSITORIES, quotas=Quotas(FILES, FILES, FILES))


@pytest.fixture(scope="module")
def catalog(spark, settings):
    table = [
        ("GitHub", f"lang_{ext}/repo_{i:02}", "false", language)
        for language, ext in settings.dictionary.primary.items()
        for i in range(REPOSITORIES)
    ]
    table += [("GitHub", "a/fork", "true", "C"), ("GitHub", "a/odd", "false", "Brainfuck")]
    return spark.createDataFrame(
        table, "host_type string, name_with_owner string, fork string, language string"
    )


@pytest.fixture(scope="module")
def contents(spark, settings):
    d = settings.dictionary
    table = []
    for own in d.primary.values():
        for i in range(REPOSITORIES):
            repo = f"lang_{own}___repo_{i:02}"
            for language, ext in d.primary.items():
                base = f"src/{language}"
                table.append((repo, f"{base}/file.txt", b"text"))
                table.append((repo, f"{base}/empty.{ext}", b""))
                table.append((repo, f"{base}/licence.{ext}", f"same {ext}".encode()))
                table.append((repo, f"{base}/binary_00.{ext}", NOISE + f"{repo}{ext}".encode()))
                for j in range(FILES):
                    text = f"{repo}:{language}:{j:02}"
                    table.append((repo, f"{base}/unicode_{j:02}.{ext}", text.encode()))
                for name in d.file_names.get(language, []):
                    text = f"{repo}:{language}:{name}"
                    table.append((repo, f"{base}/{name}", text.encode()))
    return spark.createDataFrame(
        table, "repository_dirname string, filename string, content binary"
    ).repartition(8)


@pytest.fixture(scope="module")
def built(spark, settings, catalog, contents):
    repos = dataset.choose_repositories(catalog, settings)
    repos = repos.select("repository_language", "repository_dirname")
    files, texts = dataset.build_dataset(repos, contents, settings)
    return files.cache(), texts.cache()


def test_every_quota_is_met(built, settings):
    files, texts = built
    assert checks.check_quota(files, settings.dictionary, settings.quotas).isEmpty()
    assert texts.count() == 54 * 3 * FILES
    by_language = dict(rows(texts.groupBy("language").count()))
    assert by_language == {l: 3 * FILES for l in settings.dictionary.languages}


def test_promises(built, settings):
    files, texts = built
    extracted = files.where(F.col("status") == EXTRACTED)
    assert checks.check_unique(files).isEmpty()
    assert checks.check_not_empty(files).isEmpty()
    assert checks.check_one_split(files).isEmpty()
    assert checks.check_suffix(extracted, settings.dictionary).isEmpty()
    assert files.where(F.col("dedup_key") == EMPTY_BLOB).isEmpty()
    assert texts.where(F.col("text").contains("\x00")).isEmpty()
    assert files.where("filename like '%/file.txt'").isEmpty()
    assert texts.select("text").distinct().count() == texts.count()


def test_text_belongs_to_its_file(built):
    files, texts = built
    joined = texts.join(files, "extract_to").where(
        ~F.col("filename").contains("licence")
        & ~F.col("text").startswith(F.col("repository_dirname"))
    )
    assert joined.isEmpty()


def test_result_does_not_depend_on_partitions(spark, settings, catalog, contents, built):
    repos = dataset.choose_repositories(catalog.coalesce(1), settings)
    repos = repos.select("repository_language", "repository_dirname")
    files, _ = dataset.build_dataset(repos, contents.coalesce(2), settings)
    columns = ["repository_dirname", "filename", "usage", "rank", "status", "extract_to"]
    assert rows(files, *columns) == rows(built[0], *columns)


def test_a_second_run_adds_to_the_first(settings, catalog, contents, built):
    files, _ = built
    repos = dataset.choose_repositories(catalog, settings)
    repos = repos.select("repository_language", "repository_dirname")
    larger = Settings(
        repositories=REPOSITORIES, quotas=Quotas(FILES + 1, FILES + 1, FILES + 1)
    )
    again, _ = dataset.build_dataset(repos, contents, larger, prior=files)
    old = files.where(F.col("status") == EXTRACTED).select("extract_to")
    new = again.where(F.col("status") == EXTRACTED).select("extract_to")
    assert old.join(new, "extract_to", "left_anti").isEmpty()
    assert new.count() > old.count()


def test_copies_in_new_repositories_do_not_replace_old_files(
    spark, settings, catalog, contents, built
):
    files, _ = built
    old = files.where(F.col("status") == EXTRACTED).select("extract_to", "dedup_key")
    repos = dataset.choose_repositories(catalog, settings)
    repos = repos.select("repository_dirname", "repository_language")
    # a copy of every repository of one language, first in name order
    copied = contents.where("repository_dirname like 'lang_py%'").withColumn(
        "repository_dirname", F.concat(F.lit("a_"), "repository_dirname")
    )
    more = copied.select("repository_dirname").distinct()
    more = more.withColumn("repository_language", F.lit("Python"))
    again, texts = dataset.build_dataset(
        repos.unionByName(more), contents.unionByName(copied), settings, prior=files
    )
    assert checks.check_unique(again).isEmpty()
    assert checks.check_one_split(again).isEmpty()
    now = again.where(F.col("status") == EXTRACTED).select("extract_to", "dedup_key")
    assert old.join(now, ["extract_to", "dedup_key"], "left_anti").isEmpty()
    assert texts.select("text").distinct().count() == texts.count()


def test_files_that_are_gone_do_not_count(settings, catalog, contents, built):
    files, _ = built
    repos = dataset.choose_repositories(catalog, settings)
    gone = "src/C/unicode_00.c"
    left = contents.where(F.col("filename") != gone)
    again, _ = dataset.build_dataset(repos, left, settings, prior=files)
    assert again.where(F.col("filename") == gone).isEmpty()
    assert checks.check_quota(again, settings.dictionary, settings.quotas).isEmpty()


def test_strict_settings(spark, settings, catalog, contents):
    strict, loose = settings, replace(settings, strict=False)
    repos = dataset.choose_repositories(catalog, strict)
    few = repos.where("repository_language <> 'Go'")
    with pytest.raises(RuntimeError, match="not so for: Go"):
        dataset.build_dataset(few, contents, strict)
    bad = catalog.limit(1).withColumn("name_with_owner", F.lit("a/b/c"))
    with pytest.raises(Exception, match="bad name"):
        dataset.choose_repositories(bad, strict)
    with pytest.raises(RuntimeError, match="no repository"):
        dataset.choose_repositories(bad, loose)
    files, _ = dataset.build_dataset(few, contents, loose)
    assert files.where("repository_language = 'Go'").isEmpty()
    assert not files.where("repository_language = 'C' and status = 'EXTRACTED'").isEmpty()


def test_bytes_are_read_late(spark, settings, catalog, contents):
    """The detector sees only planned files: not by name, repository or rank."""
    seen = spark.sparkContext.accumulator(0)

    def detector(content):
        seen.add(1)
        return None, 0.0

    repos = dataset.choose_repositories(catalog, settings).select(
        "repository_language", "repository_dirname"
    )
    odd = contents.withColumn("content", F.concat("content", F.lit(NOISE)))
    other = odd.withColumn("repository_dirname", F.lit("not___chosen"))
    unnamed = odd.withColumn("filename", F.concat("filename", F.lit(".unknown")))
    watched = replace(settings, detector=detector)
    files, _ = dataset.build_dataset(repos, contents.unionByName(other).unionByName(unnamed), watched)
    planned = files.count()
    assert files.where("repository_dirname = 'not___chosen'").isEmpty()
    assert 0 < seen.value <= planned
    text = dataset.list_contents(repos, contents, settings)
    assert text.where("filename like '%/file.txt'").isEmpty()
