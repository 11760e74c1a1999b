"""File tables: language, rank, duplicates, incremental listing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeset.dictionary import Dictionary
from codeset.functions.naming import (
    EMPTY_BLOB,
    basename,
    extension,
    output_name,
)
from codeset.functions.order import DEFAULT_SEED, shuffle_key
from codeset.operators.ranking import first_n
from codeset.operators.repositories import present_dirs

# Fixed value: files of one language taken from one repository.
FILES_PER_REPOSITORY = 1000


def parse_file_listing(lines: DataFrame) -> DataFrame:
    """Split ``mode type hash<TAB>path`` lines; shorter lines are left out."""
    line = F.trim("line", F.lit(" \t\n\r\x0b\x0c"))
    return (
        lines.select("repository_dirname", F.split(line, r"\s+", 4).alias("_part"))
        .where(F.size("_part") == 4)
        .select(
            "repository_dirname",
            F.col("_part")[3].alias("filename"),
            F.col("_part")[2].alias("dedup_key"),
        )
    )


def resolve_language(files: DataFrame, dictionary: Dictionary) -> DataFrame:
    """Add ``language``: by exact file name, else by extension, else null.

    A name with several owners counts only if the repository's language is
    among them.  Look-ups carry the owners as an array, so rows never multiply;
    both tables are bounded by the dictionary and broadcast if it is small.
    """
    spark = files.sparkSession
    by_name = dictionary.file_name_owners_df(spark).select(
        F.col("value").alias("_name"), F.col("owners").alias("_name_owners")
    )
    by_ext = dictionary.extension_owners_df(spark).select(
        F.col("value").alias("_ext"), F.col("owners").alias("_ext_owners")
    )

    def owner(owners):
        theirs = F.array_contains(owners, F.col("repository_language"))
        return F.when(F.size(owners) == 1, F.element_at(owners, 1)).when(
            theirs, F.col("repository_language")
        )

    return (
        files.join(
            dictionary.small(by_name), basename("filename") == F.col("_name"), "left"
        )
        .join(dictionary.small(by_ext), extension("filename") == F.col("_ext"), "left")
        .withColumn("language", F.coalesce(owner("_name_owners"), owner("_ext_owners")))
        .drop("_name", "_name_owners", "_ext", "_ext_owners")
    )


def usable_files(files: DataFrame, dictionary: Dictionary) -> DataFrame:
    """Non-empty files of a known language; directories are left out.

    All conditions act on the resolved language.  As a filter of its own, the
    one on the key would be pushed below the projection that makes the key,
    and a key hashed from content would be hashed twice.
    """
    listed = (F.col("dedup_key") != EMPTY_BLOB) & ~F.col("filename").endswith("/")
    return (
        resolve_language(files, dictionary)
        .withColumn("language", F.when(listed, F.col("language")))
        .where(F.col("language").isNotNull())
    )


def rank_files(
    files: DataFrame,
    dictionary: Dictionary,
    cap: int = FILES_PER_REPOSITORY,
    seed: str = DEFAULT_SEED,
) -> DataFrame:
    """Shuffle the usable files of each (repository, language) and number them.

    ``rank`` counts from 1 to ``cap``; ``extract_to`` is the output name.
    """
    shuffled = usable_files(files, dictionary).withColumn(
        "_h", shuffle_key("repository_dirname", "filename", seed=seed)
    )
    ranked = first_n(
        shuffled,
        ["repository_dirname", "language"],
        ["_h", "filename", "dedup_key"],
        cap,
    ).drop("_h")
    languages = dictionary.languages_df(files.sparkSession)
    return (
        ranked.join(
            dictionary.small(languages.select("language", "primary_ext")), "language"
        )
        .withColumn("extract_to", output_name("primary_ext"))
        .drop("primary_ext")
    )


def dedup_files(files: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """One file per content: the first by ``order``, repository and name.

    The minimum is combined before the shuffle, so a licence text copied into
    every repository costs one row per task.
    """
    first = [*order, "repository_dirname", "filename"]
    rest = [c for c in files.columns if c not in (*first, "dedup_key")]
    smallest = F.min(F.struct(*first, *rest))
    return (
        files.groupBy("dedup_key")
        .agg(smallest.alias("_file"))
        .select("dedup_key", "_file.*")
        .select(files.columns)
    )


def available_by_language(files: DataFrame, dictionary: Dictionary) -> DataFrame:
    """Files per language in dictionary order, zeros included."""
    counts = files.groupBy("language").agg(F.count(F.lit(1)).alias("n_files"))
    return (
        dictionary.languages_df(files.sparkSession)
        .join(counts, "language", "left")
        .select("language", F.coalesce("n_files", F.lit(0)).alias("n_files"), "position")
        .orderBy("position")
        .drop("position")
    )


def new_repositories(repos: DataFrame, ledger: DataFrame) -> DataFrame:
    """Repositories that were never listed.

    The ledger names every processed repository, also those without files.
    """
    return repos.join(present_dirs(ledger), "repository_dirname", "left_anti")


def surviving_files(files: DataFrame, repos: DataFrame) -> DataFrame:
    """Listed files whose repository still exists.

    The files of a hot repository may end in one partition of the join, which
    adaptive execution splits (a semi join may split its left side).
    """
    return files.join(present_dirs(repos), "repository_dirname", "left_semi")


def removal_report(files: DataFrame, repos: DataFrame) -> DataFrame:
    """One row: repositories listed before, after, and removed."""
    kept = present_dirs(repos).withColumn("_kept", F.lit(1))
    listed = present_dirs(files)
    return (
        listed.join(kept, "repository_dirname", "left")
        .agg(F.count(F.lit(1)).alias("n_before"), F.count("_kept").alias("n_after"))
        .withColumn("n_removed", F.col("n_before") - F.col("n_after"))
    )


def files_by_repository(
    files: DataFrame, batch_size: int = FILES_PER_REPOSITORY
) -> DataFrame:
    """Work lists for a fetcher: the files of each repository, sorted by name.

    A batch takes ``batch_size`` ranks of each language, so a list is bounded
    however large the repository is.
    """
    batch = F.floor((F.col("rank") - 1) / batch_size).cast("int")
    item = F.struct("filename", "extract_to", "language", "usage")
    return (
        files.groupBy("repository_dirname", batch.alias("batch"))
        .agg(F.sort_array(F.collect_list(item)).alias("files"))
        .withColumn("n_files", F.size("files").cast("bigint"))
    )
