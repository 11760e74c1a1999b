"""The promises of a dataset as queries that return the rows breaking them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeset.dictionary import Dictionary
from codeset.functions.naming import EMPTY_BLOB, extension
from codeset.functions.text import is_utf8
from codeset.operators.quotas import EXTRACTED, language_usages
from codeset.operators.splits import Quotas


def check_unique(files: DataFrame) -> DataFrame:
    """Contents that occur more than once: (dedup_key, n_files)."""
    return (
        files.groupBy("dedup_key")
        .agg(F.count(F.lit(1)).alias("n_files"))
        .where("n_files > 1")
    )


def check_not_empty(files: DataFrame) -> DataFrame:
    """Files without content, told by length or by key."""
    empty = F.col("dedup_key") == EMPTY_BLOB
    if "content" in files.columns:
        empty = empty | (F.octet_length("content") == 0)
    return files.where(empty).select("repository_dirname", "filename")


def check_text_only(flagged: DataFrame) -> DataFrame:
    """Files that did not decode to text."""
    return flagged.where(~F.col("ok")).select("repository_dirname", "filename")


def check_utf8(files: DataFrame, column: str = "content") -> DataFrame:
    """Files whose bytes are not valid UTF-8."""
    return files.where(~is_utf8(column)).select("repository_dirname", "filename")


def check_one_split(files: DataFrame) -> DataFrame:
    """Repositories in more than one split: (repository_dirname, n_usages)."""
    pairs = files.select("repository_dirname", "usage").distinct()
    return (
        pairs.groupBy("repository_dirname")
        .agg(F.count(F.lit(1)).alias("n_usages"))
        .where("n_usages > 1")
    )


def check_quota(
    files: DataFrame, dictionary: Dictionary, quotas: Quotas
) -> DataFrame:
    """(language, usage) whose extracted files differ from the quota."""
    counts = (
        files.where(F.col("status") == EXTRACTED)
        .groupBy("language", "usage")
        .agg(F.count(F.lit(1)).alias("n_files"))
    )
    return (
        language_usages(files, dictionary)
        .join(counts, ["language", "usage"], "left")
        .select(
            "language",
            "usage",
            F.coalesce("n_files", F.lit(0)).alias("n_files"),
            quotas.of("usage").cast("bigint").alias("quota"),
        )
        .where("n_files <> quota")
    )


def check_suffix(files: DataFrame, dictionary: Dictionary) -> DataFrame:
    """Files whose output name lacks the primary extension of the language."""
    languages = dictionary.languages_df(files.sparkSession)
    return (
        files.join(dictionary.small(languages), "language")
        .where(extension("extract_to") != F.col("primary_ext"))
        .select("language", "extract_to")
    )
