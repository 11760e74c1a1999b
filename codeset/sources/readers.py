"""Read catalogues, listings, contents, reports and stage tables."""

from __future__ import annotations

import os
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeset.dictionary import Dictionary
from codeset.functions.naming import basename
from codeset.operators.evaluation import label_by_extension, read_report
from codeset.session import small_frame
from codeset.sources.records import read_records

# The layout of a repository catalogue.
CATALOG_HEADER = [
    "ID", "Host Type", "Name with Owner", "Description", "Fork",
    "Created Timestamp", "Updated Timestamp", "Last pushed Timestamp",
    "Homepage URL", "Size", "Stars Count", "Language", "Issues enabled",
    "Wiki enabled", "Pages enabled", "Forks Count", "Mirror URL",
    "Open Issues Count", "Default branch", "Watchers Count", "UUID",
    "Fork Source Name with Owner", "License", "Contributors Count",
    "Readme filename", "Changelog filename",
    "Contributing guidelines filename", "License filename",
    "Code of Conduct filename", "Security Threat Model filename",
    "Security Audit filename", "Status", "Last Synced Timestamp",
    "SourceRank", "Display Name", "SCM type", "Pull requests enabled",
    "Logo URL", "Keywords",
]
_SCHEME = re.compile("^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?")  # and authority
MAX_FIELD = 10 * 1024 * 1024  # characters of one CSV field

REPOSITORY_SCHEMA = "repository_name string, repository_language string"


def read_repo_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The four used columns of a catalogue CSV, all as text.

    Quoted fields may hold line breaks; a file of any size is read by as many
    tasks as it has blocks.  The first line of each file is its header.
    """
    schema = ", ".join(f"`{name}` STRING" for name in CATALOG_HEADER)
    options = {"quote": '"', "escape": '"', "maxCharsPerColumn": str(MAX_FIELD)}
    records = read_records(spark, path).where("block > 0 or line > 0")
    rows = records.select(F.from_csv("record", schema, options).alias("row"))
    return rows.select(
        F.col("row.`Host Type`").alias("host_type"),
        F.col("row.`Name with Owner`").alias("name_with_owner"),
        F.col("row.`Fork`").alias("fork"),
        F.col("row.`Language`").alias("language"),
    )


def read_repo_list(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of repositories to add: curated, or listed by a user."""
    return spark.read.schema(REPOSITORY_SCHEMA).csv(path, header=True, escape='"')


PAGE_SCHEMA = "items array<struct<id: bigint, full_name: string>>"


def read_result_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed search result pages, one JSON document per file."""
    return spark.read.schema(PAGE_SCHEMA).json(path, multiLine=True)


def repo_list_from_pages(
    pages: DataFrame, language: str | Column, page: str | Column | None = None
) -> DataFrame:
    """Repositories of result pages; the first row of each id is kept.

    ``items`` is an array of (id, full_name); ``page`` gives the page order.
    """
    language = F.lit(language) if isinstance(language, str) else language
    page = F.col(page) if isinstance(page, str) else page
    page = F.lit(0) if page is None else page
    items = pages.select(
        language.alias("repository_language"),
        page.alias("_page"),
        F.posexplode("items").alias("_at", "_item"),
    )
    first = F.min(F.struct("_page", "_at", "_item.full_name", "repository_language"))
    return (
        items.groupBy("_item.id")
        .agg(first.alias("_first"))
        .select(
            F.col("_first.full_name").alias("repository_name"),
            "_first.repository_language",
        )
    )


def read_file_listings(spark: SparkSession, path: str) -> DataFrame:
    """Listing lines, one text file or one partition folder per repository."""
    lines = spark.read.text(path)
    if "repository_dirname" in lines.columns:
        name = F.col("repository_dirname")
    else:
        # the metadata column holds the name in URL form, but for "+"
        encoded = F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))
        name = F.regexp_replace(F.url_decode(encoded), r"\.txt$", "")
    return lines.select(name.alias("repository_dirname"), F.col("value").alias("line"))


def read_contents(spark: SparkSession, root: str) -> DataFrame:
    """Bytes of the files under ``root/<repository_dirname>/<filename>``.

    ``root`` is a URI or an absolute path; a relative one is taken from the
    working folder.  Paths are cut behind it, whatever folders of its name lie
    above or below.
    """
    located = root if _SCHEME.match(root) else os.path.abspath(root)
    begin = len(re.sub("/+", "/", _SCHEME.sub("", located)).rstrip("/")) + 2
    files = spark.read.format("binaryFile").load(located, recursiveFileLookup=True)
    tail = F.expr(f"substr(regexp_replace(path, '{_SCHEME.pattern}', ''), {begin})")
    return files.select(tail.alias("_tail"), "content").select(
        F.substring_index("_tail", "/", 1).alias("repository_dirname"),
        F.expr("substr(_tail, instr(_tail, '/') + 1)").alias("filename"),
        "content",
    )


def with_content(files: DataFrame, contents: DataFrame) -> DataFrame:
    """Files with their bytes; null content for unreachable ones."""
    return files.join(contents, ["repository_dirname", "filename"], "left")


def scan_directory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(name, suffix) of the files of a directory, without reading them."""
    files = spark.read.format("binaryFile").load(path, pathGlobFilter=pattern)
    name = basename("path")
    return files.select(
        name.alias("name"), F.regexp_extract(name, r"^.+(\.[^.]+)$", 1).alias("suffix")
    )


def scan_test_files(
    spark: SparkSession, path: str, dictionary: Dictionary
) -> DataFrame:
    """(name, label, text) of a directory's files of a known extension."""
    files = spark.read.format("binaryFile").load(path).select(
        basename("path").alias("name"),
        F.col("content").cast("string").alias("text"),
    )
    return label_by_extension(files, dictionary).select("name", "label", "text")


def read_confusion_report(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Cells (actual, predicted, n) of JSON report files, or of one report per line."""
    return read_report(spark.read.text(path, wholetext=not lines))


def _is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_stage(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stage table; a missing one is an error that names it."""
    try:
        return spark.read.parquet(f"{root}/{name}")
    except AnalysisException as error:
        if not _is_missing(error):
            raise
        raise FileNotFoundError(f"stage table {name} missing under {root}") from error


def read_versioned(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The newest version of a versioned table."""
    return read_stage(spark, root, f"{name}/v{latest_version(spark, root, name)}")


def latest_version(spark: SparkSession, root: str, name: str) -> int:
    """Number of the newest finished version; 0 if there is none."""
    try:
        versions = spark.read.parquet(f"{root}/{name}/versions")
    except AnalysisException as error:
        if not _is_missing(error):
            raise
        return 0
    return versions.agg(F.max("version")).first()[0] or 0


def record_version(spark: SparkSession, root: str, name: str, version: int) -> None:
    """Publish a version after its data is written."""
    row = small_frame(spark, [(version,)], "version int")
    row.coalesce(1).write.mode("append").parquet(f"{root}/{name}/versions")
