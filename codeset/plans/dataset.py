"""From repository and file tables to a dataset."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeset.dictionary import Dictionary, default_dictionary
from codeset.functions.naming import basename, content_key, extension
from codeset.functions.order import DEFAULT_SEED
from codeset.functions.text import (
    Detector,
    decode_files,
    detect_encoding,
    flag_files,
)
from codeset.operators.files import (
    dedup_files,
    new_repositories,
    parse_file_listing,
    rank_files,
    resolve_language,
    surviving_files,
)
from codeset.operators.membership import with_membership
from codeset.operators.quotas import (
    EXTRACTED,
    chosen_content,
    dataset_rows,
    reconcile,
    select_quota,
    subset_training,
)
from codeset.operators.repositories import (
    REPOSITORIES_PER_LANGUAGE,
    alter,
    prepare_repositories,
    present_dirs,
    require_any,
    select_repositories,
    shrink,
)
from codeset.operators.splits import (
    Quotas,
    assign_usage,
    require_split,
    split_cuts,
    split_report,
    split_repositories,
)
from codeset.session import broadcast_if_small, land


@dataclass(frozen=True)
class Settings:
    """What a dataset should look like.

    ``strict`` raises on malformed repository names and on languages of the
    dictionary that cannot be split; otherwise they are left out.  The
    ``detector`` sees the bytes of planned files that are not UTF-8.
    """

    repositories: int = REPOSITORIES_PER_LANGUAGE
    quotas: Quotas = field(default_factory=Quotas)
    dictionary: Dictionary = field(default_factory=default_dictionary)
    seed: str = DEFAULT_SEED
    strict: bool = True
    detector: Detector = detect_encoding


def choose_repositories(
    catalog: DataFrame, settings: Settings, curated: DataFrame | None = None
) -> DataFrame:
    """Catalogue to prepared repositories, landed; at least one must be left."""
    altered = alter(shrink(catalog), settings.dictionary, curated)
    selected = select_repositories(
        altered, settings.dictionary, settings.repositories, settings.seed
    )
    prepared = prepare_repositories(selected, settings.strict)
    return require_any(land(prepared, "repo_prepared"))


def unique_files(
    files: DataFrame, settings: Settings, prior: DataFrame | None = None
) -> DataFrame:
    """Listed files to ranked files of unique content, landed.

    Among files of one content, one that an earlier run extracted is kept.
    """
    ranked = rank_files(files, settings.dictionary, seed=settings.seed)
    if prior is None:
        return land(dedup_files(ranked), "unique_files")
    old = prior.where(F.col("status") == EXTRACTED).select(
        "extract_to", F.lit(0).alias("_new")
    )
    marked = ranked.join(old, "extract_to", "left").withColumn(
        "_new", F.coalesce("_new", F.lit(1))
    )
    return land(dedup_files(marked, ["_new"]).drop("_new"), "unique_files")


def with_usage(files: DataFrame, settings: Settings) -> DataFrame:
    """Unique files with the usage of their repository.

    The cuts are landed, at most one row per language, so that the files need
    not be written again to be scanned several times.
    """
    if settings.strict:
        splits = split_repositories(
            files, settings.dictionary, settings.quotas, settings.seed
        )
        require_split(split_report(splits, settings.dictionary))
    cuts = split_cuts(files, settings.dictionary, settings.quotas, settings.seed)
    return assign_usage(files, land(cuts, "split_cuts"), settings.seed)


def planned_files(
    files: DataFrame, settings: Settings, prior: DataFrame | None = None
) -> DataFrame:
    """Listed files to ranked files of unique content with a usage."""
    return with_usage(unique_files(files, settings, prior), settings)


def fill_quotas(
    plan: DataFrame,
    settings: Settings,
    prior: DataFrame | None = None,
    outputs: DataFrame | None = None,
) -> DataFrame:
    """Planned files with an ``ok`` flag to files with a status.

    Files of an earlier run that are gone do not count towards the quotas.
    """
    if prior is not None:
        prior = prior.join(plan.select("extract_to"), "extract_to", "left_semi")
    if prior is not None or outputs is not None:
        plan = land(reconcile(plan, prior, outputs), "files_reconciled")
    return select_quota(plan, settings.dictionary, settings.quotas)


def choose_files(
    files: DataFrame,
    settings: Settings,
    prior: DataFrame | None = None,
    outputs: DataFrame | None = None,
) -> DataFrame:
    """Listed files with an ``ok`` flag to files with usage and status."""
    return fill_quotas(planned_files(files, settings, prior), settings, prior, outputs)


def repository_languages(repos: DataFrame) -> DataFrame:
    """(repository_dirname, repository_language), landed.

    Two repository names may share a directory; it counts as one repository,
    whose contents are told apart by their key.
    """
    return land(
        repos.groupBy("repository_dirname").agg(
            F.min("repository_language").alias("repository_language")
        ),
        "repositories",
    )


def update_listing(
    files: DataFrame, ledger: DataFrame, repos: DataFrame, lines: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(listed files, ledger) after repositories came and went.

    Files of vanished repositories are dropped; ``lines`` has the listings of
    the repositories that the ledger does not name (others are not taken).
    The new ledger names them too, also those without files.
    """
    new = new_repositories(repos, ledger).select("repository_dirname").distinct()
    added = parse_file_listing(lines.join(new, "repository_dirname", "left_semi"))
    kept = surviving_files(files, repos).select(added.columns)
    return kept.unionByName(added), present_dirs(ledger).unionByName(new)


def build_from_listing(
    repos: DataFrame,
    listing: DataFrame,
    contents: DataFrame,
    settings: Settings,
    prior: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Repositories, their listed files and the bytes to (files with status, texts).

    ``repos`` has repository_dirname, repository_language; ``listing`` has
    repository_dirname, filename, dedup_key; ``contents`` has the first two
    and content.  Files are chosen by name, rank and key before any of their
    bytes is read; only the planned ones are checked to be text, and only the
    extracted ones are fetched.  The texts are those of all extracted files,
    also of earlier runs: a repository's usage changes when more repositories
    join its language, and no repository may be in two splits.
    """
    # A repository may hold a third of the files, so they are not shuffled by
    # repository unless there are too many repositories to broadcast.
    languages = broadcast_if_small(repository_languages(repos))
    listed = listing.join(languages, "repository_dirname")
    plan = land(planned_files(listed, settings, prior), "files_planned")
    key = ["repository_dirname", "filename", "dedup_key"]
    there = chosen_content(plan.select(*key), contents, same_content=True)
    flags = flag_files(there, detector=settings.detector).drop("encoding")
    flagged = plan.join(flags, key, "left").withColumn(
        "ok", F.coalesce("ok", F.lit(False))
    )
    files = land(
        fill_quotas(land(flagged, "files_flagged"), settings, prior), "files_extracted"
    )
    chosen = files.where(files.status == EXTRACTED).drop("ok")
    found = chosen_content(chosen, contents, same_content=True)
    texts = decode_files(found, detector=settings.detector)
    return files, dataset_rows(texts)


def list_contents(
    repos: DataFrame, contents: DataFrame, settings: Settings
) -> DataFrame:
    """The listing of contents: keys of the files whose names count, landed.

    One scan drops files of other repositories and of names that no language
    has, by bitmaps, and hashes the rest: bytes are never shuffled.  Their
    narrow rows are then joined with the repositories' languages.
    """
    spark, dictionary = contents.sparkSession, settings.dictionary
    languages = repository_languages(repos)
    rows = with_membership(contents, ["repository_dirname"], languages, name="_theirs")
    for name, part, owners in (
        ("_by_name", basename("filename"), dictionary.file_name_owners_df(spark)),
        ("_by_ext", extension("filename"), dictionary.extension_owners_df(spark)),
    ):
        rows = with_membership(rows, [part], owners, ["value"], name)
    keyed = rows.where("_theirs and (_by_name or _by_ext)").select(
        "repository_dirname", "filename", content_key("content").alias("dedup_key")
    )
    keys = land(keyed, "content_keys").join(broadcast_if_small(languages), "repository_dirname")
    named = resolve_language(keys, dictionary).where(F.col("language").isNotNull())
    return land(named.select("repository_dirname", "filename", "dedup_key"), "file_keys")


def build_dataset(
    repos: DataFrame,
    contents: DataFrame,
    settings: Settings,
    prior: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``build_from_listing`` for repositories whose files were not listed."""
    listing = list_contents(repos, contents, settings)
    return build_from_listing(repos, listing, contents, settings, prior)


def subset_texts(dataset: DataFrame, n: int, settings: Settings) -> DataFrame:
    """Random ``n`` training files per language of a written dataset, with text.

    The names are chosen first; only the chosen files' texts are shuffled.
    """
    train = dataset.where(F.col("usage") == "train").withColumnRenamed(
        "extract_to", "name"
    )
    chosen = subset_training(
        train.select("name"), settings.dictionary, n, settings.seed
    )
    return chosen_content(
        land(chosen, "subset"), train.select("name", "text"), ["name"]
    )
