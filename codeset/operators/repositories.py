"""Repository tables: clean, merge, sample, top up and report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeset.dictionary import Dictionary, known_language, one_of
from codeset.functions.naming import (
    is_full_name,
    repository_dirname,
    repository_url,
)
from codeset.functions.order import DEFAULT_SEED, shuffle_key
from codeset.operators.ranking import first_n
from codeset.session import land

# The results depend on exactly these.
HOST = "GitHub"
NO_LANGUAGE = "Markdown"  # most repositories hold a readme at least
REPOSITORIES_PER_LANGUAGE = 8000

REPOSITORY = ["repository_name", "repository_language"]


def shrink(catalog: DataFrame, *keep: str) -> DataFrame:
    """Named, non-fork repositories of the host; ``keep`` adds columns."""
    return catalog.where(
        ~F.col("fork").eqNullSafe("true")
        & F.col("host_type").eqNullSafe(HOST)
        & (F.coalesce(F.col("name_with_owner"), F.lit("")) != "")
    ).select(
        F.col("name_with_owner").alias("repository_name"),
        F.col("language").alias("repository_language"),
        *keep,
    )


def normalise_language(repos: DataFrame, dictionary: Dictionary) -> DataFrame:
    """Replace a missing language by the default and an alias by its owner."""
    aliases = dictionary.aliases_df(repos.sparkSession).select(
        F.col("value").alias("_alias"), F.col("language").alias("_owner")
    )
    given = F.col("repository_language")
    named = F.when(given.isNull() | (given == ""), NO_LANGUAGE).otherwise(given)
    return (
        repos.withColumn("repository_language", named)
        .join(dictionary.small(aliases), given == F.col("_alias"), "left")
        .withColumn("repository_language", F.coalesce("_owner", given))
        .drop("_alias", "_owner")
    )


def merge_repo_lists(
    *lists: DataFrame, order: Sequence[str] = ()
) -> DataFrame:
    """One row per repository name; earlier lists win, then ``order``.

    Without ``order`` (columns of all lists that tell their rows' order), the
    first language by name is kept inside a list.
    """
    ranked = [
        repos.select(*REPOSITORY, *order, F.lit(i).alias("_list"))
        for i, repos in enumerate(lists)
    ]
    union = ranked[0]
    for repos in ranked[1:]:
        union = union.unionByName(repos)
    first = F.min(F.struct("_list", *order, "repository_language"))
    return (
        union.groupBy("repository_name")
        .agg(first.alias("_first"))
        .select("repository_name", "_first.repository_language")
    )


def alter(
    shrunk: DataFrame,
    dictionary: Dictionary,
    curated: DataFrame | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Normalised languages and unique names; curated rows come first."""
    lists = [normalise_language(shrunk, dictionary)]
    if curated is not None:
        missing = [c for c in order if c not in curated.columns]
        types = dict(shrunk.dtypes)
        nulls = {c: F.lit(None).cast(types[c]) for c in missing}
        lists.insert(0, curated.withColumns(nulls))
    return merge_repo_lists(*lists, order=order)


def select_repositories(
    repos: DataFrame,
    dictionary: Dictionary,
    cap: int = REPOSITORIES_PER_LANGUAGE,
    seed: str = DEFAULT_SEED,
) -> DataFrame:
    """At most ``cap`` random repositories of each known language."""
    known = repos.where(known_language("repository_language", dictionary))
    shuffled = known.withColumn("_h", shuffle_key("repository_name", seed=seed))
    chosen = first_n(
        shuffled, ["repository_language"], ["_h", "repository_name"], cap
    )
    return chosen.select(*REPOSITORY)


def selection_report(
    repos: DataFrame,
    dictionary: Dictionary,
    cap: int = REPOSITORIES_PER_LANGUAGE,
) -> DataFrame:
    """Per language: repositories found, kept under the cap, short of it."""
    found = repos.groupBy(F.col("repository_language").alias("language")).agg(
        F.count(F.lit(1)).alias("found")
    )
    return (
        dictionary.languages_df(repos.sparkSession)
        .join(found, "language", "left")
        .select("language", F.coalesce("found", F.lit(0)).alias("found"))
        .withColumn("kept", F.least("found", F.lit(cap).cast("bigint")))
        .withColumn("short", F.col("kept") < cap)
    )


def check_languages(languages: Sequence[str], dictionary: Dictionary) -> None:
    """Raise if a requested language is not in the dictionary."""
    unknown = sorted(set(languages) - set(dictionary.languages))
    if unknown:
        raise ValueError(f"unknown languages: {', '.join(unknown)}")


def _unknown_names(candidates: DataFrame, known: DataFrame) -> DataFrame:
    return candidates.join(
        known.select("repository_name"), "repository_name", "left_anti"
    )


def _known_counts(known: DataFrame, languages: Sequence[str]) -> DataFrame:
    """(language, known): one row per requested language that has any."""
    return (
        known.where(one_of("repository_language", languages))
        .groupBy(F.col("repository_language").alias("language"))
        .agg(F.count(F.lit(1)).alias("known"))
    )


def select_more(
    candidates: DataFrame,
    known: DataFrame,
    languages: Sequence[str],
    dictionary: Dictionary,
    cap: int = REPOSITORIES_PER_LANGUAGE,
    seed: str = DEFAULT_SEED,
    strict: bool = True,
) -> DataFrame:
    """The known repositories plus random new ones up to the cap.

    Only the listed languages are topped up.  If there is no new repository,
    the call raises, unless not ``strict``; to know, it writes the new ones to
    the shared folder.
    """
    check_languages(languages, dictionary)
    fresh = _unknown_names(candidates, known).where(
        one_of("repository_language", languages)
    )
    shuffled = fresh.withColumn("_h", shuffle_key("repository_name", seed=seed))
    nearest = first_n(
        shuffled, ["repository_language"], ["_h", "repository_name"], cap
    )
    # At most one row per requested language, so the broadcast is bounded.
    counts = _known_counts(known, languages).withColumnRenamed(
        "language", "repository_language"
    )
    missing = F.lit(cap) - F.coalesce("known", F.lit(0))
    new = nearest.join(
        F.broadcast(counts), "repository_language", "left"
    ).where(F.col("rank") <= missing)
    new = new.select(*REPOSITORY)
    if strict:
        new = require_any(land(new, "new_repositories"))
    return known.select(*REPOSITORY).unionByName(new)


def topup_report(
    candidates: DataFrame,
    known: DataFrame,
    languages: Sequence[str],
    dictionary: Dictionary,
    cap: int = REPOSITORIES_PER_LANGUAGE,
) -> DataFrame:
    """Per listed language: pending, known, required, selected, total, short."""
    check_languages(languages, dictionary)
    pending = (
        _unknown_names(candidates, known)
        .where(one_of("repository_language", languages))
        .groupBy(F.col("repository_language").alias("language"))
        .agg(F.count(F.lit(1)).alias("pending"))
    )
    zero, limit = F.lit(0).cast("bigint"), F.lit(cap).cast("bigint")
    return (
        dictionary.languages_df(candidates.sparkSession)
        .where(one_of("language", languages))
        .select("language")
        .join(pending, "language", "left")
        .join(_known_counts(known, languages), "language", "left")
        .select(
            "language",
            F.coalesce("pending", zero).alias("pending"),
            F.coalesce("known", zero).alias("known"),
        )
        .withColumn("required", F.greatest(limit - F.col("known"), zero))
        .withColumn("selected", F.least("pending", "required"))
        .withColumn("total", F.col("known") + F.col("selected"))
        .withColumn("short", F.col("total") < limit)
    )


def prepare_repositories(selected: DataFrame, strict: bool = True) -> DataFrame:
    """Add directory name and URL.

    Names other than ``user/project`` fail the query, or are left out if not
    ``strict`` (``malformed_names`` lists them).
    """
    good = is_full_name("repository_name")
    if strict:
        name = F.when(good, F.col("repository_name")).otherwise(
            F.raise_error(F.concat(F.lit("bad name: "), "repository_name"))
        )
        checked = selected.withColumn("repository_name", name)
    else:
        checked = selected.where(good)
    return checked.select(
        *REPOSITORY,
        repository_dirname("repository_name").alias("repository_dirname"),
        repository_url("repository_name").alias("repository_url"),
    )


def malformed_names(selected: DataFrame) -> DataFrame:
    """Repositories whose name is not ``user/project``."""
    return selected.where(
        ~F.coalesce(is_full_name("repository_name"), F.lit(False))
    ).select(*REPOSITORY)


def dirname_collisions(prepared: DataFrame) -> DataFrame:
    """Directories claimed by more than one repository name."""
    return (
        prepared.groupBy("repository_dirname")
        .agg(F.count(F.lit(1)).alias("n_repositories"))
        .where("n_repositories > 1")
    )


def non_empty_repositories(prepared: DataFrame, listing: DataFrame) -> DataFrame:
    """Prepared repositories that list at least one file."""
    return prepared.join(
        present_dirs(listing), "repository_dirname", "left_semi"
    ).select("repository_language", "repository_dirname")


def repo_distribution(repos: DataFrame) -> DataFrame:
    """Repositories per language, most frequent first."""
    return (
        repos.where(F.col("repository_language").isNotNull())
        .groupBy("repository_language")
        .agg(F.count(F.lit(1)).alias("n_repositories"))
        .orderBy(F.desc("n_repositories"), "repository_language")
    )


def present_dirs(files: DataFrame) -> DataFrame:
    """Directories that hold files.

    Made distinct before any join: one directory may hold a third of the files.
    """
    return files.select("repository_dirname").distinct()


def only_downloaded(
    selected: DataFrame, prepared: DataFrame, dirs: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Selected and prepared rows whose directory is present."""
    kept = prepared.join(
        present_dirs(dirs), "repository_dirname", "left_semi"
    ).select(prepared.columns)
    selected = selected.join(
        kept.select("repository_name"), "repository_name", "left_semi"
    )
    return selected, kept


def require_any(repos: DataFrame) -> DataFrame:
    """Raise if a selection is empty."""
    if repos.isEmpty():
        raise RuntimeError("no repository found")
    return repos
