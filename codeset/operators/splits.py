"""Split whole repositories into train, valid and test."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeset.dictionary import Dictionary, known_language
from codeset.functions.order import DEFAULT_SEED, shuffle_key, slice_of
from codeset.operators.ranking import numbered

# The results depend on exactly these.
MIN_REPOSITORIES = 3
MIN_SPLIT_RATIO = 0.15
USAGES = ["train", "valid", "test"]


@dataclass(frozen=True)
class Quotas:
    """Files wanted per language for each usage."""

    train: int = 27_000
    valid: int = 4_000
    test: int = 4_000

    def __post_init__(self):
        if min(self.train, self.valid, self.test) < 0 or self.total == 0:
            raise ValueError("quotas must not be negative nor all zero")

    @property
    def total(self) -> int:
        return self.train + self.valid + self.test

    def ratio(self, usage: str) -> float:
        """Share of the repositories given to valid or test."""
        return max(getattr(self, usage) / self.total, MIN_SPLIT_RATIO)

    def of(self, usage: str | Column) -> Column:
        """The quota of a usage column."""
        usage = F.col(usage) if isinstance(usage, str) else usage
        return (
            F.when(usage == "train", self.train)
            .when(usage == "valid", self.valid)
            .when(usage == "test", self.test)
        )


def _share(total: str, ratio: float) -> Column:
    whole = F.floor(F.col(total).cast("double") * F.lit(ratio))
    return F.greatest(whole.cast("bigint"), F.lit(1).cast("bigint"))


def _numbered_repositories(
    files: DataFrame, dictionary: Dictionary, quotas: Quotas, seed: str
) -> DataFrame:
    """Distinct repositories in random order with the sizes of their splits.

    Languages with fewer than ``MIN_REPOSITORIES`` cannot be split and are left out.
    """
    repos = (
        files.where(
            known_language("repository_language", dictionary)
            & F.col("repository_dirname").isNotNull()
        )
        .select("repository_language", "repository_dirname")
        .distinct()
        .withColumn("_h", shuffle_key("repository_dirname", seed=seed))
        .withColumn("_slice", slice_of("_h"))
    )
    return (
        numbered(
            repos,
            ["repository_language"],
            ["_slice"],
            ["_h", "repository_dirname"],
        )
        .where(F.col("total") >= MIN_REPOSITORIES)
        .withColumn("nb_test", _share("total", quotas.ratio("test")))
        .withColumn("nb_valid", _share("total", quotas.ratio("valid")))
        .drop("_slice")
    )


def split_repositories(
    files: DataFrame,
    dictionary: Dictionary,
    quotas: Quotas,
    seed: str = DEFAULT_SEED,
) -> DataFrame:
    """Usage of each repository that owns a file.

    Per repository language, in random order: test first, then valid, and
    train takes the rest.  Languages that cannot be split have no usage:
    ``split_problems`` names them, ``require_split`` raises.
    """
    usage = (
        F.when(F.col("position") <= F.col("nb_test"), "test")
        .when(F.col("position") <= F.col("nb_test") + F.col("nb_valid"), "valid")
        .otherwise("train")
    )
    return _numbered_repositories(files, dictionary, quotas, seed).select(
        "repository_language", "repository_dirname", usage.alias("usage")
    )


def split_cuts(
    files: DataFrame,
    dictionary: Dictionary,
    quotas: Quotas,
    seed: str = DEFAULT_SEED,
) -> DataFrame:
    """Per repository language, the last repository of test and of valid.

    At most one row per language, which tells the usage of any repository.
    """
    place = F.struct("_h", "repository_dirname")
    last_test = F.col("nb_test")
    last_valid = F.col("nb_test") + F.col("nb_valid")
    return (
        _numbered_repositories(files, dictionary, quotas, seed)
        .where(F.col("position") <= last_valid)
        .groupBy("repository_language")
        .agg(
            F.max(F.when(F.col("position") <= last_test, place)).alias("test_cut"),
            F.max(place).alias("valid_cut"),
        )
    )


def assign_usage(
    files: DataFrame, cuts: DataFrame, seed: str = DEFAULT_SEED
) -> DataFrame:
    """Add ``usage`` to files; languages without a cut drop out.

    Comparing a repository's place with two broadcast cuts (one row per
    language) replaces a join with the repository table, which would send all
    files of a large repository to one task.
    """
    place = F.struct(
        shuffle_key("repository_dirname", seed=seed).alias("_h"),
        F.col("repository_dirname"),
    )
    usage = (
        F.when(place <= F.col("test_cut"), "test")
        .when(place <= F.col("valid_cut"), "valid")
        .otherwise("train")
    )
    return (
        files.join(F.broadcast(cuts), "repository_language")
        .withColumn("usage", usage)
        .drop("test_cut", "valid_cut")
    )


def split_report(
    splits: DataFrame, dictionary: Dictionary
) -> DataFrame:
    """Repositories per language and usage, zeros included."""
    counts = splits.groupBy(F.col("repository_language").alias("language")).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("usage") == u).alias(f"nb_{u}") for u in USAGES],
    )
    columns = ["total"] + [f"nb_{u}" for u in USAGES]
    return (
        dictionary.languages_df(splits.sparkSession)
        .select("language")
        .join(counts, "language", "left")
        .select("language", *[F.coalesce(c, F.lit(0)).alias(c) for c in columns])
    )


def split_problems(report: DataFrame) -> DataFrame:
    """Languages with too few repositories or an empty split."""
    return report.where(
        (F.col("total") < MIN_REPOSITORIES)
        | (F.least(*[f"nb_{u}" for u in USAGES]) < 1)
    )


def require_split(report: DataFrame) -> None:
    """Raise if a language of the dictionary cannot be split."""
    bad = [row.language for row in split_problems(report).collect()]
    if bad:
        raise RuntimeError(
            f"at least {MIN_REPOSITORIES} repositories and no empty split "
            f"needed; not so for: {', '.join(sorted(bad))}"
        )
