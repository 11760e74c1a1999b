"""Fill per-language quotas with files that decode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codeset.dictionary import Dictionary, known_language
from codeset.functions.naming import content_key, suffix
from codeset.functions.order import DEFAULT_SEED, shuffle_key, slice_of
from codeset.operators.membership import with_membership
from codeset.operators.ranking import first_by_hash, slice_totals
from codeset.operators.splits import USAGES, Quotas
from codeset.session import land

PENDING, EXTRACTED, DISCARDED = "PENDING", "EXTRACTED", "DISCARDED"

_GROUP = ["language", "usage"]


def language_usages(df: DataFrame, dictionary: Dictionary) -> DataFrame:
    """(language, usage): three rows per language of the dictionary."""
    usages = F.explode(F.array(*[F.lit(u) for u in USAGES]))
    return dictionary.languages_df(df.sparkSession).select(
        "language", usages.alias("usage")
    )


def reconcile(
    plan: DataFrame,
    prior: DataFrame | None = None,
    outputs: DataFrame | None = None,
    found_status: str = EXTRACTED,
) -> DataFrame:
    """The plan and the earlier state in one table, keyed by ``extract_to``.

    Rows without a status are PENDING.  A pending row whose output exists gets
    ``found_status``: EXTRACTED, as outputs are written by committed jobs, or
    DISCARDED to leave such files out.
    """
    if prior is None:
        files = plan.withColumn("status", F.lit(PENDING))
    else:
        shared = [c for c in plan.columns if c in prior.columns and c != "extract_to"]
        old = prior.select("extract_to", "status", *[F.col(c).alias(f"_{c}") for c in shared])
        files = (
            plan.join(old, "extract_to", "full_outer")
            .withColumns({c: F.coalesce(c, f"_{c}") for c in shared})
            .withColumn("status", F.coalesce("status", F.lit(PENDING)))
            .drop(*[f"_{c}" for c in shared])
        )
    if outputs is not None:
        there = outputs.select("usage", "extract_to").distinct()
        there = there.withColumn("_found", F.lit(True))
        found = (F.col("status") == PENDING) & F.col("_found")
        files = (
            files.join(there, ["usage", "extract_to"], "left")
            .withColumn("status", F.when(found, found_status).otherwise(F.col("status")))
            .drop("_found")
        )
    return files.select(*plan.columns, "status")


def update_status(files: DataFrame, results: DataFrame) -> DataFrame:
    """Take over the status of attempted files from ``(extract_to, status)``."""
    new = results.select("extract_to", F.col("status").alias("_new"))
    return (
        files.join(new, "extract_to", "left")
        .withColumn("status", F.coalesce("_new", "status"))
        .select(files.columns)
    )


def quota_cuts(
    files: DataFrame, dictionary: Dictionary, quotas: Quotas
) -> DataFrame:
    """Per (language, usage): files still needed, and the last one to take.

    ``cut_rank``/``cut_name`` place the ``need``-th decodable pending file in
    (rank, extract_to) order; they are null if there are fewer.  At most three
    rows per language.  Counts per (rank, name slice), landed, find the slice
    that holds the cut, and only that slice is sorted, so no task sees a whole
    group.
    """
    known = known_language("language", dictionary)
    done = F.col("status") == EXTRACTED
    waiting = F.col("ok") & (F.col("status") == PENDING)
    sliced = files.withColumn("_slice", slice_of("extract_to"))
    counts = land(
        sliced.where(known & (done | waiting))
        .groupBy(*_GROUP, "rank", "_slice")
        .agg(F.count_if(waiting).alias("_waiting"), F.count_if(done).alias("_done")),
        "quota_counts",
    )
    done_before = counts.groupBy(*_GROUP).agg(F.sum("_done").alias("_done"))
    left = quotas.of("usage") - F.coalesce("_done", F.lit(0))
    needs = (
        language_usages(files, dictionary)
        .join(done_before, _GROUP, "left")
        .select(*_GROUP, F.greatest(left, F.lit(0)).alias("need"))
    )
    holding = (
        slice_totals(counts, _GROUP, ["rank", "_slice"], F.col("_waiting"))
        .join(F.broadcast(needs), _GROUP)
        .where("before < need and need <= before + in_slice")
        .select(*_GROUP, "rank", "_slice", (F.col("need") - F.col("before")).alias("_nth"))
    )
    pending = sliced.where(known & waiting).select(
        *_GROUP, "rank", "extract_to", "_slice"
    )
    inside = Window.partitionBy(*_GROUP).orderBy("extract_to")
    cuts = (
        pending.join(F.broadcast(holding), [*_GROUP, "rank", "_slice"])
        .withColumn("_place", F.row_number().over(inside))
        .where("_place = _nth")
        .select(
            *_GROUP,
            F.col("rank").alias("cut_rank"),
            F.col("extract_to").alias("cut_name"),
        )
    )
    return needs.join(F.broadcast(cuts), _GROUP, "left")


def apply_cuts(files: DataFrame, cuts: DataFrame) -> DataFrame:
    """Set the status of the pending files up to the cuts.

    Decodable ones are EXTRACTED, the others DISCARDED: the same outcome as
    taking files in order and replacing each bad one by the next until the
    quota is met or the files run out.
    """
    reached = F.col("cut_rank").isNull() | (
        F.struct("rank", "extract_to")
        <= F.struct(F.col("cut_rank").alias("rank"), F.col("cut_name").alias("extract_to"))
    )
    taken = (F.col("status") == PENDING) & (F.col("need") > 0) & reached
    result = F.when(F.col("ok"), EXTRACTED).otherwise(DISCARDED)
    return (
        files.join(F.broadcast(cuts), _GROUP, "left")
        .withColumn("status", F.when(taken, result).otherwise(F.col("status")))
        .drop("need", "cut_rank", "cut_name")
    )


def select_quota(
    files: DataFrame, dictionary: Dictionary, quotas: Quotas
) -> DataFrame:
    """Extract, per (language, usage), the first decodable files by rank.

    ``files`` has language, usage, rank, extract_to, ok and maybe status.  It
    is scanned three times: give a landed table, not a long plan.
    """
    if "status" not in files.columns:
        files = files.withColumn("status", F.lit(PENDING))
    return apply_cuts(files, quota_cuts(files, dictionary, quotas))


def quota_report(
    files: DataFrame, dictionary: Dictionary, quotas: Quotas
) -> DataFrame:
    """Per (language, usage): pending, extracted, to_keep, kept, short."""
    counts = files.groupBy(*_GROUP).agg(
        F.count_if(F.col("status") == PENDING).alias("pending"),
        F.count_if(F.col("status") == EXTRACTED).alias("extracted"),
    )
    zero = F.lit(0).cast("bigint")
    return (
        language_usages(files, dictionary)
        .join(counts, _GROUP, "left")
        .select(
            *_GROUP,
            F.coalesce("pending", zero).alias("pending"),
            F.coalesce("extracted", zero).alias("extracted"),
        )
        .withColumn(
            "to_keep",
            F.greatest(quotas.of("usage").cast("bigint") - F.col("extracted"), zero),
        )
        .withColumn("kept", F.least("pending", "to_keep"))
        .withColumn("short", F.col("kept") < F.col("to_keep"))
    )


def status_totals(files: DataFrame) -> DataFrame:
    """Files per status."""
    return files.groupBy("status").agg(F.count(F.lit(1)).alias("n_files"))


def chosen_content(
    chosen: DataFrame,
    content: DataFrame,
    keys: Sequence[str] = ("repository_dirname", "filename"),
    same_content: bool = False,
) -> DataFrame:
    """Content rows of the chosen files, with the chosen files' columns.

    The bytes are the bulk of the data, so unwanted rows are dropped in their
    only scan, by broadcast bitmaps of the chosen keys, and the rest are
    joined with the chosen files (give a stored table).  With ``same_content``
    the bytes must have the chosen ``dedup_key``, as two repositories may
    share a directory name.
    """
    keys = list(keys)
    rows = with_membership(content, keys, chosen)
    found = rows.where("_member").drop("_member")
    extra = [c for c in content.columns if c not in chosen.columns]
    if same_content:
        found = found.withColumn("dedup_key", content_key("content"))
        keys.append("dedup_key")
        found = found.dropDuplicates(keys)  # copies under one name
    return chosen.join(found.select(*keys, *extra), keys)


def dataset_rows(extracted: DataFrame) -> DataFrame:
    """usage, language, extract_to, text of the extracted files with text."""
    return extracted.where(
        (F.col("status") == EXTRACTED) & F.col("text").isNotNull()
    ).select("usage", "language", "extract_to", "text")


def subset_training(
    names: DataFrame,
    dictionary: Dictionary,
    n: int,
    seed: str = DEFAULT_SEED,
) -> DataFrame:
    """Random ``n`` training files of each language, told by their suffix."""
    languages = dictionary.languages_df(names.sparkSession).select(
        "language", F.col("primary_ext").alias("_suffix")
    )
    own = [c for c in names.columns if c != "language"]
    labelled = (
        names.select(*own)
        .join(dictionary.small(languages), suffix("name") == F.col("_suffix"))
        .withColumn("_h", shuffle_key("name", seed=seed))
    )
    return first_by_hash(labelled, ["language"], "_h", ["name"], n).drop("_h", "_suffix")
