"""Sources mixed to target weights by iterative proportional fitting (raking)."""

from __future__ import annotations

import warnings
from collections.abc import Mapping

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codeset.llm import topics as topic_model
from codeset.session import land, small_frame

MARGINS = ("source", "lang", "topic")
TOPICS = 4
POWER = 0.7  # natural shares to this power are the default targets
KEEP = 0.8  # of all tokens, in the sample, or less where the targets ask for it
TOLERANCE = 1e-4
MAX_ROUNDS = 1000
PATIENCE = 25  # rounds without progress, after which a smaller sample is tried
PROGRESS = 1e-3  # of the distance, that counts
SHRINK = 0.95  # of the sample, from one try to the next
MIN_KEEP = 0.05
SMALL_CELLS = 100_000  # rows of the table of cells that numpy rakes; larger ones stay in Spark
SEED = 11
DIGITS = 9  # of probabilities

Wanted = Mapping[str, Mapping[str, float]]


def with_cells(docs: DataFrame, model: topic_model.Topics, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Add the cell of each row (one level per margin), its tokens and its draw.

    Tokens are counted as words; the draw is a hash in [0, 1) of key and text.
    """
    source = F.coalesce(F.col(text), F.lit(""))
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    words = F.regexp_count(source, F.lit(r"[^\x20\x09-\x0D]+"))
    draw = F.pmod(F.xxhash64(F.lit(SEED), F.col(key), source), F.lit(1 << 53)) / float(1 << 53)
    return docs.withColumns(
        {
            "_source": F.coalesce(F.col("source").cast("string"), F.lit("")),
            "_lang": lang,
            "_topic": topic_model.topic_column(model, source, lang),
            "_tokens": (words + 1).cast("long"),
            "_draw": draw,
        }
    )


def targets_of(cells: DataFrame, margin: str, wanted: Mapping[str, float] | None, power: float) -> DataFrame:
    """(level, tokens, target share) of a margin; the shares sum to 1.

    Levels that ``wanted`` names get its shares, the others share what is
    left as their natural shares to ``power`` stand to each other.
    """
    spark = cells.sparkSession
    named = small_frame(spark, list((wanted or {}).items()), f"{margin} string, _named double")
    levels = cells.groupBy(margin).agg(F.sum("tokens").alias("tokens")).join(F.broadcast(named), margin, "left")
    raw = F.when(F.col("_named").isNull(), F.pow(F.col("tokens").cast("double"), F.lit(power)))
    whole = Window.partitionBy()  # one row per level
    left = F.when(
        F.max(raw).over(whole).isNotNull(),
        F.greatest(F.lit(0.0), 1 - F.coalesce(F.sum("_named").over(whole), F.lit(0.0))),
    ).otherwise(0.0)
    share = F.when(
        F.col("_named").isNotNull(), F.col("_named") * (1 - left) / F.sum("_named").over(whole)
    ).otherwise(raw * left / F.sum(raw).over(whole))
    return levels.select(F.lit(margin).alias("margin"), F.col(margin).alias("level"), "tokens", share.alias("target"))


def all_targets(cells: DataFrame, wanted: Wanted | None = None, power: float = POWER) -> DataFrame:
    """(margin, level, tokens, target) of every margin."""
    parts = [targets_of(cells, margin, (wanted or {}).get(margin), power) for margin in MARGINS]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


class Search:
    """When to go on raking, when to try a smaller sample, and when to stop."""

    def __init__(self, keep: float, tolerance: float):
        self.keep, self.tolerance = keep, tolerance
        self.least, self.waited, self.done = float("inf"), 0, False

    def judge(self, worst: float) -> float:
        """The factor that the sample is to shrink by after a round that is ``worst`` off."""
        self.done = worst <= self.tolerance
        self.waited = 0 if worst < self.least * (1 - PROGRESS) else self.waited + 1
        self.least = min(self.least, worst)
        if self.done or self.waited < PATIENCE:
            return 1.0
        if self.keep * SHRINK < MIN_KEEP:
            self.done = True
            return 1.0
        self.least, self.waited, self.keep = float("inf"), 0, self.keep * SHRINK
        return SHRINK


def raked_small(
    tokens: np.ndarray, codes: list[np.ndarray], targets: list[np.ndarray], keep: float,
    tolerance: float, max_rounds: int,
) -> tuple[np.ndarray, float, float]:
    """(probabilities, sample, distance) of cells whose levels are numbered."""
    total, search, worst = tokens.sum(), Search(keep, tolerance), 0.0
    u = np.full(len(tokens), keep)
    for _ in range(max_rounds):
        worst = 0.0
        for code, share in zip(codes, targets):
            goal = share * search.keep * total
            full = np.bincount(code, tokens * (u >= 1), len(share))
            rest = np.bincount(code, tokens * np.where(u < 1, u, 0), len(share))
            worst = max(worst, float(np.max(np.abs((full + rest) / goal - 1))))
            free = (goal > full) & (rest > 0)
            factor = np.where(free, (goal - full) / np.where(free, rest, 1), goal / (full + rest))
            u = u * factor[code]
        u *= search.judge(worst)
        if search.done:
            break
    return np.minimum(u, 1), search.keep, worst


def raked_large(
    cells: DataFrame, targets: DataFrame, keep: float, tolerance: float, max_rounds: int
) -> tuple[DataFrame, float, float]:
    """The same by one Spark job a round, for tables of cells of any size."""
    total = float(cells.agg(F.sum("tokens")).first()[0])
    search, worst = Search(keep, tolerance), 0.0
    cells = cells.withColumn("u", F.lit(keep))
    for _ in range(max_rounds):
        moved = cells.withColumn("off", F.lit(0.0))
        is_full = F.col("u") >= 1
        for margin in MARGINS:
            of = targets.where(F.col("margin") == margin).select(
                F.col("level").alias(margin), (F.col("target") * search.keep * total).alias("goal")
            )
            sums = moved.groupBy(margin).agg(
                F.sum(F.when(is_full, F.col("tokens")).otherwise(0)).alias("full"),
                F.sum(F.when(is_full, 0.0).otherwise(F.col("tokens") * F.col("u"))).alias("rest"),
            ).join(of, margin)
            held = F.col("full") + F.col("rest")
            factor = F.when(
                (F.col("goal") > F.col("full")) & (F.col("rest") > 0), (F.col("goal") - F.col("full")) / F.col("rest")
            ).otherwise(F.col("goal") / held)
            factors = sums.select(margin, factor.alias("factor"), F.abs(held / F.col("goal") - 1).alias("miss"))
            moved = moved.join(factors, margin).select(
                *MARGINS, "tokens", (F.col("u") * F.col("factor")).alias("u"), F.greatest("off", "miss").alias("off")
            )
        cells = land(moved, "cells")
        worst = cells.agg(F.max("off")).first()[0]
        cells = cells.withColumn("u", F.col("u") * search.judge(worst)).drop("off")
        if search.done:
            break
    return cells.withColumn("probability", F.least("u", F.lit(1.0))).drop("u"), search.keep, worst


def rake(
    cells: DataFrame,
    wanted: Wanted | None = None,
    power: float = POWER,
    keep: float = KEEP,
    tolerance: float = TOLERANCE,
    max_rounds: int = MAX_ROUNDS,
    small: int = SMALL_CELLS,
) -> DataFrame:
    """``cells`` with a ``probability`` of 1 at most and its ``weight``, for a sample that meets all targets.

    ``cells`` has one row per (source, lang, topic) with its ``tokens``.  Each
    step scales the cells of every level of one margin, so that the tokens
    expected of it meet its target share of the sample; cells that reach
    probability 1 count whole and the others make up for them.  The sample is
    ``keep`` of all tokens, or as much as the scarcest level allows; where
    raking makes no progress it shrinks, as cells at 1 may stand in the way.
    If the targets exclude each other, or after ``max_rounds``, the last
    probabilities are returned with a warning that tells the distance.
    ``weight`` is the probability by the share sampled.  Up to ``small`` cells
    are raked in numpy, more by Spark jobs.
    """
    cells = land(cells.select(*MARGINS, "tokens"), "cells")
    targets = land(all_targets(cells, wanted, power), "targets")
    row = cells.agg(F.count(F.lit(1)), F.sum("tokens")).first()
    if not row[0]:
        return cells.withColumns({"weight": F.lit(1.0), "probability": F.lit(1.0)})
    scarce = targets.agg(F.min(F.col("tokens") / F.col("target") / F.lit(float(row[1])))).first()[0]
    keep = min(keep, scarce * (1 - 1e-6))
    if row[0] <= small:
        held = cells.orderBy(*MARGINS).toArrow()
        levels = {(r["margin"], r["level"]): r["target"] for r in targets.collect()}  # fewer than cells
        codes, goals = [], []
        for margin in MARGINS:
            coded = held.column(margin).combine_chunks().dictionary_encode()
            codes.append(coded.indices.to_numpy())
            goals.append(np.array([levels[margin, x] for x in coded.dictionary.to_pylist()]))
        tokens = held.column("tokens").to_numpy().astype(float)
        p, keep, worst = raked_small(tokens, codes, goals, keep, tolerance, max_rounds)
        keys = zip(*(held.column(name).to_pylist() for name in (*MARGINS, "tokens")))
        rows = [(*k, x) for k, x in zip(keys, p.tolist())]
        found = small_frame(
            cells.sparkSession, rows, "source string, lang string, topic string, tokens long, probability double"
        )
    else:
        found, keep, worst = raked_large(cells, targets, keep, tolerance, max_rounds)
    if worst > tolerance:
        warnings.warn(
            f"the sample misses a target by a factor of {1 + worst:.4g}: "
            "no weights of the cells at hand meet all targets together",
            stacklevel=2,
        )
    probability = F.round("probability", DIGITS)
    return found.select(
        *MARGINS, "tokens", F.round(F.col("probability") / keep, DIGITS).alias("weight"),
        probability.alias("probability"),
    )


def achieved_shares(
    weighted: DataFrame, wanted: Wanted | None = None, power: float = POWER, by: str = "probability"
) -> DataFrame:
    """(margin, level, target, share) of every level after ``rake``.

    ``by`` is the column that tokens are multiplied by.
    """
    amount = F.col("tokens") * F.col(by)
    levels = F.inline(F.array(*(F.struct(F.lit(m).alias("margin"), F.col(m).alias("level")) for m in MARGINS)))
    sums = weighted.select(amount.alias("_amount"), levels).groupBy("margin", "level").agg(F.sum("_amount").alias("_sum"))
    shares = sums.withColumn("share", F.try_divide("_sum", F.sum("_sum").over(Window.partitionBy("margin"))))
    return all_targets(weighted, wanted, power).join(shares, ["margin", "level"]).select(
        "margin", "level", "target", "share"
    )


def cell_probabilities(
    celled: DataFrame, wanted: Wanted | None = None, power: float = POWER, keep: float = KEEP
) -> DataFrame:
    """(source, lang, topic, tokens, weight, probability) of every cell of ``with_cells``."""
    cells = celled.groupBy(*(F.col(f"_{m}").alias(m) for m in MARGINS)).agg(F.sum("_tokens").alias("tokens"))
    return land(rake(cells, wanted, power, keep), "probabilities")


def sampled(celled: DataFrame, probabilities: DataFrame) -> DataFrame:
    """Rows of ``with_cells`` with their cell's weight and probability, and ``_kept``.

    The cells' table is joined by its names; Spark broadcasts it if its size
    allows, else adaptive execution splits hot cells.
    """
    named = probabilities.select(
        *(F.col(m).alias(f"_{m}") for m in MARGINS),
        F.col("weight").alias("_weight"), F.col("probability").alias("_probability"),
    )
    return celled.join(named, [f"_{m}" for m in MARGINS]).withColumn("_kept", F.col("_draw") < F.col("_probability"))


def celled_rows(docs: DataFrame, key: str, text: str) -> tuple[topic_model.Topics, DataFrame]:
    """(topics, narrow landed rows with their cell, tokens and draw)."""
    model = topic_model.learn(docs, TOPICS, text, "lang")
    narrow = with_cells(docs.select(key, text, "source", "lang"), model, key, text).select(
        key, *(f"_{m}" for m in MARGINS), "_tokens", "_draw"
    )
    return model, land(narrow, "mixture")


def mix(
    docs: DataFrame,
    wanted: Wanted | None = None,
    power: float = POWER,
    keep: float = KEEP,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows drawn for the target mixture, with the input's columns.

    A row is kept if its draw is below its cell's probability: the same rows
    in every run.  Null sources and languages are levels of their own, null
    texts count as empty; repeated rows share their draw; no rows give none.
    Tokens of the sample meet the targets in expectation.
    """
    model, narrow = celled_rows(docs, key, text)
    probabilities = cell_probabilities(narrow, wanted, power, keep)
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    rows = with_cells(docs.select(whole, key, text, "source", "lang"), model, key, text)
    return sampled(rows, probabilities).where("_kept").select("_row.*")


def mixture(
    docs: DataFrame,
    wanted: Wanted | None = None,
    power: float = POWER,
    keep: float = KEEP,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, source, lang, topic, tokens, weight, probability, kept) of every row."""
    _, narrow = celled_rows(docs, key, text)
    rows = sampled(narrow, cell_probabilities(narrow, wanted, power, keep))
    names = (*MARGINS, "tokens", "weight", "probability", "kept")
    return rows.select(key, *(F.col(f"_{name}").alias(name) for name in names))
