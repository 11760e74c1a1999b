"""Quality rules whose cutoffs bound the share of good documents they reject.

DataFrame functions only.  Cutoffs come from labelled documents: a cutoff is
certified for a stratum if an exact binomial test shows that it rejects fewer
than ``risk`` of the stratum's good documents.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeset.session import land

# Fixed patterns of the base measures.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30  # percent


@dataclass(frozen=True)
class Rule:
    """Rejects a document whose measure exceeds the cutoff of a level.

    ``cutoffs`` go from the most lenient level to the strictest, fixed
    beforehand; all rules have the same number of levels.
    """

    name: str
    measure: str  # an expression over the measures
    cutoffs: tuple[float, ...]


RULES = (
    Rule("symbols", "n_symbols / nullif(word_chars, 0)", (0.5, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03)),
    Rule("shouting", "n_upper / nullif(word_chars, 0)", (0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1)),
    Rule("marks", "n_marks / nullif(word_chars, 0)", (0.5, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03)),
    Rule("repeats", "n_repeat_words / nullif(n_words, 0)", (0.28, 0.25, 0.2, 0.15, 0.12, 0.1, 0.07, 0.05)),
    Rule("lines", "n_dup_lines / nullif(n_words, 0)", (0.4, 0.3, 0.2, 0.1, 0.07, 0.05, 0.03, 0.02)),
    Rule("long_words", "word_chars / nullif(n_words, 0)", (40, 25, 18, 15, 13, 12, 11, 10)),
)
RISK = 0.01  # of a stratum's good documents, over all rules
ERROR = 0.05  # that any stratum's cutoffs are wrong
POOL = "(small strata)"  # strata with too few labels share one


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures of each whole text and ``base_failed``.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines
    with a word that equal an earlier line), n_repeat_words (words inside
    8-word windows that occur twice or more), n_upper and n_marks (A-Z and
    exclamation marks).  Windows are compared by 64-bit hashes within their
    document.  A null or empty text has no words and fails.
    """
    source = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(source, SPACE), lambda w: w != "")
    lines = F.filter(F.split(source, "\n"), lambda line: line.rlike(NOT_SPACE))
    counted = docs.withColumns({"_words": words, "_lines": lines}).withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.aggregate(
                "_words", F.lit(0).cast("long"), lambda n, w: n + F.char_length(w)
            ),
            "n_symbols": F.regexp_count(source, F.lit(SYMBOL)).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_upper": F.regexp_count(source, F.lit("[A-Z]")).cast("long"),
            "n_marks": F.regexp_count(source, F.lit("!")).cast("long"),
            "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
        }
    )
    windows = F.when(
        F.col("n_words") > WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size("_hashes") - WINDOW),
            lambda at: F.xxhash64(*(F.get("_hashes", at + i) for i in range(WINDOW))),
        ),
    )
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    places = F.when(
        repeated,
        F.array_sort(F.transform("_windows", lambda h, at: F.struct(h.alias("h"), at.alias("at")))),
    )

    def has_twin(place: Column, i: Column) -> Column:
        same = [F.get("_places", i + step)["h"] == place["h"] for step in (-1, 1)]
        return F.coalesce(same[0], F.lit(False)) | F.coalesce(same[1], F.lit(False))

    starts = F.array_sort(F.transform(F.filter("_places", has_twin), lambda place: place["at"]))
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda sum_, at: F.struct(
            (sum_["n"] + F.least(F.lit(WINDOW), at - sum_["last"])).alias("n"), at.alias("last")
        ),
        lambda sum_: sum_["n"],
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED
    )
    return (
        counted.withColumn("_windows", windows)
        .withColumn("_places", places)
        .withColumn("_starts", starts)
        .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
        .withColumn("base_failed", failed)
        .drop("_words", "_lines", "_hashes", "_windows", "_places", "_starts")
    )


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(at most k of n) for probability p, from logarithms term by term."""
    odds = F.ln(F.lit(p / (1 - p)))
    return F.aggregate(
        F.sequence(F.lit(0).cast("long"), k),
        F.struct((n * F.ln(F.lit(1 - p))).alias("log"), F.lit(0.0).alias("sum")),
        lambda s, i: F.struct(
            (s["log"] + F.ln((n - i) / (i + 1)) + odds).alias("log"),
            (s["sum"] + F.exp(s["log"])).alias("sum"),
        ),
        lambda s: s["sum"],
    )


def level_of(rules: tuple[Rule, ...]) -> Column:
    """The first level at which some rule rejects a document; null if none does."""
    found = F.lit(None).cast("int")
    for level in range(len(rules[0].cutoffs) - 1, -1, -1):
        over = F.lit(False)
        for rule in rules:
            over = over | F.coalesce(F.expr(rule.measure) > float(rule.cutoffs[level]), F.lit(False))
        found = F.when(over, level).otherwise(found)
    return found


def certified_levels(
    levelled: DataFrame, labels: DataFrame, levels: int, risk: float, error: float,
    key: str, stratum: str,
) -> DataFrame:
    """(stratum, chosen): the certified level of each stratum that catches most.

    A level joins the cutoffs of all rules, so levels are nested: each rejects
    what the more lenient ones reject.  For each stratum they are tested from
    the most lenient one on, at the full ``risk``, up to the first that an
    exact binomial test does not certify (a fixed sequence, which needs no
    correction); ``error`` is divided by the strata (Bonferroni).  Strata with
    so few good labels that none could be certified are pooled before any
    outcome is seen, and the bound holds for the pool.  Of the certified
    levels the most lenient one that rejects most bad documents is chosen.
    """
    quality = labels.where("quality is not null").groupBy(key).agg(F.min("quality").alias("_good"))
    held = levelled.where(~F.col("base_failed")).join(quality, key)
    by_level = [
        F.struct(
            F.lit(c).alias("place"),
            F.count(F.when((F.col("_level") <= c) & (F.col("_good") == 1), 1)).alias("k"),
            F.count(F.when((F.col("_level") <= c) & (F.col("_good") == 0), 1)).alias("caught"),
        ).alias(f"_level_{c}")
        for c in range(levels)
    ]
    counts = held.groupBy(stratum).agg(F.sum("_good").alias("n"), *by_level)
    everything = Window.partitionBy()  # one row per stratum
    sized = counts.withColumn("_strata", F.count(F.lit(1)).over(everything))
    needed = F.ceil(F.ln(F.lit(error) / F.col("_strata")) / math.log(1 - risk))
    named = sized.withColumn(
        "_pool", F.when(F.col("n") < needed, F.lit(POOL)).otherwise(F.col(stratum))
    )
    tests = (
        named.select(
            "_pool", "n", F.inline(F.array(*(F.col(f"_level_{c}") for c in range(levels))))
        )
        .groupBy("_pool", "place")
        .agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.sum("caught").alias("caught"))
        .withColumn("families", F.count(F.lit(1)).over(Window.partitionBy("place")))
    )
    passed = F.when(
        F.col("k") <= F.col("n") * risk,
        binomial_cdf(F.col("k"), F.col("n"), risk) <= F.lit(error) / F.col("families"),
    ).otherwise(False)
    so_far = Window.partitionBy("_pool").orderBy("place")
    best = F.struct("caught", (-F.col("place")).alias("lenient"), "place")
    chosen = (
        tests.withColumn("_passed", passed)
        .withColumn("_passed", F.min("_passed").over(so_far))
        .where(F.col("_passed") & (F.col("caught") > 0))
        .groupBy("_pool")
        .agg(F.max(best)["place"].alias("chosen"))
    )
    return named.join(chosen, "_pool").select(stratum, "chosen")


def levelled_rows(
    docs: DataFrame, carried: list[str], rules: tuple[Rule, ...], key: str, text: str, stratum: str
) -> DataFrame:
    """The ``carried`` columns as ``_row``, with the measures and the level of each row."""
    source = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in carried)).alias("_row"), F.col(key).alias("_key"),
        F.coalesce(F.col(stratum), F.lit("")).alias("_stratum"), F.col(text).alias("_text"),
    )
    return with_measures(source, "_text").drop("_text").withColumn("_level", level_of(rules))


def with_kept(levelled: DataFrame, chosen: DataFrame) -> DataFrame:
    """Add ``kept``; the few certified levels, one per stratum, are joined."""
    over = F.coalesce(F.col("_level") <= F.col("chosen"), F.lit(False))
    return levelled.join(chosen, "_stratum", "left").withColumn("kept", ~F.col("base_failed") & ~over)


def measured_and_chosen(
    docs: DataFrame, labels: DataFrame, rules: tuple[Rule, ...], risk: float, error: float,
    key: str, text: str, stratum: str,
) -> tuple[DataFrame, DataFrame]:
    """(narrow measures of all rows, landed; the certified level of each stratum, landed)."""
    measured = land(levelled_rows(docs, [key], rules, key, text, stratum), "measures")
    known = labels.select(F.col(key).alias("_key"), "quality")
    levels = len(rules[0].cutoffs)
    chosen = certified_levels(measured, known, levels, risk, error, "_key", "_stratum")
    return measured, land(chosen, "levels")


def kept_rows(
    docs: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES,
    risk: float = RISK, error: float = ERROR,
    key: str = "doc_id", text: str = "text", stratum: str = "lang",
) -> DataFrame:
    """The rows that ``judge`` keeps, with the input's columns.

    Each row has its own verdict, also where keys repeat or are null: after
    the levels are certified, a second scan measures and filters the rows, so
    their texts are neither shuffled nor written on the way.
    """
    _, chosen = measured_and_chosen(docs, labels, rules, risk, error, key, text, stratum)
    # A filter is not pushed below a column of row numbers, where the measures
    # that it reads would be spelt out again and again.
    rows = levelled_rows(docs, docs.columns, rules, key, text, stratum).withColumn(
        "_number", F.monotonically_increasing_id()
    )
    return with_kept(rows, chosen).where("kept and _number >= 0").select("_row.*")


def judge(
    docs: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES,
    risk: float = RISK, error: float = ERROR,
    key: str = "doc_id", text: str = "text", stratum: str = "lang",
) -> DataFrame:
    """(key, measures, base_failed, kept) of each row.

    ``kept`` is false for rows that fail the base rules or that the certified
    level of their stratum rejects.  Strata without a certified level keep
    what passes the base rules; null strata count as one; a key with several
    labels takes the lowest; repeated rows are judged each; other columns are
    left out.
    """
    measured, chosen = measured_and_chosen(docs, labels, rules, risk, error, key, text, stratum)
    return with_kept(measured, chosen).select(
        F.col("_row")[key].alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept",
    )
