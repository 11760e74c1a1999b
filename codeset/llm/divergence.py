"""How far each source's term frequencies lie from other sources and from its language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeset.llm.arrow import by_bytes
from codeset.llm.terms import LETTERS, LOWER, count_terms, runs, text_bytes
from codeset.llm.tokens import positions
from codeset.operators.ranking import first_n
from codeset.session import land

SCALE = 1_000_000_000  # of probabilities
MIN_DOCUMENTS = 3  # of the language, that hold a kept term
TOP = 200
COUNT_BYTES = 8 << 20  # of text that is sorted at a time
BUCKET_ROWS = 200_000  # (source, term) rows that one task compares, about
CELLS = 1 << 21  # of the table of sources and terms that is held at a time


def names(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"),
    )


def counted_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, times, docs) of each batch."""
    for batch in by_bytes(batches, "_text", COUNT_BYTES):
        pairs = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist()))
        numbers = {pair: i for i, pair in enumerate(sorted(set(pairs)))}
        of_text = np.array([numbers[pair] for pair in pairs])
        data, bounds = text_bytes(batch.column("_text"))
        starts, lengths, text = runs(data, bounds, LETTERS)
        # Texts are numbered group by group, so that a term's groups are runs of its texts.
        place = np.argsort(of_text, kind="stable")
        rank = np.empty_like(place)
        rank[place] = np.arange(len(place))
        order = np.argsort(rank[text], kind="stable")
        grouped = of_text[place]
        named = list(numbers)
        langs, sources = (pa.array([pair[i] for pair in named], pa.string()) for i in (0, 1))
        lowered = LOWER[data]
        for part in count_terms(lowered, starts[order], lengths[order], rank[text][order]):
            group, terms = grouped[part.owner], part.terms()
            new = np.ones(len(group), bool)
            ends = np.cumsum(part.lengths)
            width = part.lengths
            new[1:] = (group[1:] != group[:-1]) | (width[1:] != width[:-1])
            same = np.flatnonzero(~new)
            new[same] = differs(part.data, ends, width, same)
            first = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays(
                [
                    langs.take(pa.array(group[first])), sources.take(pa.array(group[first])),
                    terms.take(pa.array(first)),
                    pa.array(np.add.reduceat(part.times, first).astype(np.int64)),
                    pa.array(np.diff(np.append(first, len(group))).astype(np.int64)),
                ],
                ["lang", "source", "term", "times", "docs"],
            )


def differs(data: np.ndarray, ends: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the terms at ``at`` differ from the ones before, which are as long."""
    size = lengths[at]
    here = data[positions(ends[at] - size, size)]
    before = data[positions(ends[at - 1] - size, size)]
    unequal = np.concatenate([[0], np.cumsum(here != before)])
    cuts = np.concatenate([[0], np.cumsum(size)])
    return unequal[cuts[1:]] > unequal[cuts[:-1]]


def probability(count: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)), in decimals; null of nothing."""
    above = f"(cast({count} as decimal(20, 0)) + 1) * {SCALE}"
    return F.expr(f"1 + ({above}) div nullif(cast({total} + {terms} as decimal(20, 0)), 0)")


def compare_bucket(key: tuple, rows: pa.Table) -> pa.Table:
    """(lang, source, item, value) summed over the terms of one bucket.

    Rows without a term give each source's probability of terms it lacks.
    The table of sources and terms is made a block of terms at a time.
    """
    lang = key[0].as_py()
    marks = rows.filter(pc.is_null(rows.column("term")))
    held = rows.filter(pc.is_valid(rows.column("term")))
    sources = sorted(marks.column("source").to_pylist(), key=str.encode)
    number = {name: i for i, name in enumerate(sources)}
    base = np.empty(len(sources), np.int64)
    for name, p in zip(marks.column("source").to_pylist(), marks.column("p").to_pylist()):
        base[number[name]] = p
    coded = held.column("term").combine_chunks().dictionary_encode()
    term = coded.indices.to_numpy()
    named = held.column("source").combine_chunks().dictionary_encode()
    places = np.array([number[name] for name in named.dictionary.to_pylist()], np.int64)
    source = places[named.indices.to_numpy()] if len(term) else term
    p = held.column("p").to_numpy()
    order = np.argsort(term, kind="stable")
    term, source, p = term[order], source[order], p[order]
    sums = np.zeros((len(sources), len(sources)), np.int64)
    step = max(1, CELLS // max(1, len(sources)))
    for begin in range(0, len(coded.dictionary), step):
        a, b = np.searchsorted(term, [begin, begin + step])
        width = min(step, len(coded.dictionary) - begin)
        table = np.repeat(base[:, None], width, 1)
        table[source[a:b], term[a:b] - begin] = p[a:b]
        for i in range(len(sources)):
            gap = table[i] - table
            sums[i] += (gap * gap // table).sum(1)
    i, j = np.nonzero(~np.eye(len(sources), dtype=bool))
    listed = pa.array(sources, pa.string())
    return pa.table(
        {
            "lang": pa.array([lang] * len(i), pa.string()),
            "source": listed.take(pa.array(i)), "item": listed.take(pa.array(j)),
            "value": pa.array(sums[i, j]),
        }
    )


def audit(docs: DataFrame, text: str = "text", top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) group.

    A language keeps the terms in at least three of its documents.  Part
    ``pair`` compares a source with each other one of its language over all
    kept terms, part ``term`` lists the terms it has more often than its
    language, up to ``top``.  Null texts and names count as empty; repeated
    rows count each; groups without kept terms have pairs of value 0; no rows
    give none; other columns are left out.

    Terms are counted inside tasks, so that only (group, term) sums are
    shuffled, by (lang, term).  Pairs are compared in buckets of a language's
    terms, each with all sources of the language and few rows for each.
    """
    schema = "lang string, source string, term string, times long, docs long"
    named = names(docs, text)
    sums = (
        named.mapInArrow(counted_batches, schema).groupBy("lang", "source", "term")
        .agg(F.sum("times").alias("times"), F.sum("docs").alias("docs"))
    )
    of_term = Window.partitionBy("lang", "term")
    held = land(
        sums.select(
            "lang", "source", "term", "times",
            F.sum("docs").over(of_term).alias("_docs"),
            F.sum("times").over(of_term).alias("lang_times"),
            (F.min("source").over(of_term) == F.col("source")).alias("first"),
        )
        .where(F.col("_docs") >= MIN_DOCUMENTS)
        .drop("_docs"),
        "term-counts",
    )
    totals = held.groupBy("lang", "source").agg(F.sum("times").alias("_total"))
    langs = held.where("first").groupBy("lang").agg(
        F.sum("lang_times").alias("_lang_total"), F.count(F.lit(1)).alias("_kept")
    )
    groups = land(
        named.select("lang", "source").distinct()
        .join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        .select(
            "lang", "source", F.coalesce("_total", F.lit(0)).alias("total"),
            F.coalesce("_lang_total", F.lit(0)).alias("lang_total"),
            F.coalesce("_kept", F.lit(0)).alias("kept"),
        ),
        "term-groups",
    )
    rows = held.join(groups, ["lang", "source"]).withColumns(
        {
            "p": probability("times", "total", "kept"),
            "q": probability("lang_times", "lang_total", "kept"),
        }
    )

    buckets = max(1, -(-held.count() // BUCKET_ROWS))
    marks = groups.select(
        "lang", "source", F.lit(None).cast("string").alias("term"),
        F.coalesce(probability("0", "total", "kept"), F.lit(1)).alias("p"),
        F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"),
    )
    dealt = rows.select(
        "lang", "source", "term", "p",
        F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int").alias("bucket"),
    )
    pairs = (
        marks.unionByName(dealt).groupBy("lang", "bucket")
        .applyInArrow(compare_bucket, "lang string, source string, item string, value long")
        .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    )
    of_source = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(of_source))

    distances = rows.where("p > q").select(
        "lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value")
    )
    terms = first_n(distances, ["lang", "source"], [-F.col("value"), "item"], top)

    def part(df: DataFrame, name: str) -> DataFrame:
        return df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")

    return part(pairs, "pair").unionByName(part(terms, "term"))
