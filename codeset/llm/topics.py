"""Topics of texts: clusters of hashed words, learnt from all texts by Spark jobs.

Each task adds up its rows in whole numbers, and Spark adds up the tasks: the
same texts give the same topics, however they are dealt.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeset.session import land
from codeset.llm.terms import LETTERS, LOWER, WORD, padded, runs, text_bytes

BUCKETS = 512  # of words, by hash
MIN_LETTERS = 4  # of a word that counts, in bytes
MIN_OF_LANGUAGE = 20  # different texts of a language that has a mean of its own,
MIN_SHARE = 0.01  # and their share of all: so at most a hundred means are held
ROUNDS = 25
SCALE = float(1 << 36)  # of shares that are added up as whole numbers
STEPS = float(1 << 14)  # of a vector's components, kept as 16-bit whole numbers
DIGITS = 9  # of similarities that are compared
_MIX = np.uint64(0x9E3779B97F4A7C15)  # odd, with bits spread over the word
BATCH_BYTES = 1 << 20
ROWS = 512  # texts that are compared at a time


def word_counts(texts: pa.Array) -> np.ndarray:
    """For each text the number of its words by bucket."""
    data, bounds = text_bytes(texts)
    found = np.zeros((len(texts), BUCKETS), np.int64)
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + BATCH_BYTES, "right")) - 1)
        part = data[bounds[begin] : bounds[end]]
        starts, lengths, text = runs(part, bounds[begin : end + 1] - bounds[begin], LETTERS)
        long = lengths >= MIN_LETTERS
        starts, lengths, text = starts[long], lengths[long], text[long]
        words = padded(LOWER[part], starts, np.minimum(lengths, WORD), WORD).view("<u8").ravel()
        bucket = ((words + lengths.astype(np.uint64)) * _MIX) >> np.uint64(64 - 9)
        cells = text * BUCKETS + bucket.astype(np.int64)
        found[begin:end] = np.bincount(cells, minlength=(end - begin) * BUCKETS).reshape(-1, BUCKETS)
        begin = end
    return found


def shares_of(counts: np.ndarray) -> np.ndarray:
    """The square roots of counts, of length 1."""
    found = np.sqrt(counts)
    return found / np.maximum(1e-12, np.linalg.norm(found, axis=1, keepdims=True))


def word_shares(texts: pa.Array) -> np.ndarray:
    """For each text the square roots of its words' counts by bucket, of length 1."""
    return shares_of(word_counts(texts))


@dataclass
class Topics:
    """Means of languages, and centres of what texts have beside their language's mean."""

    means: dict[str | None, np.ndarray]  # None: of all texts
    centres: np.ndarray

    def rest(self, shares: np.ndarray, langs: list[str]) -> np.ndarray:
        default = self.means[None]
        return shares - np.array([self.means.get(lang, default) for lang in langs]).reshape(-1, BUCKETS)

    def of(self, texts: pa.Array, langs: pa.Array) -> np.ndarray:
        """The number of each text's topic, the first of equals."""
        found, names = [], langs.to_pylist()
        for at in range(0, len(texts), ROWS):
            rest = self.rest(word_shares(texts[at : at + ROWS]), names[at : at + ROWS])
            found.append(np.round(rest @ self.centres.T, DIGITS).argmax(1))
        return np.concatenate([np.zeros(0, np.int64), *found])


_COUNTED, _VECTORS = "order long, lang string, words binary", "order long, vector binary"
Batches = Iterator[pa.RecordBatch]


def counted_texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(order, lang, words) of each different text of a language, landed.

    ``order`` is a hash of both, ``words`` are its counts by bucket.
    """

    def counted(batches: Batches) -> Batches:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                counts = word_counts(part.column("_text")).astype("<i4")
                words = pa.array([row.tobytes() for row in counts], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("_order"), part.column("_lang"), words], ["order", "lang", "words"]
                )

    rows = docs.select(
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("_lang"),
    ).withColumn("_order", F.xxhash64("_lang", "_text"))
    return land(rows.mapInArrow(counted, _COUNTED).dropDuplicates(), "topic-words")


def shares_by_part(batches: Batches) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[str]]]:
    """(rows, shares, languages) of a few rows of ``counted_texts`` at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            counts = text_bytes(part.column("words"))[0].view("<i4").reshape(-1, BUCKETS)
            yield part, shares_of(counts), part.column("lang").to_pylist()


def vectors_by_part(batches: Batches) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """(rows, vectors in whole steps) of a few rows of ``unit_vectors`` at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, text_bytes(part.column("vector"))[0].view("<i2").reshape(-1, BUCKETS).astype(float)


def group_sums(
    rows: DataFrame, groups: int, of: Callable[[Batches], Iterator[tuple[np.ndarray, np.ndarray]]]
) -> tuple[np.ndarray, np.ndarray]:
    """(texts, sum of vectors) of each group; ``of`` gives groups and vectors of whole numbers."""

    def summed(batches: Batches) -> Batches:
        sums, texts = np.zeros((groups, BUCKETS), np.int64), np.zeros(groups, np.int64)
        for group, whole in of(batches):  # exact in floats: few rows of numbers far below 2^53
            sums += ((np.arange(groups)[:, None] == group).astype(float) @ whole).astype(np.int64)
            texts += np.bincount(group, minlength=groups)
        held = np.column_stack([texts, sums])
        number, place = np.nonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(number), pa.array(place), pa.array(held[number, place])], ["number", "place", "value"]
        )

    each = rows.mapInArrow(summed, "number long, place long, value long")
    found = np.zeros((groups, BUCKETS + 1))
    total = F.sum(F.col("value").cast("decimal(20,0)")).cast("double").alias("total")
    for row in each.groupBy("number", "place").agg(total).collect():  # groups x buckets at most
        found[row["number"], row["place"]] = row["total"]
    return found[:, 0], found[:, 1:]


def language_means(rows: DataFrame) -> dict[str | None, np.ndarray]:
    """Mean shares of all texts, and of each language of enough texts; none without texts."""
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n")).first()[0]
    if not total:
        return {}
    least = max(MIN_OF_LANGUAGE, MIN_SHARE * total)
    names = sorted(row["lang"] for row in sizes.where(F.col("n") >= least).collect())  # 1 / MIN_SHARE at most
    numbers = {name: number for number, name in enumerate(names)}

    def by_language(batches: Batches) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for _, shares, langs in shares_by_part(batches):
            yield np.array([numbers.get(lang, len(numbers)) for lang in langs]), np.rint(shares * SCALE)

    texts, sums = group_sums(rows, len(names) + 1, by_language)
    sums /= SCALE
    means = {name: sums[number] / texts[number] for name, number in numbers.items()}
    return {None: sums.sum(0) / texts.sum(), **means}


def unit_vectors(rows: DataFrame, means: dict[str | None, np.ndarray]) -> DataFrame:
    """(order, vector) of each text, landed: what it has beside its language's mean, of length 1."""
    model = Topics(means, np.zeros((0, BUCKETS)))

    def units(batches: Batches) -> Batches:
        for part, shares, langs in shares_by_part(batches):
            rest = model.rest(shares, langs)
            rest /= np.maximum(1e-12, np.linalg.norm(rest, axis=1, keepdims=True))
            vectors = [row.tobytes() for row in np.rint(rest * STEPS).astype("<i2")]
            yield pa.RecordBatch.from_arrays([part.column("order"), pa.array(vectors, pa.binary())], ["order", "vector"])

    return land(rows.mapInArrow(units, _VECTORS), "topic-vectors")


def similarity(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.round(vectors @ centres.T / STEPS, DIGITS)


def farthest(vectors: DataFrame, centres: np.ndarray) -> np.ndarray:
    """The text least like any centre; the first by ``order`` without a centre, or of equals."""

    def least(batches: Batches) -> Batches:
        for part, whole in vectors_by_part(batches):
            like = similarity(whole, centres).max(1) if len(centres) else np.zeros(len(whole))
            at = int(np.lexsort((part.column("order").to_numpy(), like))[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(like[at : at + 1]), *part.slice(at, 1).columns], ["like", *part.schema.names]
            )

    found = vectors.mapInArrow(least, f"like double, {_VECTORS}").orderBy("like", "order", "vector").first()
    return np.frombuffer(found["vector"], "<i2").reshape(1, BUCKETS) / STEPS


def cluster(vectors: DataFrame, topics: int) -> np.ndarray:
    """Centres of length 1, by spherical k-means from texts far from each other, one job a round."""
    centres = np.zeros((0, BUCKETS))
    for _ in range(topics):
        centres = np.concatenate([centres, farthest(vectors, centres)])
    for _ in range(ROUNDS):

        def by_topic(batches: Batches, centres: np.ndarray = centres) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for _, whole in vectors_by_part(batches):
                yield similarity(whole, centres).argmax(1), whole

        texts, sums = group_sums(vectors, topics, by_topic)
        moved = sums / np.maximum(1e-12, np.linalg.norm(sums, axis=1, keepdims=True))
        moved = np.where(texts[:, None] > 0, moved, centres)
        if np.array_equal(moved, centres):
            break
        centres = moved
    return centres


def learn(docs: DataFrame, topics: int, text: str, lang: str) -> Topics:
    """Topics of all texts; a text that a language has several times counts once.

    Texts are read once, for their words' counts; means are taken of these,
    and rounds read vectors of 16-bit numbers.
    """
    rows = counted_texts(docs, text, lang)
    means = language_means(rows)
    if not means:
        return Topics({None: np.zeros(BUCKETS)}, np.zeros((topics, BUCKETS)))
    return Topics(means, cluster(unit_vectors(rows, means), topics))


def topic_column(model: Topics, text: Column, lang: Column) -> Column:
    """The name of each text's topic."""

    @F.arrow_udf("string")
    def named(texts: pa.Array, langs: pa.Array) -> pa.Array:
        return pa.array([f"t{number}" for number in model.of(texts, langs)], pa.string())

    return named(text, lang)
