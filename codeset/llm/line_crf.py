"""Document quality from a linear-chain CRF that labels every line good or bad."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeset.llm.arrow import by_bytes
from codeset.operators.ranking import first_n
from codeset.session import small_frame

TRAINING_DOCS = 4000  # labelled documents per label that are learnt from, at most
TRAINING_CHARS = 50_000  # longer documents are scored, but not learnt from
TRAINING_TOTAL = 6_000_000  # characters per label that are learnt from, at most
CALIBRATION = 4  # every fourth document of the sample is not fitted, but calibrated on
BAD_SHARE = 0.5  # of a bad document's text that is bad at least
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2

_SYMBOLS = "#*$%&<>"


def line_features(line: str, earlier: set[str]) -> tuple[float, ...]:
    """What a line looks like; ``earlier`` has the lines before it."""
    words = line.split()
    count = len(words)
    if not count:
        return (1.0, 1.0) + (0.0,) * 17
    chars = len(line)
    lengths = [len(word) for word in words]
    letters = sum(lengths)
    return (
        1.0,
        0.0,
        min(count, 60) / 60,
        min(count, 4) / 4,
        letters / count / 10,
        max(lengths) / 30,
        len(set(words)) / count,
        sum(map(eq, words, words[1:])) / count,
        sum(map(str.isupper, words)) / count,
        sum(map(line.count, _SYMBOLS)) / letters,
        line.count("|") / count,
        line.count("!") / count,
        (line.count(",") + line.count(".")) / count,
        sum(map(line.count, "0123456789")) / letters,
        sum(lengths.count(n) for n in (1, 2, 3)) / count,
        float(line.rstrip()[-1] in ".!?"),
        float(line in earlier),
        float("@" in line or "://" in line),
        np.log1p(chars) / 10,
    )


def document_lines(text: str) -> tuple[list[tuple[float, ...]], list[int]]:
    """Features and characters of every line; an empty text has one empty line."""
    features, weights, earlier = [], [], set()
    for line in text.split("\n"):
        features.append(line_features(line, earlier))
        weights.append(len(line) + 1)
        earlier.add(line)
    return features, weights


@dataclass
class Lines:
    """Lines of several documents one below the other, with their neighbours' features."""

    x: np.ndarray
    weight: np.ndarray
    starts: np.ndarray  # first line of each document, and the end

    @classmethod
    def of(cls, texts: list[str]) -> Lines:
        features, weights, starts = [], [], [0]
        for text in texts:
            own, chars = document_lines(text)
            features += own
            weights += chars
            starts.append(len(features))
        own = np.array(features).reshape(len(features), -1)
        return cls.beside(own, np.array(weights, float), np.array(starts))

    @classmethod
    def beside(cls, own: np.ndarray, weight: np.ndarray, starts: np.ndarray) -> Lines:
        """Lines with their own features and those of the lines before and after."""
        first = np.zeros(len(own) + 1, bool)
        first[starts] = True
        before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
        before[first[:-1]] = 0
        after[first[1:]] = 0
        return cls(np.hstack([own, before, after]), weight, starts)

    def share(self, values: np.ndarray) -> np.ndarray:
        """The mean of a value of each document's lines, weighted by their length."""
        sums = np.add.reduceat(np.stack([values * self.weight, self.weight]), self.starts[:-1], axis=1)
        return sums[0] / sums[1]


@dataclass
class Chain:
    """Weights of line features for "good", and of (label, next label)."""

    weights: np.ndarray
    moves: np.ndarray

    def marginals(self, lines: Lines):
        """(P(good) per line, summed P(label, next label)) by forward-backward.

        Documents take their steps side by side, the longest first.
        """
        emit = np.stack([np.zeros(len(lines.x)), lines.x @ self.weights], 1)
        lengths = np.diff(lines.starts)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = lines.starts[:-1][order], lengths[order]
        live = np.searchsorted(-lengths, -np.arange(lengths.max(initial=0)), "left")
        forward = emit.copy()
        for step in range(1, len(live)):
            at = starts[: live[step]] + step
            forward[at] += np.logaddexp(
                forward[at - 1, :1] + self.moves[0], forward[at - 1, 1:] + self.moves[1]
            )
        backward = np.zeros_like(emit)
        for step in range(len(live) - 1, 0, -1):
            at = starts[: live[step]] + step
            ahead = emit[at] + backward[at]
            backward[at - 1] = np.logaddexp(
                ahead[:, :1] + self.moves[:, 0], ahead[:, 1:] + self.moves[:, 1]
            )
        both = forward + backward
        total = np.logaddexp(both[:, 0], both[:, 1])
        pairs = np.zeros((2, 2))
        inner = np.ones(len(emit), bool)
        inner[lines.starts[:-1]] = False
        at = np.flatnonzero(inner)
        for a in (0, 1):
            for b in (0, 1):
                joint = forward[at - 1, a] + self.moves[a, b] + emit[at, b] + backward[at, b]
                pairs[a, b] = np.exp(joint - total[at]).sum()
        return np.exp(both[:, 1] - total), pairs

    def quality(self, lines: Lines) -> np.ndarray:
        """The mean P(good) of each document's lines, weighted by their length."""
        return lines.share(self.marginals(lines)[0])


def fit_labels(
    lines: Lines, labels: np.ndarray, rounds: int, chained: bool = True, decay: float = 1e-3
) -> Chain:
    """Maximum likelihood of the lines' labels by gradient steps (Adam)."""
    size = lines.x.shape[1]
    moved = np.zeros((2, 2))
    inner = np.ones(len(labels), bool)
    inner[lines.starts[:-1]] = False
    at = np.flatnonzero(inner)
    np.add.at(moved, (labels[at - 1].astype(int), labels[at].astype(int)), 1)
    theta, mean, square = np.zeros(size + 4), np.zeros(size + 4), np.zeros(size + 4)
    for step in range(1, rounds + 1):
        if chained:
            p, pairs = Chain(theta[:size], theta[size:].reshape(2, 2)).marginals(lines)
        else:
            p, pairs = 1 / (1 + np.exp(-np.clip(lines.x @ theta[:size], -30, 30))), moved
        gradient = np.concatenate([lines.x.T @ (labels - p), (moved - pairs).ravel()])
        gradient = gradient / len(labels) - decay * theta
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        theta += 0.2 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Chain(theta[:size], theta[size:].reshape(2, 2))


def line_labels(lines: Lines, good: np.ndarray, p: np.ndarray) -> np.ndarray:
    """1 for the lines of good documents and for those of bad ones that look good.

    In each bad document the lines that look worst are bad all the same, so
    many that they hold ``BAD_SHARE`` of its text.
    """
    document = np.repeat(np.arange(len(good)), np.diff(lines.starts))
    order = np.lexsort((p, document))
    weight = lines.weight[order]
    before = np.cumsum(weight) - weight
    total = np.add.reduceat(lines.weight, lines.starts[:-1])
    share = (before - before[lines.starts[:-1]][document]) / total[document]
    worst = np.empty(len(p), bool)
    worst[order] = share < BAD_SHARE
    bad = (good[document] == 0) & (worst | (p < 0.5))
    return (~bad).astype(float)


def spliced(lines: Lines, good: np.ndarray, labels: np.ndarray) -> tuple[Lines, np.ndarray]:
    """The documents, and as many good ones into which lines of bad ones were put.

    Labelled documents are mostly good or bad throughout.  The chain has to
    learn as well that a few bad lines may stand inside a good text.
    """
    own = lines.x.shape[1] // 3
    goods, bads = np.flatnonzero(good == 1), np.flatnonzero(good == 0)
    rows, starts = [np.arange(len(labels))], lines.starts.tolist()
    for k in range(max(len(goods), len(bads)) if len(goods) and len(bads) else 0):
        a, b = lines.starts[goods[k % len(goods)]], lines.starts[goods[k % len(goods)] + 1]
        c, d = lines.starts[bads[k % len(bads)]], lines.starts[bads[k % len(bads)] + 1]
        bad = c + np.flatnonzero(labels[c:d] == 0)
        put = bad[k % len(bad) :][: 1 + k % 3]
        place = a + k * 7919 % (b - a + 1)
        rows += [np.arange(a, place), put, np.arange(place, b)]
        starts.append(starts[-1] + int(b - a) + len(put))
    rows = np.concatenate(rows)
    mixed = Lines.beside(lines.x[rows, :own], lines.weight[rows], np.array(starts))
    return mixed, labels[rows]


def fit_chain(lines: Lines, good: np.ndarray, rounds: int = 120) -> Chain:
    """Learn from documents' labels while those of their lines are hidden.

    Lines of good documents are good.  Which lines of bad ones are bad is
    first guessed from the lines' own features, without their neighbours, and
    then from the chain that was learnt from this guess, which is fitted anew.
    """
    own = lines.x.shape[1] // 3
    alone = Lines(lines.x[:, :own], lines.weight, lines.starts)
    labels = np.repeat(good.astype(float), np.diff(lines.starts))
    energy = alone.x @ fit_labels(alone, labels, rounds, chained=False).weights
    labels = line_labels(lines, good, 1 / (1 + np.exp(-np.clip(energy, -30, 30))))
    chain = fit_labels(*spliced(lines, good, labels), rounds)
    labels = line_labels(lines, good, chain.marginals(lines)[0])
    return fit_labels(*spliced(lines, good, labels), rounds)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return np.log(p / (1 - p))


def calibration(quality: np.ndarray, good: np.ndarray, weight: np.ndarray, rounds: int = 50):
    """(slope, offset) that turn the mean marginal into a probability, by Newton steps."""
    x = np.stack([_logit(quality), np.ones(len(quality))], 1)
    theta = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        gradient = x.T @ (weight * (good - p)) - 1e-3 * theta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        theta = theta + np.clip(np.linalg.solve(curve, gradient), -1, 1)
    return theta


@dataclass
class Model:
    chain: Chain
    slope: float
    offset: float

    def score(self, texts: list[str]) -> np.ndarray:
        raw = self.slope * _logit(self.chain.quality(Lines.of(texts))) + self.offset
        return 1 / (1 + np.exp(-np.clip(raw, -700, 700)))


def held_out(key: str) -> Column:
    fold = F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def training_sample(
    docs: DataFrame, labels: DataFrame, key: str, text: str
) -> tuple[list[str], np.ndarray, dict[int, int]]:
    """(texts, labels, documents per label) of a bounded sample outside the held-out fold.

    The first ``TRAINING_DOCS`` documents of each label by hash of the key,
    with texts of at most ``TRAINING_CHARS`` and ``TRAINING_TOTAL`` together.
    They are chosen by keys, lengths and hashes alone; then one scan fetches
    the chosen texts by a broadcast of their keys, each text once.
    """
    known = (
        labels.where("quality in (0, 1)").groupBy(key).agg(F.min("quality").alias("quality"))
    ).where(~held_out(key))
    source = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where(
        F.char_length("_text") <= TRAINING_CHARS
    )
    source = source.withColumn("_print", F.xxhash64("_text"))
    short = source.select("_key", "_print", F.char_length("_text").alias("_chars"))
    named = known.select(F.col(key).alias("_key"), "quality")
    rows = short.join(named, "_key").withColumn("_order", F.xxhash64("_key"))
    chosen = first_n(rows, ["quality"], ["_order", "_key", "_print"], TRAINING_DOCS, "_place")
    counts = {row["quality"]: row["count"] for row in named.groupBy("quality").count().collect()}
    wanted, chars = [], {0: 0, 1: 0}
    for row in sorted(chosen.collect(), key=lambda row: row["_place"]):
        chars[row["quality"]] += row["_chars"]
        if chars[row["quality"]] <= TRAINING_TOTAL:
            wanted.append((row["_key"], row["_print"], row["quality"]))
    kind = docs.schema[key].dataType.simpleString()
    table = small_frame(docs.sparkSession, wanted, f"_key {kind}, _print long, quality int")
    found = (
        source.join(F.broadcast(table), ["_key", "_print"])
        .groupBy("_key", "_print").agg(F.first("quality").alias("quality"), F.first("_text").alias("text"))
        .orderBy(F.xxhash64("_key"), "_print")
        .collect()
    )
    return [row["text"] for row in found], np.array([row["quality"] for row in found]), counts


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model | None:
    """Learn from a bounded sample of labelled documents outside the held-out fold.

    Of each label every fourth document is kept from the fit, for the
    calibration, which weighs the labels as often as they occur.  None if one
    label does not occur.
    """
    texts, good, counts = training_sample(docs, labels, key, text)
    if not 0 < good.sum() < len(good):
        return None
    place = np.where(good == 1, np.cumsum(good), np.cumsum(1 - good)) - 1
    kept_back = place % CALIBRATION == CALIBRATION - 1
    fitted = ~kept_back
    if len(set(good[kept_back].tolist())) < 2:  # too few to keep some back
        kept_back = fitted = np.ones(len(good), bool)
    chain = fit_chain(Lines.of([t for t, f in zip(texts, fitted) if f]), good[fitted])
    unseen = good[kept_back]
    share = {label: counts[label] / max(1, int((unseen == label).sum())) for label in (0, 1)}
    weight = np.where(unseen == 1, share[1], share[0]) / sum(counts.values()) * len(unseen)
    quality = chain.quality(Lines.of([t for t, k in zip(texts, kept_back) if k]))
    slope, offset = calibration(quality, unseen, weight)
    return Model(chain, float(slope), float(offset))


def score_quality(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, held_out, score, predicted) of every row, from its whole text alone.

    Lines are cut at line ends; null texts count as empty ones, which have one
    empty line.  Without labels of both kinds every score is 0.5.  Repeated
    rows are scored each; rows with a null key are not held out; other columns
    are left out.
    """
    model = train(docs, labels, key, text)
    source = docs.select(
        key, held_out(key).alias("held_out"), F.coalesce(text, F.lit("")).alias("_text")
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "_text"):
            texts = batch.column("_text").to_pylist()
            scores = model.score(texts) if model else np.full(len(texts), 0.5)
            predicted = pa.array((scores >= THRESHOLD).astype(np.int32))
            columns = [batch.column(key), batch.column("held_out"), pa.array(scores), predicted]
            yield pa.RecordBatch.from_arrays(columns, [key, "held_out", "score", "predicted"])

    kind = docs.schema[key].dataType.simpleString()
    return source.mapInArrow(
        score, f"`{key}` {kind}, held_out boolean, score double, predicted int"
    )
