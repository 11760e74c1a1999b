"""Forward-backward against all labellings, learning, and held-out accuracy."""

import itertools
import zlib

import numpy as np
import pytest

from codeset.llm import line_crf
from codeset.llm.line_crf import Chain, Lines


def some_lines(lengths, width, seed):
    rng = np.random.default_rng(seed)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    return Lines(rng.normal(0, 1, (starts[-1], width)), rng.uniform(1, 9, starts[-1]), starts)


def test_marginals_equal_enumeration():
    lines = some_lines([3, 1, 5, 2], 4, 0)
    rng = np.random.default_rng(1)
    chain = Chain(rng.normal(0, 1, 4), rng.normal(0, 1, (2, 2)))
    good, pairs = chain.marginals(lines)
    want, moved = np.zeros(len(good)), np.zeros((2, 2))
    for begin, end in zip(lines.starts[:-1], lines.starts[1:]):
        emit = lines.x[begin:end] @ chain.weights
        weights = {}
        for labels in itertools.product((0, 1), repeat=int(end - begin)):
            energy = sum(e for e, y in zip(emit, labels) if y)
            energy += sum(chain.moves[a, b] for a, b in zip(labels, labels[1:]))
            weights[labels] = np.exp(energy)
        total = sum(weights.values())
        for labels, weight in weights.items():
            want[begin:end] += np.array(labels) * weight / total
            for a, b in zip(labels, labels[1:]):
                moved[a, b] += weight / total
    assert np.allclose(good, want) and np.allclose(pairs, moved)


def test_neighbours_and_features():
    lines = Lines.of(["Ab cd.\nx | y\nx | y", "", "one"])
    size = lines.x.shape[1] // 3
    assert lines.starts.tolist() == [0, 3, 4, 5]
    own, before, after = (lines.x[:, i * size : (i + 1) * size] for i in range(3))
    assert np.array_equal(before[1], own[0]) and np.array_equal(after[0], own[1])
    assert not before[[0, 3, 4]].any() and not after[[2, 3, 4]].any()
    assert lines.weight.tolist() == [7, 6, 6, 1, 4]


def test_learns_from_neighbours():
    rng = np.random.default_rng(3)
    good = rng.random(300) < 0.5
    lengths = rng.integers(1, 8, 300)
    truth = np.repeat(good, lengths)
    own = np.stack([np.ones(len(truth)), truth + rng.normal(0, 1, len(truth))], 1)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    lines = Lines.beside(own, rng.uniform(1, 9, len(truth)), starts)
    chain = line_crf.fit_chain(lines, good)
    assert ((chain.quality(lines) > 0.5) == good).mean() > 0.75
    assert chain.moves[0, 0] + chain.moves[1, 1] > chain.moves[0, 1] + chain.moves[1, 0]


def test_labels_of_hidden_lines():
    lines = Lines(np.zeros((5, 3)), np.array([4.0, 4, 2, 1, 1]), np.array([0, 3, 5]))
    found = line_crf.line_labels(lines, np.array([0, 1]), np.array([0.9, 0.6, 0.2, 0.1, 0.1]))
    assert found.tolist() == [1, 0, 0, 1, 1]  # the worst half of the first document's text


def labelled(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return docs, labels


def test_bad_lines_inside_good_documents(spark):
    """Lines of bad documents put into unseen good ones are found, and their neighbours stay good."""
    docs, labels = labelled(spark, "/root/testdata/sf0.1")
    model = line_crf.train(docs, labels)
    unseen = docs.where(line_crf.held_out("doc_id")).join(labels.where("quality = 1"), "doc_id")
    goods = [r["text"].split("\n") for r in unseen.select("text").collect() if r["text"].count("\n") >= 4]
    bads = ["BUYNOW!! CHEAP!! OFFERS!! TODAY!! ONLY!! CLICK!! HERE!! FOR!! MORE!! DEALS!!",
            "word$$$ other### the&&& thing*** in%%% this$$$ line### and&&& more***"]
    found, kept = [], []
    for i, own in enumerate(goods[:200]):
        place = len(own) // 2
        own = [*own[:place], bads[i % 2], *own[place:]]
        good, _ = model.chain.marginals(Lines.of(["\n".join(own)]))
        found.append(good[place] < 0.5)
        kept.append(np.delete(good, place).mean() > 0.5)
    assert np.mean(found) > 0.9 and np.mean(kept) > 0.95


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(line_crf, "TRAINING_DOCS", 20)
    monkeypatch.setattr(line_crf, "TRAINING_TOTAL", 10_000)
    docs, labels = labelled(spark, "/root/testdata/sf0.01")
    texts, good, counts = line_crf.training_sample(docs.unionAll(docs), labels, "doc_id", "text")
    assert 0 < len(texts) <= 40 and sum(map(len, texts)) <= 20_000
    assert len(set(texts)) >= 0.8 * len(texts) and sum(counts.values()) > 200
    plan = line_crf.score_quality(docs, labels)._jdf.queryExecution().toString()
    assert "Exchange" not in plan


def test_scores_are_calibrated(spark):
    """On unseen documents the mean score is the share of good ones."""
    docs, labels = labelled(spark, "/root/testdata/sf0.1")
    rows = line_crf.score_quality(docs, labels).where("held_out").join(
        labels.where("quality is not null"), "doc_id"
    ).select("score", "quality").collect()
    scores, quality = (np.array([r[name] for r in rows], float) for name in ("score", "quality"))
    assert abs(scores.mean() - quality.mean()) < 0.05


@pytest.fixture(scope="module")
def scored(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = line_crf.score_quality(docs, labels).collect()
    return rows, {r["doc_id"]: r["quality"] for r in labels.collect()}


def test_held_out_accuracy(scored):
    rows, quality = scored
    tested = [r for r in rows if r["held_out"] and quality.get(r["doc_id"]) is not None]
    scores = np.array([r["score"] for r in tested])
    good = np.array([quality[r["doc_id"]] == 1 for r in tested])
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    area = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    predicted = np.array([r["predicted"] == 1 for r in tested])
    print("area", area, "right", (predicted == good).mean(), "good kept", predicted[good].mean(), "bad", predicted[~good].mean(), len(good))
    assert area > 0.99
    assert (predicted == good).mean() > 0.9


def test_columns_and_folds(scored):
    rows, _ = scored
    for row in rows[:500]:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2)
        assert 0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.7)
