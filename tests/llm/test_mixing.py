"""Raking, topics and sampling against plain loops."""

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from codeset.llm import mixing, topics


def brute_rake(cells, targets, rounds=200):
    weights = dict.fromkeys(cells, 1.0)
    total = sum(cells.values())
    for _ in range(rounds):
        for i, target in enumerate(targets):
            sums = defaultdict(float)
            for cell, tokens in cells.items():
                sums[cell[i]] += tokens * weights[cell]
            for cell in cells:
                weights[cell] *= target[cell[i]] * total / sums[cell[i]]
    return weights


def natural(cells, i, power):
    sums = defaultdict(float)
    for cell, tokens in cells.items():
        sums[cell[i]] += tokens
    powers = {level: tokens**power for level, tokens in sums.items()}
    return {level: p / sum(powers.values()) for level, p in powers.items()}


@pytest.fixture(scope="module")
def cells():
    rng = np.random.default_rng(8)
    keys = [(f"s{i}", lang, topic) for i in range(6) for lang in ("en", "de", "") for topic in ("t0", "t1")]
    return {key: int(rng.integers(10, 5000)) * (20 if key[0] == "s0" else 1) for key in keys if rng.random() < 0.9}


def frame(spark, cells):
    return spark.createDataFrame([(*k, v) for k, v in cells.items()], "source string, lang string, topic string, tokens long")


@pytest.mark.parametrize("small", [0, 1000])
def test_rake_equals_loops(spark, cells, small):
    """A sample so small that no cell is taken whole, in numpy and by Spark jobs."""
    found = mixing.rake(frame(spark, cells), keep=0.01, tolerance=1e-4, small=small).collect()
    want = brute_rake(cells, [natural(cells, i, mixing.POWER) for i in range(3)])
    assert {r[:3] for r in found} == set(cells)
    for row in found:
        assert row["weight"] == pytest.approx(want[tuple(row[:3])], rel=1e-3)
        assert row["probability"] == pytest.approx(row["weight"] * 0.01, abs=1e-8)


def missed(found, wanted=None):
    return max(abs(r["share"] / r["target"] - 1) for r in mixing.achieved_shares(found, wanted).collect())


@pytest.mark.parametrize("small", [0, 1000])
def test_targets_are_met_with_whole_cells(spark, cells, small):
    """Cells at probability 1 do not keep the sample from its targets."""
    found = mixing.rake(frame(spark, cells), small=small, tolerance=1e-3)
    rows = found.collect()
    assert all(0 < r["probability"] <= 1 for r in rows) and any(r["probability"] == 1 for r in rows)
    assert missed(found) < 5e-3


def test_wanted_shares(spark, cells):
    wanted = {"lang": {"en": 0.5, "de": 0.3}, "source": {"s0": 0.4, "unknown": 0.2}}
    found = mixing.rake(frame(spark, cells), wanted)
    shares = {r["level"]: r["share"] for r in mixing.achieved_shares(found, wanted).collect()}
    assert shares["en"] == pytest.approx(0.5, rel=1e-3)
    assert shares["de"] == pytest.approx(0.3, rel=1e-3)
    assert shares[""] == pytest.approx(0.2, rel=1e-3)
    assert shares["s0"] == pytest.approx(0.4, rel=1e-3)  # no row is of the unknown source


def test_strongly_associated_sources_and_languages(spark):
    """Nearly one language per source: many slow rounds, and the targets are met."""
    off = 0.05
    cells = {
        ("a", "en", "t0"): round(60_000 * (1 - off)), ("a", "de", "t0"): round(60_000 * off),
        ("b", "en", "t0"): round(40_000 * off), ("b", "de", "t0"): round(40_000 * (1 - off)),
    }
    wanted = {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.52, "de": 0.48}}
    assert missed(mixing.rake(frame(spark, cells), wanted), wanted) < 1e-3


def test_missed_targets_are_reported(spark):
    """Each source has one language of its own, so these targets exclude each other."""
    cells = {("a", "en", "t0"): 600, ("b", "de", "t0"): 400}
    wanted = {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.7, "de": 0.3}}
    with pytest.warns(UserWarning, match="misses a target"):
        found = mixing.rake(frame(spark, cells), wanted)
    shares = {r["level"]: r["share"] for r in mixing.achieved_shares(found, wanted).collect()}
    assert shares["a"] == pytest.approx(shares["en"])


@pytest.mark.parametrize("scale", ["0.01", "0.1"])
def test_sample_meets_targets(spark, scale):
    docs = spark.read.parquet(f"/root/testdata/sf{scale}/documents.parquet")
    rows = mixing.mixture(docs).cache()
    cells = rows.groupBy(*mixing.MARGINS).agg(
        F.sum("tokens").alias("tokens"), F.first("probability").alias("probability"),
        F.sum(F.when(F.col("kept"), F.col("tokens")).otherwise(0)).alias("drawn"),
    )
    assert missed(cells) < 0.01
    total = cells.agg(F.sum("tokens"), F.sum(F.col("tokens") * F.col("probability")), F.sum("drawn")).first()
    assert total[1] / total[0] > 0.5
    assert total[2] == pytest.approx(total[1], rel=0.06)


def test_query(spark, documents, texts):
    rows = mixing.mixture(documents).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    probability = {}
    for row in rows:
        cell = (row["source"], row["lang"], row["topic"])
        assert row["tokens"] == len(texts[row["doc_id"]].split()) + 1
        assert probability.setdefault(cell, row["probability"]) == row["probability"]
    kept = {r["doc_id"] for r in rows if r["kept"]}
    again = mixing.mixture(documents.repartition(7)).where("kept").select("doc_id").collect()
    assert {r[0] for r in again} == kept
    mixed = mixing.mix(documents)
    assert mixed.columns == documents.columns
    assert {r["doc_id"] for r in mixed.collect()} == kept


def test_word_shares():
    texts = ["", "one, TWO three-three\nThree", "ünïcödé wörd wörd", "ab abc"]
    found = topics.word_shares(pa.array(texts))
    counts = [sorted(np.round(row[row > 0] ** 2, 6)) for row in found]
    assert counts == [[], [1.0], [round(1 / 3, 6), round(2 / 3, 6)], []]
    longer = pa.array(["x" * 20, *texts, "word " * 1000])
    assert np.allclose(topics.word_shares(longer)[1:5], found)


def test_topics_are_learnt_beside_the_language(spark):
    """Words of cooking and of sailing in two languages: topics go across them."""
    words = {
        ("en", 0): "butter onion pepper garlic kettle", ("en", 1): "anchor rudder harbour sailor compass",
        ("de", 0): "butter zwiebel pfeffer knoblauch kessel", ("de", 1): "anker ruder hafen matrose kompass",
    }
    common = {"en": "with that which there", "de": "nicht auch werden diese"}
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        lang, topic = ("en", "de")[i % 2], i // 2 % 2
        own = [*words[lang, topic].split() * 3, *common[lang].split() * 2]
        rows.append((i, " ".join(rng.choice(own, 40)), lang, topic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, truth int")
    model = topics.learn(docs, 4, "text", "lang")
    found = docs.withColumn("topic", topics.topic_column(model, F.col("text"), F.col("lang"))).collect()
    of = defaultdict(Counter)
    for row in found:
        of[row["topic"]][row["lang"], row["truth"]] += 1
    pure = sum(max(c.values()) for c in of.values())
    assert pure > 0.9 * len(rows)


def test_topics_are_learnt_from_all_texts(spark):
    """More texts than a sample would hold, and long ones: means and centres against plain loops."""
    rng = np.random.default_rng(5)
    words = np.array([f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(60)])
    rows = [
        (i, " ".join(rng.choice(words[i % 3 * 15 : i % 3 * 15 + 30], 12)), ("en", "de", None)[i % 7 % 3]) for i in range(2600)
    ]
    rows += [(2600 + i, f"long{'abc'[i]} " * 4000, "en") for i in range(3)] + [(2603, None, "en"), (2604, "", "en"), (2605, "rare words", "xx")]
    rows += rows[:50]  # a text that a language has again counts once
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = topics.learn(docs, 4, "text", "lang")
    order = {(r["l"], r["t"]): r["o"] for r in docs.selectExpr(
        "coalesce(lang, '') AS l", "coalesce(text, '') AS t", "xxhash64(coalesce(lang, ''), coalesce(text, '')) AS o"
    ).collect()}
    known = sorted(order, key=order.get)
    langs, shares = [lang for lang, _ in known], topics.word_shares(pa.array([text for _, text in known]))
    assert len(known) > 2500
    assert set(model.means) == {None, "", "de", "en"}
    assert np.allclose(model.means[None], shares.mean(0), atol=1e-9)
    for lang in ("", "de", "en"):
        assert np.allclose(model.means[lang], shares[[x == lang for x in langs]].mean(0), atol=1e-9)
    rest = model.rest(shares, langs)
    units = np.rint(rest / np.linalg.norm(rest, axis=1, keepdims=True) * topics.STEPS)
    like = lambda centres: np.round(units @ centres.T / topics.STEPS, 9)
    want = units[:1] / topics.STEPS
    while len(want) < 4:
        far = int(like(want).max(1).argmin())
        want = np.concatenate([want, units[far : far + 1] / topics.STEPS])
    for _ in range(topics.ROUNDS):
        of = like(want).argmax(1)
        for topic in set(of):
            sums = units[of == topic].sum(0)
            want[topic] = sums / np.linalg.norm(sums)
    assert np.allclose(model.centres, want, atol=1e-7)
    again = topics.learn(docs.repartition(7), 4, "text", "lang")
    assert np.array_equal(again.centres, model.centres)
