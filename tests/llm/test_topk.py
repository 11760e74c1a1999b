"""MaxScore against all inner products."""

import math

import numpy as np
import pytest

import check_oracle
from codeset.llm import topk


def brute(rows, every, k):
    vectors = {}
    for key, vector in rows:
        if key is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        ints = [math.floor(256 * x) for x in vector]
        vectors[key] = min(vectors.get(key, ints), ints)
    found = []
    for q in sorted(key for key in vectors if key % every == 0):
        scored = sorted(
            (-sum(a * b for a, b in zip(vectors[q], v)), key) for key, v in vectors.items() if key != q
        )
        found += [(q, i + 1, key, -score) for i, (score, key) in enumerate(scored[:k])]
    return found


def run(spark, rows, every, k):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return sorted(map(tuple, topk.top_k(df, every, k).collect()))


def test_random_vectors_in_many_shards(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 200)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 20)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.3, 16).tolist()) for i in range(900)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # copies tie
    assert run(spark, rows, 10, 5) == brute(rows, 10, 5)


def test_sparse_and_negative(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(0, 1, 12) * (rng.random(12) < 0.2)).tolist()) for i in range(300)]
    rows += [(-50 - i, (-np.abs(rng.normal(0, 1, 12))).tolist()) for i in range(60)]
    assert run(spark, rows, 10, 3) == brute(rows, 10, 3)


def test_awkward_vectors(spark):
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (10, [1.0, -2.0, 0.5]), (20, []), (3, [0.1]), (4, None),
        (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 1.0]),
        (30, [0.0, 0.0]), (8, [5.0, 5.0]), (8, [4.0, 9.0]),
    ]
    assert run(spark, rows, 10, 5) == brute(rows, 10, 5)
    assert run(spark, [(1, [1.0])], 10, 5) == []
    assert run(spark, [], 10, 5) == []
    assert run(spark, [(0, []), (1, []), (2, [])], 2, 5) == brute([(0, []), (1, []), (2, [])], 2, 5)


def test_large_components(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(0, 1, 4) * 2.0**20).tolist()) for i in range(100)]
    assert run(spark, rows, 10, 5) == brute(rows, 10, 5)


def test_scores_beyond_a_long(spark):
    """They count as the largest ones, equal to each other, also in several shards."""
    big, top = 2.0**25, (1 << 63) - 1
    rows = [(0, [big, big]), (1, [big, 2 * big]), (2, [3 * big, big]), (3, [-big, -big]), (4, [1.0, 1.0])]
    found = run(spark, rows, 10, 5)
    assert [(q, v, s) for q, _, v, s in found] == [
        (0, 1, top), (0, 2, top), (0, 4, 2 * (1 << 33) * 256), (0, 3, -top)
    ]


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_query_equals_sql(spark, scale):
    sf_dir = f"/root/testdata/sf{scale}"
    database = check_oracle.connect(sf_dir)
    rows, _, problem = check_oracle.compare(spark, database, "op2_topk_search", sf_dir)
    assert problem is None and rows == 50


def test_terms_are_skipped():
    """With one strong term the others are not essential."""
    vectors = np.zeros((50, 4))
    vectors[:, 0], vectors[:, 1:] = np.arange(50) * 100, 1
    shard = topk.Shard(np.arange(50), vectors)
    query = np.array([10.0, 1, 1, 1])
    bounds = shard.bounds(query)
    floor = shard.threshold(query, -1, bounds, 5)
    assert bounds[1:].sum() < floor
    found = list(shard.search(np.array([-1]), query[None], 5))
    assert [v for _, v, _ in found] == [49, 48, 47, 46, 45]
