"""Lexical search against a loop over all documents, and what its bounds save."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from codeset.llm import lexical, terms

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k=10):
    """(item, rank, doc, score) of (id, text) rows, one document after the other."""
    bags = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    bags = [(i, bag) for i, bag in bags if bag]
    total = sum(sum(bag.values()) for _, bag in bags)
    df = Counter(term for _, bag in bags for term in bag)
    wanted = defaultdict(set)
    for i, text in items:
        wanted[i] |= set(TERM.findall((text or "").translate(LOWER)))
    rows = []
    for item, own in wanted.items():
        scored = []
        for doc, bag in bags:
            m = 10 + 90 * sum(bag.values()) * len(bags) // total
            score = sum(
                math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m))
                for t in own if t in bag
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        scored.sort(key=lambda x: x[:3])
        rows += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(scored[:k], 1)]
    return sorted(rows, key=repr)


def found(spark, docs, items, **options):
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, lexical.search(docs, items, **options).collect()), key=repr)


def random_texts(seed, n):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "über", "x" * 30, "A1", "ab" * 6]
    return [" ".join(rng.choice(words, int(rng.integers(0, 80)) if i % 9 else 400)) for i in range(n)]


@pytest.mark.parametrize("limit", [4096, 3])
def test_equals_all_scores(spark, monkeypatch, limit):
    """Also with blocks of three documents and strata that several tasks share."""
    monkeypatch.setattr(lexical, "BLOCK_DOCS", limit)
    monkeypatch.setattr(lexical, "GROUP_DOCS", 1 << 14 if limit > 3 else 4)
    monkeypatch.setattr(lexical, "QUERY_ITEMS", 8)
    docs = list(enumerate(random_texts(1, 150)))
    docs += [(i + 500, docs[3][1]) for i in range(20)]  # ties
    items = [(i, " ".join(t.split()[:12])) for i, t in enumerate(random_texts(2, 20))]
    assert found(spark, docs, items) == brute(docs, items)


def test_awkward_rows(spark):
    docs = [(1, None), (2, ""), (3, "... !"), (4, "one Two"), (4, "one Two"), (None, "one two"), (-5, "ONE two É"), (6, "word " * 30_000)]
    items = [(1, "one É"), (2, None), (3, "nowhere"), (None, "two"), (4, "one"), (4, "WORD two"), (5, "É é")]
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, [], items) == [] and found(spark, docs, []) == []


def test_clashing_columns(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "a b"), (2, "b c c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "b c")], "item_id long, text string")
    more = {name: F.lit("x") for name in ("id", "n", "m", "terms", "tfs", "_text", "_part", "rank", "score", "item_id")}
    want = lexical.search(docs, items).collect()
    got = lexical.search(docs.withColumns(more), items.withColumns({k: v for k, v in more.items() if k != "item_id"}))
    assert got.collect() == want and len(want) == 2


def test_bounds_leave_blocks_out(spark):
    """Blocks below an item's k-th best score are not scored."""
    rare = [(i, f"common word number{i} " + "filler " * (i % 200)) for i in range(1, 600)]
    docs = spark.createDataFrame(rare, "doc_id long, text string")
    items = spark.createDataFrame([(1, "common word number7 number8")], "item_id long, text string")
    index = lexical.build(docs)
    queries = lexical.Queries(lexical.weighted_items(items, index, "item_id", "text").collect())
    floors = lexical.first_visits(index, queries, 1)
    strata = [s for batch in index.blocks.toArrow().to_batches() for s in lexical.strata_of(batch, queries)]
    open_to = sum((s.bounds >= floors).any() for s in strata)
    assert floors[0] > 1 and open_to < len(strata) / 4
    best = lexical.search(docs, items, k=1).collect()
    assert {row["doc_id"] for row in best} <= {7, 8}


def test_counted_terms():
    texts = ["", "a A b", "short seventeenletters1 é " + "z" * 100 + " ab", "ab " + "z" * 100, "exactly8 exactly8 sixteenletters16"]
    data, bounds = terms.text_bytes(pa.array(texts))
    starts, lengths, text = terms.runs(data, bounds, terms.LETTERS_AND_DIGITS)
    got = {
        (int(owner), term): int(times)
        for part in terms.count_terms(terms.LOWER[data], starts, lengths, text)
        for owner, times, term in zip(part.owner, part.times, part.terms().to_pylist())
    }
    want = {(i, t): n for i, x in enumerate(texts) for t, n in Counter(TERM.findall(x.translate(LOWER))).items()}
    assert got == want


def test_radix_order():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 63, (1000, 2)).astype(np.uint64)
    words[::3] = words[0]
    order = terms.radix_order(words)
    assert order.tolist() == sorted(range(1000), key=lambda i: (*words[i].tolist(), i))
