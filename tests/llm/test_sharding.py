"""The curve, the law of rows and the use of the manifest."""

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from codeset.llm import sharding


@pytest.mark.parametrize("dimensions, bits", [(2, 3), (3, 2), (3, 3), (4, 2)])
def test_curve_visits_each_cell_in_steps_of_one(spark, dimensions, bits):
    size = 1 << bits
    names = [f"c{i}" for i in range(dimensions)]
    cells = spark.range(size**dimensions).select(
        *(F.expr(f"cast(id div {size**i} % {size} as int)").alias(n) for i, n in enumerate(names))
    )
    rows = sharding.with_curve(cells, names, bits).orderBy("curve").collect()
    assert [row["curve"] for row in rows] == list(range(size**dimensions))
    points = [tuple(row[n] for n in names) for row in rows]
    assert len(set(points)) == len(points)
    for a, b in zip(points, points[1:]):
        assert sum(abs(x - y) for x, y in zip(a, b)) == 1


def test_query(documents, texts):
    sharded = sharding.shard_documents(documents)
    rows = sharded.collect()
    assert sorted(row["doc_id"] for row in rows) == sorted(texts)
    shards, groups = defaultdict(list), defaultdict(set)
    for row in rows:
        text = texts[row["doc_id"]].encode()
        assert row["size"] == len(text) + 1 and row["text_crc32"] == zlib.crc32(text)
        assert row["law"] == "rows" and row["grown_shard"] is None
        shards[row["shard"]].append(row)
        groups[text].add(row["shard"])
    assert shards.keys() == set(range(8))
    counts = [len(own) for own in shards.values()]
    assert max(counts) - min(counts) <= 1
    ordered = [row["curve"] for s in range(8) for row in sorted(shards[s], key=lambda r: r["slot"])]
    assert ordered == sorted(ordered)
    for own in shards.values():
        assert sorted(row["slot"] for row in own) == list(range(len(own)))
    assert sum(len(where) - 1 for where in groups.values()) <= 7


def test_few_rows_and_copies(spark, awkward):
    rows = sharding.shard_documents(awkward).collect()
    counts = Counter(row["shard"] for row in rows)
    assert len(rows) == 10 and max(counts.values()) - min(counts.values()) <= 1
    slots = [(row["shard"], row["slot"]) for row in rows]
    assert len(set(slots)) == 10


def test_pruning_keeps_what_matches(spark, documents):
    sharded = sharding.shard_documents(documents)
    manifest = sharding.shard_manifest(sharded)
    where = {r["doc_id"]: r["shard"] for r in sharded.collect()}
    for source, lang in [("src0", "en"), ("src3", "fr"), ("src5", "de")]:
        read = {r["shard"] for r in sharding.shards_to_read(manifest, source=source, lang=lang).collect()}
        ids = documents.where((F.col("source") == source) & (F.col("lang") == lang)).collect()
        assert {where[row["doc_id"]] for row in ids} <= read
    assert len(sharding.shards_to_read(manifest, size=1 << 40).collect()) == 0
