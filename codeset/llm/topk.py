"""Exact top-k search of integer vectors by MaxScore, in blocks of queries and shards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codeset.session import land

SHARD_ROWS = 8192
BLOCK_ROWS = 8192
QUERIES_AT_ONCE = 256
HEADS = 8  # vectors at the head of a posting list that seed the threshold
SEED_TERMS = 4
LARGEST = (1 << 63) - 1  # a score; larger ones are returned as this
PROBE_STEPS = 4  # times that the rest of the terms is probed


def integer_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, ints): floor(256 x) of each component; invalid vectors are left out."""
    component = F.col(vector)
    valid = F.forall(
        component,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")),
    )
    ints = F.transform(component, lambda x: F.floor(x.cast("double") * 256).cast("long"))
    return df.where(F.col(key).isNotNull() & component.isNotNull() & valid).select(
        F.col(key).cast("long").alias("id"), ints.alias("ints")
    )


def matrix(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors): short vectors end in zeros; of an id's rows the smallest counts."""
    ids = table.column("id").to_numpy()
    lists = table.column("ints").combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    vectors = np.zeros((len(ids), width), np.int64)
    vectors[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy()
    order = np.lexsort((*vectors.T[::-1], ids))
    ids, vectors = ids[order], vectors[order]
    first = np.concatenate([[True], ids[1:] != ids[:-1]])
    return ids[first], vectors[first]


class Shard:
    """Posting lists of each dimension, with the extremes that bound a term."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.high, self.low = vectors.max(0), vectors.min(0)
        ranked = np.argsort(vectors, axis=0, kind="stable")
        self.heads = {1: ranked[::-1][:HEADS], -1: ranked[:HEADS]}

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """The most that each term can add to a score, 0 at least."""
        return np.maximum(0, np.maximum(query * self.high, query * self.low))

    def threshold(self, query: np.ndarray, own: int, bounds: np.ndarray, k: int):
        """The k-th best score of some vectors, or None if they are fewer."""
        terms = np.argsort(-bounds, kind="stable")[:SEED_TERMS]
        rows = np.unique(
            np.concatenate([self.heads[1 if query[t] > 0 else -1][:, t] for t in terms])
        )
        rows = rows[self.ids[rows] != own]
        if len(rows) < k:
            return None
        return np.sort(self.vectors[rows] @ query)[-k]

    def search(self, own_ids: np.ndarray, queries: np.ndarray, k: int):
        """(query row, vector row, score) of each query's best k of this shard.

        A term's non-essential if the terms with the smallest bounds up to it
        cannot reach the threshold together: a vector that only they reach is
        never looked at.  The essential terms of all queries are traversed at
        once; the vectors that are still competitive are probed in the other
        terms, the largest bounds first, and dropped as soon as they are not.
        """
        bounds = np.array([self.bounds(q) for q in queries])
        floors, essential = [], np.ones(queries.shape, bool)
        for row, (own, query) in enumerate(zip(own_ids, queries)):
            floor = self.threshold(query, own, bounds[row], k)
            floor = None if floor is None else min(floor, LARGEST)
            floors.append(floor)
            if floor is not None:
                order = np.argsort(bounds[row], kind="stable")
                essential[row, order[np.cumsum(bounds[row][order]) < floor]] = False
        partial = self.vectors @ np.where(essential, queries, 0).T
        for row, (own, query) in enumerate(zip(own_ids, queries)):
            scores = partial[:, row]
            rest = np.flatnonzero(~essential[row])
            rest = rest[np.argsort(-bounds[row, rest], kind="stable")]
            others = self.ids != own
            if floors[row] is None:
                live = np.flatnonzero(others)
            else:
                live = np.flatnonzero(others & (scores + bounds[row, rest].sum() >= floors[row]))
            scores = scores[live]
            for terms in np.array_split(rest, PROBE_STEPS):
                scores = scores + self.vectors[np.ix_(live, terms)] @ query[terms]
                rest = rest[len(terms) :]
                if floors[row] is not None:
                    keep = scores + bounds[row, rest].sum() >= floors[row]
                    live, scores = live[keep], scores[keep]
            scores = np.minimum(np.maximum(scores, -LARGEST), LARGEST)
            best = np.lexsort((self.ids[live], -scores))[:k]
            yield from ((row, int(live[i]), int(scores[i])) for i in best)


def search_group(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The best k of a shard for each query of a block.

    Doubles hold the products exactly while they stay below 2^53; larger
    ones are multiplied as Python integers.  Scores beyond 63 bits count as
    the largest or smallest ones of 63 bits.
    """
    tables = (queries, candidates)
    width = max(
        (max(t.column("ints").combine_chunks().value_lengths().to_pylist(), default=0) for t in tables)
    )
    found = []
    if width and queries.num_rows and candidates.num_rows:
        (own, q), (ids, c) = (matrix(t, width) for t in tables)
        largest = width * int(np.abs(q).max()) * int(np.abs(c).max())
        kind = np.float64 if largest < 1 << 53 else object
        shard = Shard(ids, c.astype(kind))
        for at in range(0, len(own), QUERIES_AT_ONCE):
            part = slice(at, at + QUERIES_AT_ONCE)
            found += [
                (int(own[at + row]), int(ids[v]), score)
                for row, v, score in shard.search(own[part], q[part].astype(kind), k)
            ]
    elif queries.num_rows and candidates.num_rows:  # all vectors are empty
        ids = sorted(set(candidates.column("id").to_pylist()))
        for own in set(queries.column("id").to_pylist()):
            found += [(own, i, 0) for i in [i for i in ids[: k + 1] if i != own][:k]]
    columns = list(zip(*found)) or [(), (), ()]
    return pa.table(
        {n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns)}
    )


def top_k(
    vectors: DataFrame, every: int = 50, k: int = 5, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the best k of all other rows per query.

    Queries are the rows whose key is divisible by ``every``.  Vectors that
    are null or hold null or non-finite components, or have no key, take no
    part; shorter vectors count as ending in zeros; of a key's repeated rows
    the smallest vector counts; ties go to the smaller key; other columns are
    left out.  Shards and blocks have a bounded number of rows by hash of the
    key; each pair of them is one task's group, and a window merges the k of
    each shard.
    """
    ready = land(integer_vectors(vectors, key, vector), "vectors")
    queries = ready.where(F.col("id") % every == 0)
    shards = max(1, -(-ready.count() // SHARD_ROWS))
    blocks = max(1, -(-queries.count() // BLOCK_ROWS))

    def numbers(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    place = F.xxhash64("id")
    left = queries.withColumn("block", F.pmod(place, F.lit(blocks)).cast("int")).withColumn(
        "shard", numbers(shards)
    )
    right = ready.withColumn("shard", F.pmod(place, F.lit(shards)).cast("int")).withColumn(
        "block", numbers(blocks)
    )

    def search(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        return search_group(queries, candidates, k)

    found = (
        left.groupBy("shard", "block")
        .cogroup(right.groupBy("shard", "block"))
        .applyInArrow(search, "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
