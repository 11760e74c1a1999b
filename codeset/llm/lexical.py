"""Ranked lexical search over an index of documents of equal length norm."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeset.llm.arrow import by_bytes
from codeset.llm.terms import LETTERS_AND_DIGITS, LOWER, count_terms, runs, text_bytes
from codeset.llm.tokens import positions
from codeset.session import land

# Fixed values of the score.
SCALE = 1_000_000_000
NORM, NORM_SHARE = 100, 90  # an average document's norm, and the share its length decides
TF_SCALE, NORM_SCALE = 1000, 8

K = 10
BAG_BYTES = 4 << 20  # of text whose terms are counted at a time
GROUP_DOCS = 1 << 14  # of a stratum, that one task indexes, about
BLOCK_DOCS = 4096  # documents of a block, at most
BLOCK_POSTINGS = 1 << 18  # after which a block is closed
POSTINGS_AT_ONCE = 1 << 21  # that are added up at a time
QUERY_ITEMS = 1024  # that one scan of the index answers


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n, terms, tfs): each document's terms with their occurrences."""
    for batch in by_bytes(batches, "_text", BAG_BYTES):
        data, bounds = text_bytes(batch.column("_text"))
        starts, lengths, text = runs(data, bounds, LETTERS_AND_DIGITS)
        parts = count_terms(LOWER[data], starts, lengths, text)
        size = batch.num_rows
        if parts:
            owner = np.concatenate([part.owner for part in parts])
            order = np.argsort(owner, kind="stable")
            terms = pa.concat_arrays([part.terms() for part in parts]).take(pa.array(order))
            tfs = np.concatenate([part.times for part in parts])[order]
            each = np.bincount(owner, minlength=size)
        else:
            terms, tfs, each = pa.array([], pa.string()), np.zeros(0), np.zeros(size, np.int64)
        offsets = pa.array(np.concatenate([[0], np.cumsum(each)]).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"), pa.array(np.bincount(text, minlength=size).astype(np.int64)),
                pa.ListArray.from_arrays(offsets, terms),
                pa.ListArray.from_arrays(offsets, pa.array(tfs.astype(np.int32))),
            ],
            ["id", "n", "terms", "tfs"],
        )


def bags(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(id, n, terms, tfs) of the rows that have a term, landed."""
    source = rows.select(
        F.col(key).cast("long").alias("id"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"),
    )
    found = source.mapInArrow(counted, "id long, n long, terms array<string>, tfs array<int>")
    return land(found.where("n > 0"), "bags")


def norm(docs: int, total: int) -> Column:
    """The normaliser of a document of ``n`` terms."""
    share = f"({NORM_SHARE} * n * cast({docs} as long)) div cast({max(1, total)} as long)"
    return F.expr(f"{NORM - NORM_SHARE} + {share}")


class Block:
    """Documents of one norm: for each term its postings, by occurrences."""

    def __init__(self):
        self.ids, self.terms, self.tfs, self.sizes, self.postings = [], [], [], [], 0

    def add(self, id_: int | None, terms: pa.Array, tfs: np.ndarray) -> None:
        self.ids.append(id_)
        self.terms.append(terms)
        self.tfs.append(tfs)
        self.sizes.append(len(terms))
        self.postings += len(terms)

    def full(self) -> bool:
        return len(self.ids) >= BLOCK_DOCS or self.postings >= BLOCK_POSTINGS

    def row(self, m: int) -> pa.RecordBatch:
        """(m, ids, terms, heads, tfs, ends, slots, peaks).

        The groups of term t are ``heads[t]`` to ``heads[t + 1]``; group g has
        ``tfs[g]`` and the slots up to ``ends[g]``; ``peaks[t]`` is the largest
        tf of the term.
        """
        coded = pa.concat_arrays(self.terms).dictionary_encode()
        names = coded.dictionary
        slot = np.repeat(np.arange(len(self.ids)), self.sizes)
        term, tf = coded.indices.to_numpy(), np.concatenate(self.tfs)
        order = np.lexsort((slot, tf, term))
        term, tf, slot = term[order], tf[order], slot[order]
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])
        first = np.flatnonzero(new)
        heads = np.searchsorted(term[first], np.arange(len(names) + 1))
        columns = {
            "heads": heads, "group_tfs": tf[first], "ends": np.append(first[1:], len(term)),
            "slots": slot, "peaks": tf[first][heads[1:] - 1],
        }
        arrays = [pa.array([m], pa.int64()), pa.array([self.ids], pa.list_(pa.int64()))]
        arrays.append(pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names))
        for values in columns.values():
            held = pa.array(values.astype(np.int32))
            arrays.append(pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held))
        return pa.RecordBatch.from_arrays(arrays, ["m", "ids", "terms", *columns])


INDEX_SCHEMA = (
    "m long, ids array<long>, terms array<string>, heads array<int>, group_tfs array<int>, "
    "ends array<int>, slots array<int>, peaks array<int>"
)


def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows that come by norm; a block is closed before it grows large.

    A document's terms come as lines of one string, which is smaller to move
    than an array.
    """
    block, stratum = Block(), None
    for batch in batches:
        ids, norms = batch.column("id").to_pylist(), batch.column("m").to_pylist()
        terms = pc.split_pattern(batch.column("terms"), "\n")
        tfs = batch.column("tfs").flatten().to_numpy()
        cuts = terms.offsets.to_numpy() - terms.offsets[0].as_py()
        names = terms.flatten()
        for i, (id_, m) in enumerate(zip(ids, norms)):
            if block.ids and (m != stratum or block.full()):
                yield block.row(stratum)
                block = Block()
            stratum = m
            own = slice(int(cuts[i]), int(cuts[i + 1]))
            block.add(id_, names[own], tfs[own])
    if block.ids:
        yield block.row(stratum)


@dataclass
class Index:
    """An index of all documents, and what its scores depend on."""

    blocks: DataFrame  # INDEX_SCHEMA, a row per block
    bags: DataFrame
    docs: int  # with at least one term
    total: int  # terms of all documents


def build(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Index:
    """Index every row: strata of documents of equal norm, in blocks.

    Strata are dealt by hash of the norm, so the few long documents of high
    norms do not meet in one task.  A stratum of more than ``GROUP_DOCS`` is
    shared by tasks; the table of these is broadcast, with at most one row
    per ``GROUP_DOCS`` documents.  Each task turns its rows into blocks as
    they come.
    """
    held = bags(docs, key, text)
    row = held.agg(F.count(F.lit(1)), F.sum("n")).first()
    count, total = row[0], row[1] or 0
    normed = held.withColumn("m", norm(count, total))
    large = normed.groupBy("m").count().where(F.col("count") > GROUP_DOCS).select(
        "m", F.ceil(F.col("count") / GROUP_DOCS).alias("_parts")
    )
    part = F.pmod(F.xxhash64("id", "n"), F.coalesce("_parts", F.lit(1)))
    dealt = (
        normed.join(F.broadcast(large), "m", "left")
        .select("id", "m", F.array_join("terms", "\n").alias("terms"), "tfs", part.alias("_part"))
        .repartition("m", "_part").sortWithinPartitions("m", "_part")
        .select("id", "m", "terms", "tfs")
    )
    blocks = land(dealt.mapInArrow(indexed, INDEX_SCHEMA), "lexical-index")
    return Index(blocks, held, count, total)


def weighted_items(items: DataFrame, index: Index, key: str, text: str) -> DataFrame:
    """(id, terms, weights) of each item's terms that some document holds, landed.

    Rows of one item are one item with the terms of all.  Terms are counted
    before they are joined, so the shuffle has each task's vocabulary once.
    """
    wanted = bags(items, key, text).select("id", F.explode("terms").alias("term")).distinct()
    found = index.bags.select(F.explode("terms").alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("df")
    )
    ratio = F.lit(float(2 * index.docs + 2)) / (F.col("df") * 2 + 1).cast("double")
    weight = F.floor(F.ln(ratio) * 1000).cast("long")
    pairs = wanted.join(found, "term").select("id", F.struct("term", weight.alias("w")).alias("pair"))
    grouped = pairs.groupBy("id").agg(F.array_sort(F.collect_list("pair")).alias("pairs"))
    return land(
        grouped.select("id", F.col("pairs.term").alias("terms"), F.col("pairs.w").alias("weights")),
        "search-items",
    )


class Queries:
    """A block of items, their terms numbered, as rows of (term, weight)."""

    def __init__(self, rows: list):
        self.ids = [row["id"] for row in rows]
        terms = [term for row in rows for term in row["terms"]]
        coded = pa.array(terms, pa.string()).dictionary_encode()
        self.vocabulary = coded.dictionary
        self.terms = coded.indices.to_numpy()
        self.weights = np.array([w for row in rows for w in row["weights"]], np.int64)
        self.sizes = np.array([len(row["terms"]) for row in rows])
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])

    def bounds(self, impacts: np.ndarray) -> np.ndarray:
        """The most that a document can score, from the largest impact of each term."""
        return np.add.reduceat(self.weights * impacts[self.terms], self.starts[:-1])


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    tf = tf.astype(np.int64)
    return SCALE * tf // (TF_SCALE * tf + NORM_SCALE * m)


class Stratum:
    """The postings of one block that a block of queries may touch."""

    def __init__(self, row: dict, queries: Queries):
        self.m, self.row = row["m"], row
        places = pc.index_in(row["terms"].values, value_set=queries.vocabulary)
        known = np.flatnonzero(places.is_valid().to_numpy(zero_copy_only=False))
        self.term_of = np.full(len(queries.vocabulary), -1)
        self.term_of[places.take(pa.array(known)).to_numpy()] = known
        peaks = np.zeros(len(queries.vocabulary), np.int64)
        peaks[self.term_of >= 0] = impact(
            row["peaks"].values.to_numpy()[self.term_of[self.term_of >= 0]], self.m
        )
        self.bounds = queries.bounds(peaks)
        self.opened = False

    def open(self) -> None:
        """Impacts, once for each (term, tf), spread over their postings."""
        row = self.row
        self.ids = row["ids"].values
        self.heads, ends = row["heads"].values.to_numpy(), row["ends"].values.to_numpy()
        self.slots = row["slots"].values.to_numpy()
        sizes = np.diff(ends, prepend=0)
        self.impacts = np.repeat(impact(row["group_tfs"].values.to_numpy(), self.m), sizes)
        self.ends = np.concatenate([[0], ends])
        self.opened = True

    def scores(self, queries: Queries, items: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(some of the items, their scores of all documents of the block)."""
        if not self.opened:
            self.open()
        sizes = queries.sizes[items]
        entries = positions(queries.starts[items], sizes)
        term = self.term_of[queries.terms[entries]]
        row = np.repeat(np.arange(len(items)), sizes)[term >= 0]
        weights, term = queries.weights[entries][term >= 0], term[term >= 0]
        begins = self.ends[self.heads[term]]
        counts = self.ends[self.heads[term + 1]] - begins
        work = np.concatenate([[0], np.cumsum(np.bincount(row, counts, len(items)))])
        first, width = 0, len(self.ids)
        while first < len(items):
            last = max(first + 1, int(np.searchsorted(work, work[first] + POSTINGS_AT_ONCE, "right")) - 1)
            last = min(last, first + max(1, POSTINGS_AT_ONCE // width))
            a, b = np.searchsorted(row, [first, last])
            at = positions(begins[a:b], counts[a:b])
            cell = np.repeat(row[a:b] - first, counts[a:b]) * width + self.slots[at]
            added = np.repeat(weights[a:b], counts[a:b]) * self.impacts[at]
            size = (last - first) * width
            if self.bounds.max() < 1 << 53:  # doubles hold the sums exactly
                sums = np.bincount(cell, added, size).astype(np.int64)
            else:
                sums = np.zeros(size, np.int64)
                np.add.at(sums, cell, added)
            yield items[first:last], sums.reshape(-1, width)
            first = last

    def best(self, queries: Queries, items: np.ndarray, k: int, floors: np.ndarray, found: list) -> None:
        """Add (score, id) of the documents that may be among the items' best k to ``found``.

        ``floors`` rise with the k-th best of an item.
        """
        for some, sums in self.scores(queries, items):
            rows, slots = np.nonzero(sums >= np.maximum(1, floors[some])[:, None])
            cuts = np.searchsorted(rows, np.arange(len(some) + 1))
            for i in np.flatnonzero(np.diff(cuts)).tolist():
                live = slots[cuts[i] : cuts[i + 1]]
                score = sums[i, live]
                if len(live) > k:
                    cut = np.partition(score, len(live) - k)[len(live) - k]
                    live, score = live[score >= cut], score[score >= cut]
                ids = self.ids.take(pa.array(live)).to_pylist()
                item = int(some[i])
                found[item] = best_of(found[item] + list(zip(score.tolist(), ids)), k)
                if len(found[item]) == k:
                    floors[item] = max(floors[item], found[item][-1][0])


def best_of(found: list[tuple[int, int | None]], k: int) -> list[tuple[int, int | None]]:
    """The k highest scores, ties to the smaller id, null ids last."""
    return sorted(found, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]


def strata_of(batch: pa.RecordBatch, queries: Queries) -> list[Stratum]:
    columns = {name: batch.column(name) for name in batch.schema.names}
    return [
        Stratum({name: column[i] if name != "m" else column[i].as_py() for name, column in columns.items()}, queries)
        for i in range(batch.num_rows)
    ]


def hits(found: list[list], queries: Queries) -> pa.RecordBatch:
    rows = [(queries.ids[i], id_, score) for i, own in enumerate(found) for score, id_ in own]
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], ["item_id", "doc_id", "score"]
    )


HITS = "item_id long, doc_id long, score long"


def first_visits(index: Index, queries: Queries, k: int) -> np.ndarray:
    """A score per item that its k-th best reaches at least.

    Each batch of blocks visits, for each item, the block with the highest
    bound alone; of all these documents the k-th best is taken.
    """

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strata = strata_of(batch, queries)
            if not strata:
                continue
            highest = np.argmax([s.bounds for s in strata], axis=0)
            found = [[] for _ in queries.ids]
            floors = np.ones(len(queries.ids), np.int64)
            for s in np.unique(highest).tolist():
                strata[s].best(queries, np.flatnonzero(highest == s), k, floors, found)
            yield hits(found, queries)

    order = Window.partitionBy("item_id").orderBy(F.desc("score"))
    rows = (
        index.blocks.mapInArrow(visit, HITS)
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k)
        .select("item_id", "score").collect()  # a row per item of the block
    )
    floors = {row["item_id"]: row["score"] for row in rows}
    return np.array([floors.get(id_, 1) for id_ in queries.ids], np.int64)


def search_block(index: Index, queries: Queries, k: int) -> DataFrame:
    """(item_id, doc_id, score): the best k of each task for a block of items.

    Blocks are visited by falling bounds, each for the items whose bound
    reaches the score of their k-th best so far; the first such score comes
    from ``first_visits``.
    """
    floors = first_visits(index, queries, k)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rising = [[] for _ in queries.ids], floors.copy()
        for batch in batches:
            strata = strata_of(batch, queries)
            for stratum in sorted(strata, key=lambda s: -s.bounds.max()):
                open_to = np.flatnonzero(stratum.bounds >= rising)
                if len(open_to):
                    stratum.best(queries, open_to, k, rising, found)
        yield hits(found, queries)

    return index.blocks.mapInArrow(visit, HITS)


def search(
    docs: DataFrame, items: DataFrame, k: int = K,
    key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item.

    Null texts have no terms; items without a term that a document holds have
    no rows; rows of one item id are one item; repeated document rows count
    each; equal scores go to the smaller doc_id, null ids last; documents of
    score 0 are left out, as are other columns.  Items are answered in blocks
    of ``QUERY_ITEMS``: a block's terms travel to the tasks, the index does
    not move.
    """
    index = build(docs, key, text)
    wanted = weighted_items(items, index, item_key, item_text)
    blocks = max(1, -(-wanted.count() // QUERY_ITEMS))
    block_of = F.pmod(F.xxhash64("id"), F.lit(blocks))
    found = None
    for number in range(blocks):
        rows = wanted.where(block_of == number).collect()  # about QUERY_ITEMS
        if rows:
            part = search_block(index, Queries(rows), k)
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], HITS)
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )
