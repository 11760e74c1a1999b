"""Documents cut and packed into training sequences with little padding."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeset.llm.arrow import by_bytes
from codeset.llm.cutting_stock import patterns_for
from codeset.llm.tokens import encoder
from codeset.operators.ranking import numbered
from codeset.session import land, small_frame

SEQUENCE = 2048
GRAIN = 8  # lengths are rounded up to multiples of it for the linear program
SLICE_ROWS = 500_000  # rows that one task ranks, about


def tokenised(
    docs: DataFrame, vocabulary: str, sequence: int, key: str, text: str
) -> DataFrame:
    """(key, doc_tokens, crcs of the pieces in order, row id) without the ids.

    A document is cut every ``sequence`` ids; the last piece may be shorter.
    """
    source = docs.select(key, F.coalesce(text, F.lit("")).alias("_text"))
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, doc_tokens long, crcs array<long>"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "_text"):
            ids, bounds = encoder(vocabulary).encode(batch.column("_text"))
            data, bounds = memoryview(ids), bounds.tolist()
            crcs = [
                [zlib.crc32(data[at : min(at + sequence, end)]) for at in range(begin, end, sequence)]
                for begin, end in zip(bounds[:-1], bounds[1:])
            ]
            sizes = [end - begin for begin, end in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(sizes, pa.int64()), pa.array(crcs, pa.list_(pa.int64()))],
                [key, "doc_tokens", "crcs"],
            )

    coded = source.mapInArrow(encode, schema)
    return land(coded.withColumn("_row", F.monotonically_increasing_id()), "tokenised")


def places(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first and end rank, pieces per sequence, first sequence).

    The pieces of a length, by rank, fill one pattern's uses after the other's.
    """
    begun = dict.fromkeys(histogram, 0)
    rows, sequences = [], 0
    for pattern, uses in sorted(patterns_for(histogram, capacity).items()):
        for length, times in pattern:
            end = begun[length] + times * uses
            rows.append((length, begun[length], end, times, sequences))
            begun[length] = end
        sequences += uses
    return rows


def slice_of(rows: int, *columns: str) -> Column:
    """A hash slice of about ``SLICE_ROWS`` rows, so that no group is one task's."""
    return F.pmod(F.xxhash64(*columns), F.lit(max(64, rows // SLICE_ROWS)))


def pack_documents(
    docs: DataFrame, vocabulary: str, sequence: int = SEQUENCE, grain: int = GRAIN,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per piece: where it lies in its document and in which sequence.

    Whole sequences are cut off long documents; the rest of each is a piece
    whose length, rounded up to ``grain``, counts in a histogram of at most
    ``sequence / grain`` lengths.  The driver solves the cutting-stock program
    for that histogram; its patterns are dealt to the pieces, ranked by key
    within their length.  Columns: key, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.  A null or empty text is one piece of its end id;
    repeated rows are packed each; other columns are left out; no rows give
    no pieces.
    """
    coded = tokenised(docs, vocabulary, sequence, key, text)
    pieces = coded.select(
        key, "_row", "doc_tokens", F.posexplode("crcs").alias("_piece", "ids_crc32")
    ).select(
        "*",
        (F.col("_piece") * F.lit(sequence)).cast("long").alias("start"),
        F.least(
            F.lit(sequence), F.col("doc_tokens") - F.col("_piece") * F.lit(sequence)
        ).alias("length"),
    )
    rests = pieces.where(F.col("length") < sequence).withColumn(
        "_class", F.ceil(F.col("length") / grain)
    )
    counted = rests.groupBy("_class").count().collect()  # sequence / grain rows at most
    histogram = {row["_class"]: row["count"] for row in counted}
    rows = sum(histogram.values())
    spots = places(histogram, sequence // grain)
    sequences = max((first + (end - begin) // per for _, begin, end, per, first in spots), default=0)
    table = small_frame(
        docs.sparkSession, spots, "_class long, _begin long, _end long, _per long, _first long"
    )
    ranked = numbered(
        rests.withColumn("_slice", slice_of(rows, "_row")),
        ["_class"], ["_slice"], [key, "_row"], "_rank",
    )
    rank = F.col("_rank") - 1
    placed = ranked.join(
        F.broadcast(table.withColumnRenamed("_class", "_of")),
        (F.col("_class") == F.col("_of")) & (rank >= F.col("_begin")) & (rank < F.col("_end")),
    ).withColumn("sequence_id", F.expr("_first + (_rank - 1 - _begin) div _per"))
    before = (
        Window.partitionBy("sequence_id")
        .orderBy(F.desc("length"), key, "_row")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    columns = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    filled = placed.withColumn(
        "offset", F.coalesce(F.sum("length").over(before), F.lit(0))
    ).select(*columns)
    whole = numbered(
        pieces.where(F.col("length") == sequence).withColumn("_slice", slice_of(rows, "_row")),
        [], ["_slice"], ["_row", "_piece"], "_number",
    ).select(
        key, "start", "length", "ids_crc32", "doc_tokens",
        (F.col("_number") - 1 + F.lit(sequences)).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return filled.unionByName(whole)
