"""Records of large CSV files whose quoted fields hold line breaks, read by many tasks.

A file is cut into blocks at line ends, wherever they lie.  Whether a line
begins inside quotes depends on all quotes before it, but only on whether
their number is odd: each block tells this from its own start on, and sums
over the blocks, one row each, settle it.  A line that begins and ends outside
quotes is a record of its own; only the lines of other records are put
together, also across block ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codeset.session import land

MAX_RECORD = 64 << 20  # characters; a quote that is never closed would swallow the file

_LINES = "file string, block long, line long, value string, odd boolean, before boolean, even_open long, odd_open long"


def _numbered_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines numbered in their block, with what their quotes say.

    ``odd``: the line has an odd number of quotes; ``before``: so have the
    lines before it in the block.  ``even_open`` and ``odd_open`` are the last
    line so far where a record began that goes on, if the quotes before the
    block are even, or odd.
    """
    place: tuple | None = None
    count, parity, opened = 0, 0, [-1, -1]
    for batch in batches:
        files, blocks = (batch.column(name).to_pylist() for name in ("file", "block"))
        values = batch.column("value")
        odd = pc.count_substring(values, '"').to_numpy(zero_copy_only=False) % 2
        keys = list(zip(files, blocks))
        cuts = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]] + [len(keys)]
        for begin, end in zip(cuts, cuts[1:]):
            if keys[begin] != place:
                place, count, parity, opened = keys[begin], 0, 0, [-1, -1]
            own = odd[begin:end]
            before = (parity + np.cumsum(own) - own) % 2
            numbers = count + np.arange(end - begin)
            columns = []
            for start in (0, 1):
                opens = (own == 1) & ((before + start) % 2 == 0)
                last = np.maximum.accumulate(np.where(opens, numbers, opened[start]))
                columns.append(pa.array(last, mask=last < 0))
                opened[start] = int(last[-1])
            count, parity = count + end - begin, int((before[-1] + own[-1]) % 2)
            part = slice(begin, end)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("file")[part], batch.column("block")[part], pa.array(numbers),
                    values[part], pa.array(own == 1), pa.array(before == 1), *columns,
                ],
                ["file", "block", "line", "value", "odd", "before", "even_open", "odd_open"],
            )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line, record) of CSV files: where each record begins, and its text.

    Records end at line ends outside quotes, and come without them; quotes
    inside quoted fields are doubled.  Empty lines between records are left
    out.  A record of more than ``MAX_RECORD`` characters is an error.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    lines = land(lines.mapInArrow(_numbered_lines, _LINES), "csv-lines")
    odd_lines = F.count_if("odd") % 2 == 1
    blocks = lines.groupBy("file", "block").agg(
        odd_lines.alias("_odd"), F.max("even_open").alias("_even"), F.max("odd_open").alias("_odd_open")
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    quotes_before = F.coalesce(F.count_if("_odd").over(earlier) % 2 == 1, F.lit(False))
    last_open = F.when(F.col("_inside"), F.col("_odd_open")).otherwise(F.col("_even"))
    opened = F.when(last_open.isNotNull(), F.struct(F.col("block").alias("block"), last_open.alias("line")))
    states = land(
        blocks.withColumn("_inside", quotes_before)
        .withColumn("_carried", F.last(opened, ignorenulls=True).over(earlier))
        .select("file", "block", "_inside", "_carried"),
        "csv-blocks",
    )
    placed = lines.join(states, ["file", "block"]).withColumn(
        "_inside", F.col("before") != F.col("_inside")
    )
    whole = placed.where("not _inside and not odd").select(
        "file", "block", "line", F.rtrim("value", F.lit("\r")).alias("record")
    )
    own = F.when(F.col("_inside") != F.col("before"), F.col("odd_open")).otherwise(F.col("even_open"))
    begun = F.when(own.isNotNull(), F.struct(F.col("block").alias("block"), own.alias("line")))
    parts = placed.where("_inside or odd").select(
        "file", F.coalesce(begun, "_carried").alias("_begun"), "block", "line", "value"
    )
    sizes = parts.groupBy("file", "_begun").agg(F.sum(F.char_length("value") + 1).alias("_size"))
    longest = sizes.orderBy(F.desc("_size")).first()
    if longest and longest["_size"] > MAX_RECORD:
        raise ValueError(f"a record of {longest['file']} has {longest['_size']} characters: a quote is not closed")
    joined = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("block", "line", "value"))), lambda x: x["value"]), "\n"
    )
    several = parts.groupBy("file", "_begun").agg(joined.alias("_text")).select(
        "file", F.col("_begun.block").alias("block"), F.col("_begun.line").alias("line"),
        F.rtrim("_text", F.lit("\r")).alias("record"),
    )
    return whole.unionByName(several).where("record <> ''")
