"""Documents along a Hilbert curve through their metadata, cut into shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeset.operators.ranking import numbered
from codeset.session import land

BITS = 6  # cells per dimension, as a power of two
SIZE_STEPS = 4  # size cells per doubling


def text_cell(column: str | Column, bits: int = BITS) -> Column:
    """The cell of a name, by hash; nulls share the cell of the empty name."""
    named = F.coalesce(column, F.lit(""))
    return F.pmod(F.xxhash64(named), F.lit(1 << bits)).cast("int")


def size_cell(column: str | Column, bits: int = BITS) -> Column:
    """The cell of a positive size, in equal steps of its logarithm."""
    step = F.floor(F.log2(F.greatest(F.col(column) if isinstance(column, str) else column, F.lit(1))) * SIZE_STEPS)
    return F.least(step, F.lit((1 << bits) - 1)).cast("int")


def with_curve(df: DataFrame, cells: Sequence[str], bits: int = BITS, name: str = "curve") -> DataFrame:
    """Add the place on the Hilbert curve through ``cells`` of ``bits`` bits each.

    Neighbours on the curve differ by one step in one dimension.  Coordinates
    are turned level by level, from the highest bit, by exchanging and
    inverting lower bits; the Gray code of the turned bits is the place.  Each
    level is a projection of bit operations.
    """
    axes = [f"_axis{i}" for i in range(len(cells))]
    columns = {axis: F.col(cell).cast("long") for axis, cell in zip(axes, cells)}
    df = df.withColumns(columns)
    first = F.col(axes[0])
    for level in range(bits - 1, 0, -1):
        low = F.lit((1 << level) - 1)
        for axis in axes:
            here = F.col(axis)
            is_set = here.bitwiseAND(F.lit(1 << level)) != 0
            swap = first.bitwiseXOR(here).bitwiseAND(low)
            turned = {axes[0]: F.when(is_set, first.bitwiseXOR(low)).otherwise(first.bitwiseXOR(swap))}
            if axis != axes[0]:
                turned[axis] = F.when(is_set, here).otherwise(here.bitwiseXOR(swap))
            df = df.withColumns(turned)
    for before, axis in zip(axes, axes[1:]):
        df = df.withColumn(axis, F.col(axis).bitwiseXOR(F.col(before)))
    last = F.col(axes[-1])
    flips = F.lit(0).cast("long")
    for level in range(bits - 1, 0, -1):
        is_set = last.bitwiseAND(F.lit(1 << level)) != 0
        flips = flips.bitwiseXOR(F.when(is_set, F.lit((1 << level) - 1)).otherwise(F.lit(0)))
    df = df.withColumn("_flips", flips)
    place = F.lit(0).cast("long")
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            bit = F.shiftright(F.col(axis).bitwiseXOR(F.col("_flips")), level).bitwiseAND(F.lit(1))
            place = place * 2 + bit
    return df.withColumn(name, place).drop(*axes, "_flips")


def shard_documents(
    docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text",
    names: Sequence[str] = ("lang", "source"),
) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard, cells, curve).

    Law ``rows``: shards are runs of the curve order whose numbers of rows
    differ by one at most.  Dimensions are the cells of ``names`` and of the
    size in bytes.  Equal texts count as one group, with the smallest of its
    names, so they follow each other on the curve and only a cut divides
    them; the cells returned are those of the row's own names.  A null text has no bytes; null names sort as empty ones; repeated
    rows get slots of their own; no rows give no shards; other columns are
    left out.  Only narrow rows are shuffled, never texts.
    """
    text_bytes = F.coalesce(text, F.lit(""))
    narrow = land(
        docs.select(
            F.col(key),
            *(F.coalesce(F.col(name).cast("string"), F.lit("")).alias(f"_{name}") for name in names),
            (F.octet_length(text_bytes) + 1).cast("long").alias("size"),
            F.crc32(text_bytes.cast("binary")).alias("text_crc32"),
            F.xxhash64(text_bytes).alias("_text"),
        ),
        "shard-rows",
    )
    group = ["_text", "text_crc32", "size"]
    least = narrow.groupBy(*group).agg(*(F.min(f"_{name}").alias(f"_{name}") for name in names))
    cells = {f"{name}_cell": text_cell(F.col(f"_{name}")) for name in names}
    cells["size_cell"] = size_cell("size")
    curved = with_curve(least.withColumns(cells), list(cells)).select(*group, "curve")
    rows = narrow.join(curved, group)
    order = ["curve", *group, F.col(key).asc_nulls_first()]
    sliced = rows.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id())
    ordered = numbered(land(sliced, "curve-order"), [], ["_slice"], order, "_position")
    place = ordered.withColumn("_place", F.col("_position") - 1)
    shard = F.expr(f"(_place * {shards}) div total")
    begin = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return (
        place.withColumn("shard", shard.cast("int"))
        .withColumn("slot", F.col("_place") - begin)
        .withColumns(cells)
        .select(
            key, "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
            F.lit(None).cast("int").alias("grown_shard"), *cells, "curve",
        )
    )


def shard_manifest(sharded: DataFrame, names: Sequence[str] = ("lang", "source")) -> DataFrame:
    """Rows, bytes and the range of each dimension's cells per shard."""
    cells = [f"{name}_cell" for name in names] + ["size_cell"]
    ranges = [f(c).alias(f"{label}_{c}") for c in cells for label, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), *ranges
    )


def shards_to_read(manifest: DataFrame, **values) -> DataFrame:
    """The shards whose ranges of cells may hold the given names or ``size``."""
    kept = manifest
    for name, value in values.items():
        cell = size_cell(F.lit(value)) if name == "size" else text_cell(F.lit(value))
        kept = kept.where(cell.between(F.col(f"min_{name}_cell"), F.col(f"max_{name}_cell")))
    return kept.select("shard")
