"""Which rows of a large table may have one of many keys, told without a shuffle.

The keys become Bloom filters of bounded size: a bitmap for each bucket of the
keys' hashes, which is broadcast whatever the number of keys.  Rows that pass
are nearly all wanted ones; a join with the keys settles the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITMAP_BITS = 1 << 15  # of one bitmap, as Spark's bitmap functions make them
BITS_PER_KEY = 16  # with two bits a key, about 1.4 % of other rows pass
MAX_BITMAPS = 1 << 14  # 64 MB; of more keys than they hold well, more other rows pass


def _places(hashed: Column, buckets: int) -> tuple[Column, tuple[Column, Column]]:
    """The bucket of a hash, and its two bits there."""
    bucket = F.pmod(F.shiftright(hashed, 30), F.lit(buckets))
    low = F.lit(BITMAP_BITS - 1).cast("bigint")
    return bucket, (hashed.bitwiseAND(low), F.shiftright(hashed, 15).bitwiseAND(low))


def _is_set(bitmap: str, bit: Column) -> Column:
    byte = F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.call_function("shiftright", value, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def bitmaps(keys: DataFrame, columns: Sequence[str | Column]) -> tuple[DataFrame, int]:
    """((bucket, bitmap), number of buckets) of the keys, at most ``MAX_BITMAPS`` rows."""
    buckets = min(MAX_BITMAPS, max(1, -(-keys.count() * BITS_PER_KEY // BITMAP_BITS)))
    hashed = keys.select(F.xxhash64(*columns).alias("_hash"))
    bucket, bits = _places(F.col("_hash"), buckets)
    made = (
        hashed.select(bucket.alias("_bucket"), F.explode(F.array(*bits)).alias("_bit"))
        .groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bitmap"))
    )
    return made, buckets


def with_membership(
    df: DataFrame, columns: Sequence[str | Column], keys: DataFrame,
    key_columns: Sequence[str | Column] | None = None, name: str = "_member",
) -> DataFrame:
    """Add ``name``: false for rows that have none of the keys, true for all that do.

    ``df`` is not shuffled, and no join multiplies its rows.  The keys are
    scanned twice, to count them and for the bitmaps: give a stored table.
    """
    made, buckets = bitmaps(keys, key_columns or columns)
    bucket, bits = _places(F.col("_hash"), buckets)
    return (
        df.withColumn("_hash", F.xxhash64(*columns))
        .withColumn("_bucket", bucket)
        .join(F.broadcast(made), "_bucket", "left")
        .withColumn(
            name,
            F.coalesce(_is_set("_bitmap", bits[0]) & _is_set("_bitmap", bits[1]), F.lit(False)),
        )
        .drop("_hash", "_bucket", "_bitmap")
    )
