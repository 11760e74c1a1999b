"""Reproducible random order.

Sampling sorts by a seeded hash of a row's key.  The order is the same on
every run, for any partitioning, and after a task is retried.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SEED = "0"


def shuffle_key(*columns: str | Column, seed: str = DEFAULT_SEED) -> Column:
    """md5 hex of ``seed:column:column...``; sorting by it shuffles the rows."""
    return F.md5(F.concat_ws(":", F.lit(seed), *columns).cast("binary"))


def slice_of(key: str | Column, width: int = 2) -> Column:
    """First hex digits of a hash: slices of even size, in the hash's order."""
    return F.substring(key, 1, width)
