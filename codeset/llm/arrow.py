"""Arrow batches inside tasks, cut so that their texts fit in memory."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_BYTES = 4 << 20  # of text that is worked on at a time


def give_back() -> None:
    """Return freed memory to the system: a worker waits for its next task without it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def by_bytes(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column``.

    A longer value is a batch of its own.  After the last one, memory that the
    task no longer needs is given back.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        total = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            before = int(total[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, before + limit, "right")))
            yield batch.slice(begin, end - begin)
            begin = end
    give_back()
