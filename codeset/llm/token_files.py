"""Whole texts as bit-packed token files, written and read back by tasks."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codeset.llm.arrow import by_bytes
from codeset.llm.bitfile import Reader, Writer, bits_needed, open_store
from codeset.llm.tokens import encoder, vocabulary_size
from codeset.session import land, new_path

READ_IDS = 1 << 21  # ids that a task holds at a time, or those of one document


def write_token_files(
    docs: DataFrame, vocabulary: str, path: str | None = None,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Write the ids of all texts in ascending order of ``key``.

    One file per range of keys, under ``path`` or a new place in the shared
    folder.  Returns the manifest (slice, path, n_docs, n_ids): a task that
    runs twice writes two files, and only the manifest's one counts.  Rows of
    one key follow each other by the hash of their text; null keys come
    first, null texts count as empty, other columns are left out.
    """
    folder = path or new_path(docs.sparkSession, "token-files")
    store, inner = open_store(folder)
    store.create_dir(inner, recursive=True)
    width = bits_needed(vocabulary_size(vocabulary))
    order = [F.col("_key").asc_nulls_first(), F.xxhash64("_text")]
    ordered = (
        docs.select(
            F.col(key).cast("long").alias("_key"),
            F.coalesce(text, F.lit("")).alias("_text"),
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        place = f"{folder}/ids-{number:06d}-{uuid.uuid4().hex}.bits"
        file, rows = Writer(place, width), 0
        for batch in by_bytes(batches, "_text"):
            ids, bounds = encoder(vocabulary).encode(batch.column("_text"))
            keys = batch.column("_key")
            file.add(ids, bounds, keys.fill_null(0), keys.is_null())
            rows += batch.num_rows
        file.close()
        columns = {"slice": [number], "path": [place], "n_docs": [rows], "n_ids": [file.count]}
        yield pa.RecordBatch.from_pydict(columns)

    schema = "slice long, path string, n_docs long, n_ids long"
    return land(ordered.mapInArrow(write, schema), "token-manifest")


def read_token_files(manifest: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of each document, from the files.

    ``start`` counts the ids of all documents before it; the sums run over
    one manifest row per file.
    """
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    files = (
        manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))
        .where("n_docs > 0")
        .select("path", "before")
        .repartition(max(1, manifest.count()))
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = Reader(row["path"])
                begin, starts = 0, file.starts
                while begin < len(starts) - 1:
                    end = int(np.searchsorted(starts, starts[begin] + READ_IDS, "right")) - 1
                    end = max(begin + 1, end)
                    cuts = (starts[begin : end + 1] - starts[begin]).tolist()
                    ids = memoryview(file.ids(int(starts[begin]), int(starts[end])))
                    crcs = [zlib.crc32(ids[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(file.keys[begin:end], mask=file.nulls[begin:end]),
                            pa.array(starts[begin:end] + row["before"]),
                            pa.array(np.diff(starts[begin : end + 1])),
                            pa.array(crcs, pa.int64()),
                        ],
                        [key, "start", "n_tokens", "ids_crc32"],
                    )
                    begin = end
                file.close()

    return files.mapInArrow(read, f"`{key}` long, start long, n_tokens long, ids_crc32 long")
