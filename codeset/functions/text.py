"""Decode file contents to text."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeset.functions.encodings import detect_encoding

# Fixed value: detections below this confidence are not trusted.
MIN_CONFIDENCE = 0.5

# A detector takes bytes and returns (encoding or None, confidence).
Detector = Callable[[bytes], tuple[str | None, float]]


def _decode(
    content: bytes | None, detector: Detector, min_confidence: float
) -> tuple[str | None, str | None]:
    """(text, encoding) of bytes that are not UTF-8; both None if rejected."""
    if content is None:
        return None, None
    encoding, confidence = detector(bytes(content))
    if encoding is None or confidence < min_confidence:
        return None, None
    try:
        text = bytes(content).decode(encoding)
        text.encode("utf-8")
    except (UnicodeError, LookupError):
        return None, None
    return text, encoding


def text_fallback(detector: Detector, min_confidence: float):
    """A batch function: bytes to (text, encoding)."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for contents in batches:
            yield pd.DataFrame(
                [_decode(c, detector, min_confidence) for c in contents],
                columns=["text", "encoding"],
                dtype=object,
            )

    return F.pandas_udf(run, "text string, encoding string")


def encoding_fallback(detector: Detector, min_confidence: float):
    """A batch function: bytes to the encoding they decode with."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for contents in batches:
            yield pd.Series(
                [_decode(c, detector, min_confidence)[1] for c in contents],
                dtype=object,
            )

    return F.pandas_udf(run, "string")


def is_utf8(content: str | Column) -> Column:
    """True for BINARY content that is valid UTF-8; null for null."""
    column = F.col(content) if isinstance(content, str) else content
    return F.is_valid_utf8(column.cast("string"))


def _split_utf8(files: DataFrame, *keep: Column) -> DataFrame:
    """Replace ``content`` by ``_missing`` and the bytes that are not UTF-8.

    ``_other`` is null for UTF-8 content, so that the rows that wait for Python
    do not hold the bytes that Python need not see.
    """
    valid = F.coalesce(is_utf8("content"), F.lit(False))
    rest = [c for c in files.columns if c != "content"]
    return files.select(
        *rest,
        F.col("content").isNull().alias("_missing"),
        F.when(~valid, F.col("content")).alias("_other"),
        *keep,
    )


def _encoding(fallback: Column) -> Column:
    utf8 = F.col("_other").isNull() & ~F.col("_missing")
    return F.when(utf8, "utf-8").otherwise(fallback)


def flag_files(
    files: DataFrame,
    min_confidence: float = MIN_CONFIDENCE,
    detector: Detector = detect_encoding,
) -> DataFrame:
    """Replace ``content`` by encoding and ok: what ``decode_files`` would do."""
    fallback = encoding_fallback(detector, min_confidence)
    return (
        _split_utf8(files)
        .withColumn("encoding", _encoding(fallback("_other")))
        .withColumn("ok", F.col("encoding").isNotNull())
        .drop("_missing", "_other")
    )


def decode_files(
    files: DataFrame,
    min_confidence: float = MIN_CONFIDENCE,
    detector: Detector = detect_encoding,
) -> DataFrame:
    """Replace ``content`` by text, encoding and ok.

    Spark checks and decodes UTF-8.  Only the other rows' bytes go to Python;
    the rest of the batch crosses as nulls.  Null content is not ok.
    """
    fallback = text_fallback(detector, min_confidence)
    utf8_text = F.when(is_utf8("content"), F.col("content").cast("string"))
    return (
        _split_utf8(files, utf8_text.alias("_utf8"))
        .withColumn("_fallback", fallback("_other"))
        .withColumn("text", F.coalesce("_utf8", "_fallback.text"))
        .withColumn("encoding", _encoding(F.col("_fallback.encoding")))
        .withColumn("ok", F.col("encoding").isNotNull())
        .drop("_missing", "_other", "_utf8", "_fallback")
    )


# Tasks get these functions by value, so workers need not install the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
