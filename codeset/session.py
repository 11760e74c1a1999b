"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


ARROW_BYTES = 32 << 20  # of a batch that goes to a Python worker, about


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime options that the plans of this package rely on."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="codeset-"))
    return context.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no one else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def land(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back.

    Later steps scan the few columns they need from the files, whatever
    happens to the executors that made them.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


MAX_BROADCAST_ROWS = 1_000_000  # narrow rows of a name and a language


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Mark a stored table for broadcast if a count shows that it is small.

    A larger one is returned as it is: its joins shuffle both sides, and
    adaptive execution splits the hot keys.
    """
    if df.count() <= max_rows:
        return F.broadcast(df)
    return df


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A DataFrame of a few driver-side rows, planned as a local relation."""
    struct = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)
    columns = [
        pa.array([row[i] for row in rows], type=field.type)
        for i, field in enumerate(arrow)
    ]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), struct)
