"""Documents to packed training sequences: rules, near-duplicates, pseudonyms, mixture, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeset.llm import mixing, packing, pii, quality_rules, simhash
from codeset.llm.tokens import vocabulary_path
from codeset.session import land, tune

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

PII_KEY = "a key of the operator's choice"  # production takes it from a secret store


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the quality rules, each judged by its own text."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.kept_rows(docs, labels)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, the one with the smallest id."""
    return simhash.one_of_each(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms; ``n_chars`` follows changed texts."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), "text")
    same = F.col("text").eqNullSafe(F.col("_row.text"))
    new = {
        "text": F.col("text"),
        "n_chars": F.when(same, F.col("_row.n_chars")).otherwise(F.char_length("text")),
    }
    columns = [new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns]
    return pii.pseudonymise(rows, PII_KEY).select(*columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose sources, languages and topics meet the target weights."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in its training sequence."""
    return packing.pack_documents(docs, vocabulary_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_good),
    ("simhash_near_dedup", drop_near_copies),
    ("pii_pseudonyms", replace_personal_data),
    ("source_mixing", mix_sources),
    ("packing", pack),
]

# Hashes, raking and the linear program have no SQL; the stages are tested
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    tune(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), name)
    return docs
