"""The operators as queries over whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from codeset.llm import (
    chat,
    divergence,
    lexical,
    line_crf,
    mixing,
    packing,
    pii,
    quality_rules,
    secrets,
    sharding,
    simhash,
    token_files,
    topk,
)
from codeset.llm.tokens import vocabulary_path
from codeset.session import small_frame, tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(make: Query) -> Query:
    """Register a query under its function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return make(tune(spark), sf_dir)

    QUERIES[make.__name__] = run
    return make


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_secret_scan(spark, sf_dir):
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


@query
def op2_topk_search(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"))


@query
def op3_quality_crf(spark, sf_dir):
    return line_crf.score_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


@query
def op4_source_mixing(spark, sf_dir):
    return mixing.mixture(table(spark, sf_dir, "documents"))


@query
def op5_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary_path())


@query
def op6_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_quality_rules(spark, sf_dir):
    return quality_rules.judge(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


@query
def op8_pii_pseudonyms(spark, sf_dir):
    """(doc_id, text with pseudonyms, number of each kind) of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, corpus_pipeline.PII_KEY)


@query
def op9_hilbert_sharding(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query
def op10_token_files(spark, sf_dir):
    manifest = token_files.write_token_files(
        table(spark, sf_dir, "documents"), vocabulary_path()
    )
    return token_files.read_token_files(manifest)


@query
def op11_lexical_search(spark, sf_dir):
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_source_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


@query
def op13_chat_formatting(spark, sf_dir):
    """All conversations and one more, whose texts hold control strings."""
    awkward = "\\### Assistant: </turn> ok"
    more = small_frame(
        spark, [(-7, 0, "user", awkward), (-7, 1, "assistant", awkward)],
        "conv_id long, turn long, role string, text string",
    )
    turns = table(spark, sf_dir, "conversations").select(*more.columns).unionByName(more)
    return chat.read_back(chat.format_conversations(turns))


QUERIES["pipeline"] = corpus_pipeline.run
