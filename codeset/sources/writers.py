"""Write stage tables, dataset files, reports and graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from codeset.dictionary import Dictionary
from codeset.functions.naming import extension
from codeset.operators.splits import USAGES
from codeset.sources.readers import latest_version, record_version

ROWS_PER_FILE = 100_000
PROMISES = ("empty", "not UTF-8", "of an unknown language", "of a wrong suffix")  # and not kept


def write_stage(df: DataFrame, root: str, name: str) -> None:
    """Replace a stage table."""
    df.write.mode("overwrite").parquet(f"{root}/{name}")


def append_batch(df: DataFrame, root: str, name: str, batch: str) -> None:
    """Add a batch to a stage table; a repeated batch replaces itself.

    So a listing that failed half-way is run again under the same batch name.
    """
    df.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch}")


def write_versioned(df: DataFrame, root: str, name: str) -> int:
    """Write the next version of a table and keep the earlier ones."""
    spark = df.sparkSession
    version = latest_version(spark, root, name) + 1
    df.write.mode("overwrite").parquet(f"{root}/{name}/v{version}")
    record_version(spark, root, name, version)
    return version


def write_dataset(rows: DataFrame, path: str, dictionary: Dictionary | None = None) -> dict[str, int]:
    """Write usage, language, extract_to, text, split by usage and language.

    Rows are dealt by usage and language and then by size: adaptive execution
    divides a large language among as many tasks as its bytes ask for, and
    puts small ones together.  With a ``dictionary`` the rows are checked as
    they are written, in the same scan: a row without text, whose text is not
    UTF-8, of an unknown language or whose name lacks its language's suffix is
    an error.  Returns the number of rows, and then also the rows of each
    ``language/usage``.
    """
    dealt = rows.hint("rebalance", F.col("usage"), F.col("language"))
    metrics = [F.count(F.lit(1)).alias("rows")]
    if dictionary is not None:
        suffixes = dictionary.languages_df(rows.sparkSession).select("language", "primary_ext")
        dealt = dealt.join(F.broadcast(suffixes), "language", "left")
        known = F.col("primary_ext").isNotNull()
        metrics += [
            F.count_if(F.coalesce(F.col("text"), F.lit("")) == "").alias("empty"),
            F.count_if(~F.is_valid_utf8("text")).alias("not UTF-8"),
            F.count_if(~known).alias("of an unknown language"),
            F.count_if(known & (extension("extract_to") != F.col("primary_ext"))).alias("of a wrong suffix"),
            *(
                F.count_if((F.col("language") == language) & (F.col("usage") == usage)).alias(f"{language}/{usage}")
                for language in dictionary.languages for usage in USAGES
            ),
        ]
    seen = Observation()
    dealt.observe(seen, *metrics).select(rows.columns).write.mode("overwrite").partitionBy(
        "usage", "language"
    ).option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)
    counts = seen.get
    broken = [f"{counts[name]} {name}" for name in PROMISES if counts.get(name)]
    if broken:
        raise ValueError(f"rows of {path} break the dataset's promises: {', '.join(broken)}")
    return {name: n for name, n in counts.items() if name not in PROMISES}


def write_training_subset(subset: DataFrame, root: str, n: int) -> str:
    """Replace the training subset of ``n`` files per language."""
    path = f"{root}/train_{n}"
    subset.write.mode("overwrite").parquet(path)
    return path


def export_label_map(pairs: DataFrame) -> DataFrame:
    """One row of JSON ``{language: primary_ext}``, sorted ignoring case.

    The map has one entry per language of the dictionary.
    """
    entry = F.struct(
        F.lower("language").alias("_key"), F.col("language"), F.col("primary_ext")
    )
    entries = F.array_sort(F.collect_set(entry))
    return pairs.agg(entries.alias("_entries")).select(
        F.to_json(
            F.map_from_entries(
                F.transform(
                    "_entries", lambda e: F.struct(e["language"], e["primary_ext"])
                )
            )
        ).alias("languages_json")
    )


def write_report_csv(report: DataFrame, path: str) -> None:
    """Write a prediction report as CSV with a header."""
    report.write.mode("overwrite").csv(path, header=True, escape='"')


def graph_rows(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(kind, value): a JSON object for every node and for every link."""
    each = [
        nodes.select(F.lit("node").alias("kind"), F.to_json(F.struct("group", "name")).alias("value")),
        links.select(
            F.lit("link").alias("kind"), F.to_json(F.struct("source", "target", "value")).alias("value")
        ),
    ]
    return each[0].unionByName(each[1])


def write_graph(nodes: DataFrame, links: DataFrame, path: str) -> None:
    """Write a graph as JSON lines, in a folder of nodes and one of links."""
    graph_rows(nodes, links).write.mode("overwrite").partitionBy("kind").text(path)
