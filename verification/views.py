"""Repository, file and prediction tables made from the test tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeset.functions.naming import content_key
from codeset.operators.splits import Quotas
from codeset.plans.dataset import Settings

SETTINGS = Settings(
    repositories=500, quotas=Quotas(train=40, valid=10, test=10), strict=False
)
SMALL_QUOTAS = Quotas(train=20, valid=5, test=5)
LISTING_QUOTAS = Quotas(train=300, valid=50, test=50)
TOPUP_LANGUAGES = ["Python", "C", "Go", "Lisp", "SQL"]
TOPUP_CAP = 600
SUBSET = 25
DICTIONARY = SETTINGS.dictionary
QUOTAS = SETTINGS.quotas


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a repository catalogue."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id",
        """CASE WHEN o_custkey % 10 = 0 THEN 'GitLab'
                WHEN o_custkey % 37 = 0 THEN NULL ELSE 'GitHub' END AS host_type""",
        """CASE WHEN o_orderkey % 97 = 0 THEN NULL
                ELSE concat('user', o_custkey, '/proj', o_orderkey % 400)
           END AS name_with_owner""",
        "CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS fork",
        """CASE o_orderkey % 8 WHEN 0 THEN 'FORTRAN' WHEN 1 THEN 'Delphi'
                WHEN 2 THEN NULL WHEN 3 THEN 'Python' WHEN 4 THEN 'C'
                WHEN 5 THEN 'Emacs Lisp' WHEN 6 THEN 'Go'
                ELSE 'Brainfuck' END AS language""",
    )


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a curated repository list."""
    return table(spark, sf_dir, "customer").selectExpr(
        "concat('user', c_custkey, '/proj', c_nationkey) AS repository_name",
        """CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'SQL' WHEN 'MACHINERY' THEN 'Go'
                WHEN 'BUILDING' THEN 'Python' ELSE 'Rust' END AS repository_language""",
    )


def visited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as files of repositories listed earlier."""
    return table(spark, sf_dir, "events").selectExpr(
        "concat('user', user_id, '___proj', event_id % 400) AS repository_dirname",
        "concat(event_type, '/e', event_id, '.py') AS filename",
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as source files with their text."""
    return table(spark, sf_dir, "documents").selectExpr(
        "concat(lang, '___', source) AS repository_dirname",
        """CASE lang WHEN 'en' THEN 'C++' WHEN 'de' THEN 'C'
                WHEN 'fr' THEN 'Objective-C' ELSE 'PHP' END AS repository_language""",
        """CASE doc_id % 6 WHEN 0 THEN concat('src/f', doc_id, '.h')
                WHEN 1 THEN concat('src/f', doc_id, '.HH')
                WHEN 2 THEN concat('src/f', doc_id, '.py')
                WHEN 3 THEN concat('build/d', doc_id, '/Makefile')
                WHEN 4 THEN concat('src/f', doc_id, '.m')
                ELSE concat('doc/f', doc_id, '.txt') END AS filename""",
        "n_chars % 5 <> 0 AS ok",
        "doc_id",
        "text",
    )


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed files: the documents without their text."""
    keyed = documents(spark, sf_dir).withColumn(
        "dedup_key", content_key(F.encode("text", "UTF-8"))
    )
    return keyed.drop("text", "doc_id")


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as listed files: parts are contents that occur many times."""
    items = table(spark, sf_dir, "lineitem").selectExpr(
        "concat('s', l_suppkey, '___r', l_linestatus) AS repository_dirname",
        """CASE l_linestatus WHEN 'O' THEN 'C' ELSE 'Python' END
           AS repository_language""",
        """concat('src/o', l_orderkey, '/p', l_partkey, '/l', l_linenumber,
             CASE l_linenumber WHEN 1 THEN '.c' WHEN 2 THEN '.h' WHEN 3 THEN '.py'
               WHEN 4 THEN '.go' WHEN 5 THEN '.rs' WHEN 6 THEN '.pl'
               ELSE '.txt' END) AS filename""",
        """sha1(encode(concat(l_partkey, ':', l_linenumber), 'UTF-8'))
           AS dedup_key""",
    )
    return items.withColumn("ok", F.col("dedup_key") < "e")


def listing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files as the lines of a listing."""
    return files(spark, sf_dir).select(
        "repository_dirname",
        F.concat(
            F.lit("100644 blob "), "dedup_key", F.lit("\t"), "filename"
        ).alias("line"),
    )


def file_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with their bytes: UTF-8, binary, UTF-16 and single-byte ones."""
    return documents(spark, sf_dir).selectExpr(
        "repository_dirname",
        "filename",
        """CASE WHEN doc_id % 11 = 0 THEN concat(encode(text, 'UTF-8'), X'00FF')
                WHEN doc_id % 13 = 0 THEN encode(text, 'UTF-16')
                WHEN doc_id % 7 = 0
                THEN concat(encode(regexp_replace(text, '[^\\\\x00-\\\\x7F]', ''), 'UTF-8'), X'FF')
                ELSE encode(text, 'UTF-8') END AS content""",
    )


def mixed_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with their bytes: UTF-8, binary and single-byte ones."""
    return documents(spark, sf_dir).selectExpr(
        "repository_dirname",
        "filename",
        """CASE WHEN doc_id % 11 = 0 THEN concat(encode(text, 'UTF-8'), X'00FF')
                WHEN doc_id % 7 = 0
                THEN concat(encode(regexp_replace(text, '[^\\\\x00-\\\\x7F]', ''), 'UTF-8'), X'FF')
                ELSE encode(text, 'UTF-8') END AS content""",
    )


def whole_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with their bytes, each with its whole text: UTF-8, binary and single-byte ones.

    Texts with characters that Latin-1 lacks, or with its control characters, stay UTF-8.
    """
    return documents(spark, sf_dir).selectExpr(
        "repository_dirname",
        "filename",
        """CASE WHEN doc_id % 11 = 0 THEN concat(encode(text, 'UTF-8'), X'00FF')
                WHEN doc_id % 7 = 0 AND NOT text RLIKE '[^\\\\x00-\\\\x7F\\\\xA0-\\\\xFF]'
                THEN concat(encode(text, 'ISO-8859-1'), X'FF')
                ELSE encode(text, 'UTF-8') END AS content""",
    )


# The letters of English by how common they are, and letters for them in files
# of an encoding: (encoding, letters).  The first of equal encodings is found.
COMMON_LETTERS = "etaoinshrdlcumwfgypbvkjxqz"
WRITTEN_IN = (
    ("cp1252", "éta" + COMMON_LETTERS[3:]),
    ("cp1251", "оеаинтсрвлкмдпуяыьгзбчйхжш"),
    ("koi8-r", "оеаинтсрвлкмдпуяыьгзбчйхжш"),
    ("cp1253", "αοιετσνρςίόυηπκλμάγδωθέχφβ"),
    ("cp1255", "יוהלארתבמשנםעדקחפכצגטסזןץך"),
    ("cp932", "のいをにはたとしるがでてなあれかすらリンスクトル関数"),
    ("euc_jp", "のいをにはたとしるがでてなあれかすらリンスクトル関数"),
    ("gb18030", "的一是不了人我在有他这为之大来以个中上们到说国和地也"),
    ("big5", "的一是不了人我在有他這為之大來以個中上們到說國和地也"),
    ("cp949", "이다는에의을가고하지한은로기사리도를어인시자서해나대"),
)
ENOUGH_LETTERS = 200


def legacy_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files written in ten encodings, in letters of their languages."""

    def encoded(texts: pd.Series, encodings: pd.Series) -> pd.Series:
        return pd.Series([t.encode(e) for t, e in zip(texts, encodings)], dtype=object)

    plain = F.lower(F.regexp_replace(F.coalesce("text", F.lit("")), r"[^\x20-\x7E\n]", ""))
    kind = F.pmod("doc_id", F.lit(len(WRITTEN_IN)))
    text, encoding = F.lit(None).cast("string"), F.lit(None).cast("string")
    for number, (name, letters) in enumerate(WRITTEN_IN):
        text = F.when(kind == number, F.translate("_plain", COMMON_LETTERS, letters)).otherwise(text)
        encoding = F.when(kind == number, F.lit(name)).otherwise(encoding)
    n_letters = F.length(F.regexp_replace("_plain", "[^a-z]", ""))
    written = F.pandas_udf(encoded, "binary")(text, encoding)
    return documents(spark, sf_dir).withColumn("_plain", plain).select(
        "repository_dirname", "filename", n_letters.alias("n_letters"), written.alias("content")
    )


def checkable_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with text as rows of a dataset."""
    return table(spark, sf_dir, "documents").where("text <> ''").selectExpr(
        "CASE doc_id % 5 WHEN 0 THEN 'test' WHEN 1 THEN 'valid' ELSE 'train' END AS usage",
        "CASE lang WHEN 'en' THEN 'Python' WHEN 'de' THEN 'C' ELSE 'Go' END AS language",
        "concat('f', doc_id, CASE lang WHEN 'en' THEN '.py' WHEN 'de' THEN '.c' ELSE '.go' END) AS extract_to",
        "text",
    )


def letters_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that hold the Latin letters of a document, or nothing."""
    letters = F.regexp_replace("text", "[^A-Za-z]", "")
    kept = F.when(F.length("text") % 7 == 0, F.lit("")).otherwise(letters)
    return documents(spark, sf_dir).select(
        "repository_dirname", "filename", F.encode(kept, "UTF-8").alias("content")
    ).withColumn("dedup_key", content_key("content"))


def shared_directories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document twice under one name, as of two repositories that share a directory."""
    copy = F.explode(F.array(F.lit(""), F.lit(" changed"))).alias("_copy")
    return documents(spark, sf_dir).select("*", copy).select(
        "repository_dirname", "repository_language", "filename",
        F.encode(F.concat("text", "_copy"), "UTF-8").alias("content"),
    )


def written_outputs(spark: SparkSession, sf_dir: str, plan: DataFrame) -> DataFrame:
    """Outputs present already: the planned files whose document has a label."""
    labelled = (
        documents(spark, sf_dir)
        .join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
        .select("repository_dirname", "filename")
    )
    return plan.join(
        labelled, ["repository_dirname", "filename"], "left_semi"
    ).select("usage", "extract_to")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as (actual, predicted) labels."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_type AS actual",
        """CASE WHEN event_id % 5 = 0 AND event_type = 'click' THEN 'view'
                WHEN event_id % 6 = 0 AND event_type = 'view' THEN 'click'
                WHEN event_id % 7 = 0 AND event_type = 'error' THEN 'signup'
                WHEN event_id % 90 = 0 THEN 'purchase'
                ELSE event_type END AS predicted""",
    )


def many_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as labels that are taken for their neighbours, in chains of 20."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat('n', l_partkey) AS actual",
        """CASE WHEN l_linenumber = 2 AND l_partkey % 20 < 19
                THEN concat('n', l_partkey + 1)
                WHEN l_linenumber = 3 AND l_partkey % 20 > 0
                THEN concat('n', l_partkey - 1)
                ELSE concat('n', l_partkey) END AS predicted""",
    )


def probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as class probabilities."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat(l_returnflag, l_linestatus) AS label",
        "concat('c', l_linenumber) AS class",
        "l_discount AS prob",
    )


CLASSES = [f"c{i}" for i in range(1, 8)]


def order_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as the class probabilities of orders, labelled by priority."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS name", "o_orderpriority AS label"
    )
    items = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS name", "concat('c', l_linenumber) AS class", "l_discount AS prob"
    )
    return items.join(orders, "name")
