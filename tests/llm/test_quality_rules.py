"""Measures by hand, binomial sums exactly, and the whole query by SQL."""

import random
import re
from collections import Counter
from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import functions as F

import check_oracle
from codeset.llm import quality_rules


def brute_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(inside),
    )


def measures_of(df):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return {row["doc_id"]: tuple(row[n] for n in names) for row in df.collect()}


def test_measures(spark):
    random.seed(7)
    texts = ["", " \x0b\x1c\x85", "a\n\na\n b\nb", "# $ <é> 🙂🙂", None, "w " * 500]
    for _ in range(300):
        words = random.choices(["a", "b", "cc", "#", "é"], k=random.randint(0, 60))
        texts.append("".join(w + random.choice([" ", "\n", "\t ", "\x0c"]) for w in words))
        texts.append(" ".join(map(str, range(30))) + " " + texts[-1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = measures_of(quality_rules.with_measures(docs))
    for i, text in enumerate(texts):
        assert found[i] == brute_measures(text), text


@pytest.mark.parametrize("n, k, p", [(10, 0, 0.1), (50, 3, 0.05), (2000, 12, 0.01), (100_000, 130, 0.0016), (5, 5, 0.3)])
def test_binomial_sum(spark, n, k, p):
    exact = Fraction(p)
    want = sum(comb(n, i) * exact**i * (1 - exact) ** (n - i) for i in range(k + 1)) if n < 5000 else None
    row = spark.range(1).select(
        quality_rules.binomial_cdf(F.lit(k).cast("long"), F.lit(n).cast("long"), p)
    ).first()[0]
    if want is not None:
        assert row == pytest.approx(float(want), rel=1e-9)
    else:  # the normal approximation
        assert row == pytest.approx(0.01, abs=0.01)


def test_risk_is_bounded(spark):
    """A cutoff that rejects too many good documents is never certified."""
    random.seed(2)
    good = [("good " * 30 + "# " * (i % 100 < 3) * 3, 1) for i in range(4000)]
    bad = [("bad " * 15 + "one two # $ % " * 12, 0) for _ in range(200)]
    rows = [(i, f"w{i} " + " ".join(f"{x}{j}" for j, x in enumerate(t.split())), "en", q)
            for i, (t, q) in enumerate(good + bad)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    judged = quality_rules.judge(docs, docs.select("doc_id", "quality"), risk=0.06)
    lost = {row["doc_id"] for row in judged.where("not kept").collect()}
    assert lost == set(range(4000, 4200))
    few = docs.where("doc_id < 100 or doc_id >= 4150")
    assert quality_rules.judge(few, few.select("doc_id", "quality")).where("not kept").isEmpty()


def test_fresh_rows_are_rejected_less_than_the_risk(spark):
    """Levels certified on half of the labels hold on the other half."""
    sf_dir = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    half = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    judged = quality_rules.judge(docs, labels.where(half), risk=0.02)
    fresh = judged.join(labels.where(~half), "doc_id").where("not base_failed")
    rates = {
        row["quality"]: row["rate"]
        for row in fresh.groupBy("quality").agg(F.avg((~F.col("kept")).cast("int")).alias("rate")).collect()
    }
    assert rates[1] < 0.02 and rates[0] > 0.1


@pytest.mark.parametrize("scale", ["0.001", "0.1"])
def test_query_equals_sql(spark, scale):
    sf_dir = f"/root/testdata/sf{scale}"
    database = check_oracle.connect(sf_dir)
    rows, _, problem = check_oracle.compare(spark, database, "op7_quality_rules", sf_dir)
    assert problem is None and rows > 0


def test_levels_are_certified(spark):
    sf_dir = "/root/testdata/sf0.1"
    tables = [spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels")]
    assert not quality_rules.judge(*tables).where("not kept and not base_failed").isEmpty()


def test_no_python(documents, labels):
    plan = quality_rules.judge(documents, labels)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
