"""The source audit against loops over all groups and terms."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from codeset.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string"


def brute(rows, top):
    rows = [((lang or ""), (source or ""), TERM.findall((text or "").translate(LOWER))) for _, text, lang, source in rows]
    out = []
    for lang in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == lang]
        df = Counter(term for _, _, terms in own for term in set(terms))
        kept = sorted(t for t, n in df.items() if n >= 3)
        counts = defaultdict(Counter)
        for _, source, terms in own:
            counts[source].update(t for t in terms if df[t] >= 3)
        whole = sum(counts.values(), Counter())

        def shares(c):
            return {t: 1 + 1_000_000_000 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}

        p = {source: shares(c) for source, c in counts.items()}
        q = shares(whole)
        for source in counts:
            pairs = [
                (o, sum((p[source][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in counts if o != source
            ]
            terms = [(t, (p[source][t] - q[t]) ** 2 // q[t]) for t in kept if counts[source][t] and p[source][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, source, part, i, v, rank) for rank, (i, v) in enumerate(found[:limit], 1)]
    return sorted(out)


def found(df, **options):
    rows = divergence.audit(df, **options)
    assert rows.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, rows.collect()))


def random_rows(seed, n):
    rng = np.random.default_rng(seed)
    words = ["the", "of", "É", "größe", "seventeen" * 2, "twelveletter", "eightlet", "x" * 70, "A", "b", "zz"]
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else f"s{i % 5}"
        bias = words[: 4 + i % 5]
        rows.append((i, " 1,".join(rng.choice(bias, int(rng.integers(0, 30)))), ["en", "de", None][i % 7 % 3], source))
    return rows


@pytest.mark.parametrize("bucket_rows, cells", [(200_000, 1 << 21), (5, 7)])
def test_equals_loops(spark, monkeypatch, bucket_rows, cells):
    """Also with many buckets and tables of one term at a time."""
    monkeypatch.setattr(divergence, "BUCKET_ROWS", bucket_rows)
    monkeypatch.setattr(divergence, "CELLS", cells)
    rows = random_rows(1, 120)
    assert found(spark.createDataFrame(rows, SCHEMA), top=4) == brute(rows, 4)


def test_awkward_rows(spark):
    rows = [(1, None, "en", "a"), (2, "", None, None), (3, "x x x", "en", "a"), (3, "x x x", "en", "a"), (4, "x", "en", "b"),
            (5, "123 !", "en", "c"), (6, "y", "fr", "a"), (6, "y", "fr", "b"), (None, "x " * 20_000, "en", "b")]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows, 200)
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_clashing_columns(spark):
    rows = random_rows(2, 30)
    df = spark.createDataFrame(rows, SCHEMA)
    more = {name: F.lit("x") for name in ("term", "times", "docs", "p", "q", "bucket", "rank", "part", "item", "value", "_text", "kept", "total")}
    assert found(df.withColumns(more)) == found(df)


def test_long_counts_are_exact(spark):
    """Products beyond 64 bits stay exact."""
    df = spark.range(1).select(F.lit(10**12).alias("c"), F.lit(3 * 10**12).alias("n"), F.lit(7).alias("v"))
    assert df.select(divergence.probability("c", "n", "v")).first()[0] == 1 + 10**9 * (10**12 + 1) // (3 * 10**12 + 7)
