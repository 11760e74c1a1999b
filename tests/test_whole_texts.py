"""Queries on files that are not UTF-8 take the whole of each text."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from verification import views
from verification.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SENTENCE = "La forêt était très âgée, où passaient déjà des élèves, señor Müller n° {}.\n"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """French documents of six sources, every seventh number, with letters beyond ASCII."""
    rows = [
        (7 * i, SENTENCE.format(i) * (i + 1), "fr", f"s{i % 6}", 100) for i in range(1, 60)
    ]
    rows += [(7 * 60, "日本 🙂 é", "fr", "s1", 8), (7 * 61, "a\x85é", "fr", "s1", 3), (7 * 62, None, "fr", "s1", None)]
    path = tmp_path_factory.mktemp("whole")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_bytes_hold_the_whole_text(spark, folder):
    texts = {f"f{r['doc_id']}": r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    number = F.regexp_extract("filename", r"(\d+)", 1)
    files = views.whole_bytes(spark, folder).select(F.concat(F.lit("f"), number).alias("name"), "content").collect()
    assert {f["name"] for f in files} == set(texts)
    kinds = Counter()
    for file in files:
        text, content = texts[file["name"]], file["content"]
        if text is None:
            assert content is None
        elif content.endswith(b"\x00\xff"):
            assert content[:-2].decode() == text
        elif content.endswith(b"\xff"):
            assert content[:-1].decode("cp1252") == text
            kinds["single"] += 1
        else:
            assert content.decode() == text
            kinds["utf-8"] += 1
    assert kinds == {"single": 54, "utf-8": 2}


def test_subset_has_whole_texts(spark, folder):
    """A letter beyond ASCII counts like any other, and so does the byte that ends a single-byte file."""
    whole = {len(SENTENCE.format(i) * (i + 1)) + 1 for i in range(1, 60)}
    found = QUERIES["subset_texts"](spark, folder).collect()
    assert found and all(row["n_chars"] in whole for row in found)
