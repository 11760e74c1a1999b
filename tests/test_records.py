"""Records of CSV files cut anywhere, against the reader that takes a file whole."""

import csv
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from codeset.sources import readers, records
from verification import queries

SCHEMA = "a string, b string, c string"


@pytest.fixture
def small_blocks(spark):
    size, cost = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = {name: spark.conf.get(name) for name in (size, cost)}
    yield lambda n: (spark.conf.set(size, str(n)), spark.conf.set(cost, "0"))
    for name, value in before.items():
        spark.conf.set(name, value)


def parsed(df):
    rows = df.select("file", "block", "line", F.from_csv("record", SCHEMA, {"escape": '"'}).alias("row"))
    return [tuple(r["row"]) for r in rows.orderBy("file", "block", "line").collect()]


def random_rows(seed, n):
    pick = random.Random(seed)
    field = lambda: "".join(pick.choice(["x", "y", ",", "\n", '"', '""', " ", "é"]) for _ in range(pick.randrange(0, 14)))
    return [(f"r{i}", field() + ".", field() + ".") for i in range(n)]


@pytest.mark.parametrize("block, seed", [(150, 1), (601, 2), (1 << 20, 3)])
def test_records_equal_the_written_rows(spark, tmp_path, small_blocks, block, seed):
    rows = random_rows(seed, 40)
    for number in (0, 1):  # two files
        with open(tmp_path / f"part{number}.csv", "w", newline="", encoding="utf-8") as file:
            csv.writer(file, lineterminator="\n").writerows(rows[number * 20 : number * 20 + 20])
    small_blocks(block)
    found = records.read_records(spark, str(tmp_path))
    if block < 200:
        assert spark.read.text(str(tmp_path), lineSep="\n").rdd.getNumPartitions() > 4
    assert parsed(found) == rows


def test_catalogue_equals_the_whole_file_reader(spark, tmp_path, small_blocks):
    lines = [readers.CATALOG_HEADER]
    for i, (name, text, other) in enumerate(random_rows(3, 60)):
        row = {"ID": i, "Host Type": "GitHub" if i % 3 else "", "Name with Owner": name, "Description": text,
               "Fork": "false", "Language": other if i % 4 else "", "Keywords": "k" if i % 2 else ""}
        lines.append([row.get(column, "") for column in readers.CATALOG_HEADER])
    path = tmp_path / "catalog.csv"
    with open(path, "w", newline="", encoding="utf-8") as file:
        csv.writer(file, lineterminator="\r\n").writerows(lines)
    whole = spark.read.csv(str(path), header=True, multiLine=True, quote='"', escape='"').select(
        F.col("Host Type").alias("host_type"), F.col("Name with Owner").alias("name_with_owner"),
        F.col("Fork").alias("fork"), F.col("Language").alias("language"),
    )
    want = sorted(map(tuple, whole.collect()), key=repr)
    small_blocks(300)
    found = readers.read_repo_catalog(spark, str(path))
    assert sorted(map(tuple, found.collect()), key=repr) == want and len(want) == 60


def test_one_file_is_many_tasks(spark, tmp_path, small_blocks):
    (tmp_path / "one.csv").write_text("".join(f"{i},\"two\nlines\",z\n" for i in range(800)))
    small_blocks(800)
    found = records.read_records(spark, str(tmp_path / "one.csv"))
    assert found.count() == 800
    assert found.select("block").distinct().count() > 10


def test_blank_lines_and_open_quotes(spark, tmp_path, monkeypatch):
    (tmp_path / "blank.csv").write_text("a,b,c\n\n\r\nd,e,f")
    assert parsed(records.read_records(spark, str(tmp_path / "blank.csv"))) == [("a", "b", "c"), ("d", "e", "f")]
    monkeypatch.setattr(records, "MAX_RECORD", 1000)
    (tmp_path / "open.csv").write_text("a,\"b\n" + "line\n" * 500)
    with pytest.raises(ValueError, match="quote is not closed"):
        records.read_records(spark, str(tmp_path / "open.csv"))
    (tmp_path / "empty.csv").write_text("")
    assert records.read_records(spark, str(tmp_path / "empty.csv")).count() == 0


def test_query_writes_and_reads_by_many_tasks(spark, tmp_path, small_blocks, monkeypatch):
    rows = [(i, f'text "{i}"\nof two lines, {"x" * (i % 9)}.', "en") for i in range(300)] + [(None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs.repartition(6).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries, "new_path", lambda spark, name: f"{tmp_path}/{name}")
    small_blocks(4000)
    found = queries.QUERIES["csv_records"](spark, str(tmp_path)).collect()
    want = [(i, lang, hashlib.md5((text or "").encode()).hexdigest()) for i, text, lang in rows]
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    files = list((tmp_path / "documents-csv").glob("part-*.csv"))
    assert len(files) >= 6 and max(f.stat().st_size for f in files) < sum(f.stat().st_size for f in files) / 3
