"""Every operator and stage on awkward rows, empty tables and clashing columns."""

import pytest

import corpus_pipeline
from codeset.llm import (
    line_crf, mixing, packing, pii, quality_rules, secrets, sharding, simhash, token_files,
)
from codeset.llm.tokens import vocabulary_path

OPERATORS = {
    "secrets": lambda docs, labels: secrets.find_secrets(docs),
    "crf": lambda docs, labels: line_crf.score_quality(docs, labels),
    "mixing": lambda docs, labels: mixing.mixture(docs),
    "packing": lambda docs, labels: packing.pack_documents(docs, vocabulary_path()),
    "simhash": lambda docs, labels: simhash.near_duplicates(docs),
    "quality": lambda docs, labels: quality_rules.judge(docs, labels),
    "pii": lambda docs, labels: pii.pseudonymise(docs.select("doc_id", "text"), "key"),
    "sharding": lambda docs, labels: sharding.shard_documents(docs),
    "tokens": lambda docs, labels: token_files.read_token_files(
        token_files.write_token_files(docs, vocabulary_path())
    ),
}


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows(name, awkward, labels):
    found = OPERATORS[name](awkward, labels)
    assert {row["doc_id"] for row in found.collect()} == {1, 2, 3, 4, 5, 6, 7, None, -8}
    if name != "packing":
        assert found.count() == awkward.count()


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(name, empty, labels):
    assert OPERATORS[name](empty, labels.limit(0)).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns(name, awkward, clashing, labels):
    got = OPERATORS[name](clashing, labels)
    want = OPERATORS[name](awkward, labels)
    assert got.columns == want.columns
    assert rows_of(got) == rows_of(want)


@pytest.fixture(scope="module")
def sf_dir(tmp_path_factory, labels):
    folder = tmp_path_factory.mktemp("stage")
    labels.write.parquet(f"{folder}/labels.parquet")
    return str(folder)


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages(stage, spark, awkward, empty, clashing, sf_dir):
    name, run = stage
    assert run(spark, empty, sf_dir).collect() == []
    found = run(spark, clashing, sf_dir)
    if name == "packing":
        return
    assert found.columns == clashing.columns
    plain = run(spark, awkward, sf_dir)
    assert plain.columns == awkward.columns
    assert rows_of(found.select(*awkward.columns)) == rows_of(plain)
    assert {row["quality"] for row in found.select("quality").collect()} <= {"x"}
