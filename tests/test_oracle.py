"""Every registered query against its SQL check."""

import pytest

import __spark_entry__ as entry_module
import check_oracle
from verification.oracle import ORACLE_SQL
from verification.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return check_oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    rows, _, problem = check_oracle.compare(spark, database, name, SF_DIR)
    assert problem is None
    assert rows > 0


def test_every_query_has_sql():
    assert set(ORACLE_SQL) == set(QUERIES)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["language", "usage", "status", "n_files"]
    assert not df.isEmpty()
