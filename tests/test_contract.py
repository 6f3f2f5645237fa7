"""Every registered query next to its SQL twin, at the smallest scale."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from checks.registry import ORACLES, QUERIES
from compare import TABLES, compare

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no tables here")


@pytest.fixture(scope="module")
def connection():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_entry(spark):
    assert contract.entry(spark).columns == ["mode", "conjugation_count"]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and QUERIES.items() <= contract.queries().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    result = compare(spark, connection, SF_DIR, name, contract.queries()[name], contract.oracle_sql()[name])
    assert result.startswith("ok"), result
