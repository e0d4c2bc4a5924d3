"""Every registered query against its DuckDB oracle on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import digest
from slotwise.plans.catalog import QUERIES
from slotwise.plans.oracle import ORACLE
from slotwise.sources.tables import TABLES
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["sa", "sp", "rd", "im", "uom", "ds", "rec_type"]
    assert df.count() > 0


def test_registered():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert digest(rows, df.columns)[0] == digest(orows, rel.columns)[0]
