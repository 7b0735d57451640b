"""Every registered query against its DuckDB oracle text, at sf0.01."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from paths import SF_CHECK
from tickflow.plans.registry import registry
from tools.check_oracle import TABLES, rows_of

NAMES = sorted(registry())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_CHECK}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_oracle_text():
    assert set(NAMES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sdf = queries()[name](spark, SF_CHECK).toPandas()
    odf = duck.sql(oracle_sql()[name]).df()
    scols, srows = rows_of(sdf)
    ocols, orows = rows_of(odf)
    assert scols == ocols
    assert len(srows) == len(orows)
    assert srows == orows


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "symbol"
