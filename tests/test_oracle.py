"""Every registered query at the smallest scale: equal to its SQL, and planned without forbidden steps."""

import duckdb
import pytest

import __spark_entry__ as entry
import verification
from tools.compare import TABLES, compare

ROOT = "/root/testdata/sf0.001"
verification.load_all()
QUERIES, ORACLE = verification.QUERIES, verification.ORACLE

@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{ROOT}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    text, _, ok = compare(spark, con, name, QUERIES[name], ORACLE.get(name), ROOT)
    assert ok or text.startswith("ok rows=0"), text


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_date", "market_segment", "net_revenue", "units_sold", "order_count"]
    assert df.count() > 0
