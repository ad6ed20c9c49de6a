"""Each query of the library's own operators against its SQL on the smallest tables."""

import duckdb
import pytest

from skjald.plans.reference_queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def shown(value):
    return float(f"{value:.9g}") if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    found = QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    rows = sorted((tuple(shown(row[c]) for c in columns) for row in found.collect()), key=repr)
    if name not in ORACLES:
        assert rows
        return
    wanted = con.sql(ORACLES[name])
    assert sorted(wanted.columns) == columns
    at = [wanted.columns.index(c) for c in columns]
    assert rows == sorted((tuple(shown(row[i]) for i in at) for row in wanted.fetchall()), key=repr)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() >= 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
