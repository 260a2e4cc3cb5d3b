"""Every query against its SQL on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SF
from tools.check import TABLES, canonical


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, db, name):
    ours = queries()[name](spark, SF).toPandas()
    assert len(ours) > 0
    if name in oracle_sql():
        theirs = db.execute(oracle_sql()[name]).df()
        a, b = canonical(ours), canonical(theirs)
        assert list(a.columns) == list(b.columns) and len(a) == len(b)
        assert ((a == b) | (a.isna() & b.isna())).all().all()


def test_every_rule_fires(spark):
    hits = queries()["rule_hit_counts"](spark, SF).collect()
    assert len(hits) == 13 and all(r.hits > 0 for r in hits)


def test_entry(spark):
    assert entry(spark).columns == ["label", "confidence", "captures", "avg_score"]
