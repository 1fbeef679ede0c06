"""Every registered query against its SQL twin."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from tallyweir.plans import catalog, oracles

SF_DIR = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

#: Tested by recall instead.
APPROXIMATE = {"vector_hashed_topk"}

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _comparable(frame):
    columns = sorted(frame.columns)
    rows = frame[columns].astype(object).where(frame[columns].notna(), None).values.tolist()
    return columns, sorted(map(repr, ([v.item() if hasattr(v, "item") else v for v in row] for row in rows)))


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) - set(oracles.oracle_sql()) == APPROXIMATE
    assert set(catalog.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    found = _comparable(entry.queries()[name](spark, str(SF_DIR)).toPandas())
    wanted = _comparable(duck.execute(entry.oracle_sql()[name]).df())
    assert found == wanted
    assert found[1]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
