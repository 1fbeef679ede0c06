"""The queries that DuckDB can express, against their SQL on the given tables."""

import duckdb
import pytest

from tallyweir.llm import catalog

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    made = catalog.queries()[name](spark, SF_DIR)
    rows, columns = made.collect(), sorted(made.columns)
    with duckdb.connect() as db:
        for table in ("documents", "pages", "benchmark", "conversations"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
        result = db.execute(catalog.oracle_sql()[name])
        names = [d[0] for d in result.description]
        expected = result.fetchall()
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert sorted(repr([r[c] for c in columns]) for r in rows) == sorted(repr([e[i] for i in order]) for e in expected)
