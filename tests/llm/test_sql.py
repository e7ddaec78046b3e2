"""Queries that have SQL against it, on the given tables."""

from __future__ import annotations

from collections import Counter

import pytest

from tradewind.llm.queries import llm_queries, llm_sql

duckdb = pytest.importorskip("duckdb")


@pytest.mark.parametrize("name", sorted(llm_sql()))
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, name, size):
    folder = f"/root/testdata/{size}"
    connection = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    df = llm_queries()[name](spark, folder)
    columns = sorted(df.columns)
    ours = Counter(tuple(r[c] for c in columns) for r in df.collect())
    cursor = connection.execute(llm_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    assert ours == Counter(tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall())
