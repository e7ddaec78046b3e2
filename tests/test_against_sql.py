"""Every registered query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import math
import re
from collections import Counter
from decimal import Decimal
from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from oracles import all_sql
from tradewind.plans.catalog import build_queries

duckdb = pytest.importorskip("duckdb")

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES = build_queries()
SQL = all_sql()


@pytest.fixture(scope="module")
def database(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def same(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, Decimal):
        return f"dec {value}"
    return value


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, database, name):
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    ours = Counter(tuple(same(r[c]) for c in columns) for r in df.collect())
    cursor = database.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    theirs = Counter(tuple(same(r[i]) for i in at) for r in cursor.fetchall())
    assert ours == theirs


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["check_not_null", "check_unique", "check_fk", "check_non_negative", "check_range", "check_fact_timestamp", "validate_all"])
def test_checks_see_violations(spark, name):
    """On tables large enough for every kind of broken row."""
    checks = QUERIES[name](spark, "/root/testdata/sf0.01").collect()
    found = {(c.check_name, c.table_name): c.violations for c in checks if c.violations}
    assert found
    if name != "check_unique":
        assert {c.check_name for c in checks} == {k for k, _ in found}


def test_statements_take_nothing_from_the_package():
    """Only the texts of the logged statements are shared."""
    for file in Path(__file__).parents[1].glob("oracles/*.py"):
        shared = re.findall(r"^(?:from|import) tradewind.*$", file.read_text(), re.M)
        assert shared in ([], ["from tradewind.sources.testdata import STATEMENTS"])


def test_contract_of_another_type_is_noticed(spark, folder, database, monkeypatch):
    from pyspark.sql import types as T

    from tradewind.schemas import MARTS

    changed = T.StructType([T.StructField(f.name, T.StringType() if f.name == "review_score" else f.dataType) for f in MARTS["fact_orders"]])
    monkeypatch.setitem(MARTS, "fact_orders", changed)
    got = {(r.table_name, r.column_name): r.verdict for r in QUERIES["schema_contract"](spark, folder).collect()}
    assert got["fact_orders", "review_score"] == "other type"
