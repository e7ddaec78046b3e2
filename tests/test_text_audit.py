from __future__ import annotations

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from tradewind.operators import text_audit as audit

CASES = {
    "SELECT * FROM fact_orders LIMIT 5": audit.SQL_OK,
    "WITH x AS (SELECT * FROM fact_orders) SELECT * FROM x": audit.SQL_OK,
    "SELECT rfm_segment, COUNT(*) FROM dim_customers GROUP BY rfm_segment": audit.SQL_OK,
    "SELECT product_id, product_category_name_english FROM dim_products LIMIT 5": audit.SQL_OK,
    "SELECT seller_id, seller_state FROM dim_sellers LIMIT 10": audit.SQL_OK,
    "SELECT date, quarter FROM dim_date LIMIT 10": audit.SQL_OK,
    "SELECT product_id, SUM(revenue) FROM fact_sales GROUP BY product_id": audit.SQL_OK,
    "SELECT * FROM public.fact_orders LIMIT 5": audit.SQL_OK,
    "DELETE FROM fact_orders": audit.SQL_NOT_SELECT,
    "DROP TABLE fact_orders": audit.SQL_NOT_SELECT,
    "SELECT * FROM fact_orders; DROP TABLE fact_orders;": audit.SQL_MANY,
    "": audit.SQL_EMPTY,
    " \n\t  ": audit.SQL_EMPTY,
    "UPDATE products SET price = 0": audit.SQL_NOT_SELECT,
    "TRUNCATE TABLE order_items": audit.SQL_NOT_SELECT,
    "INSERT INTO sellers VALUES (...)": audit.SQL_NOT_SELECT,
    # A trailing semicolon is fine, a second one is not.
    " select * from fact_orders ;  ": audit.SQL_OK,
    "select * from fact_orders;;": audit.SQL_MANY,
    # Whole words only.
    "SELECT created_at, updates FROM fact_orders": audit.SQL_OK,
    "SELECT 1 FROM fact_orders WHERE x = drop": audit.SQL_FORBIDDEN,
    "SELECT édrop FROM fact_orders": audit.SQL_OK,
    "SELECT a\nINTO b FROM fact_orders": audit.SQL_INTO,
    "SELECT * FROM pg_catalog.pg_class": audit.SQL_SYSTEM,
    "SELECT 1": audit.SQL_NO_TABLE,
    "WITH a AS (SELECT 1) SELECT * FROM a": audit.SQL_NO_BASE,
    "SELECT * FROM Payments_Raw JOIN fact_orders": "Table 'Payments_Raw' is not allowed.",
    "SELECT * FROM FACT_ORDERS": audit.SQL_OK,
    # Known false results of a guard made of patterns.
    "SELECT extract(year from order_date) FROM fact_orders": "Table 'order_date' is not allowed.",
    "SELECT * FROM fact_orders WHERE s = 'a;b'": audit.SQL_MANY,
    "SELECT 'delete' FROM fact_orders": audit.SQL_FORBIDDEN,
    "SELECT * FROM fact_orders, secret_table": audit.SQL_OK,
    'SELECT * FROM fact_orders JOIN "secret"': audit.SQL_OK,
    "SELECT * FROM other.fact_orders": audit.SQL_OK,
    "WITH secret AS (SELECT 1) SELECT * FROM fact_orders JOIN secret": audit.SQL_OK,
}


@pytest.fixture(scope="module")
def verdicts(spark):
    log = spark.createDataFrame([(s,) for s in CASES], "sql string")
    return {r.sql: (r.message, r.is_valid) for r in audit.audit_sql_log(log).collect()}


@pytest.mark.parametrize("sql", list(CASES))
def test_sql(verdicts, sql):
    assert verdicts[sql] == (CASES[sql], CASES[sql] == audit.SQL_OK)


def test_names(spark):
    text = "WITH A as (SELECT 1 FROM s.t1), b AS(SELECT * FROM A), a as (x) SELECT * FROM b join T2 on 1=1"
    df = spark.createDataFrame([(text,)], "q string")
    got = df.select(audit.table_refs(F.col("q")), audit.cte_names(F.col("q"))).first()
    assert got[0] == ["t1", "A", "b", "T2"]
    assert got[1] == ["a", "b"]


def test_usage(spark):
    log = spark.createDataFrame([("select 1 from a join a",), ("select 1 from b",), ("select 1",)], "sql string")
    assert sorted(rows(audit.table_usage(log))) == [("a", 2), ("b", 1)]


@pytest.mark.parametrize(
    "text,message",
    [
        ("What is the monthly revenue?", audit.QUESTION_OK),
        ("   ", audit.QUESTION_EMPTY),
        ("Please DELETE all rows", audit.QUESTION_FORBIDDEN),
        ("create table x", audit.QUESTION_FORBIDDEN),
        ("which orders were updated or dropped?", audit.QUESTION_OK),
        ("x " * 5000 + "remove", audit.QUESTION_FORBIDDEN),
    ],
)
def test_questions(spark, text, message):
    df = spark.createDataFrame([(text,)], "text string")
    assert audit.audit_questions(df).first().message == message


@pytest.mark.parametrize(
    "text,bare",
    [
        ("```sql\nSELECT 1\n```", "SELECT 1"),
        ("```SQL SELECT 1```", "SELECT 1"),
        ("```\nSELECT 1\n```  ", "SELECT 1"),
        ("SELECT 1", "SELECT 1"),
        ("SELECT '```' FROM t", "SELECT '```' FROM t"),
        ("```sql\n```", ""),
    ],
)
def test_fences(spark, text, bare):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(audit.strip_fences(F.col("t"))).first()[0] == bare


def test_question_key(spark):
    df = spark.createDataFrame([("  What IS it?\n",)], "q string")
    expected = hashlib.sha256(b"what is it?").hexdigest()
    assert df.select(audit.question_key(F.col("q"))).first()[0] == expected


def test_recent_questions(spark):
    def at(minute):
        return datetime(2024, 1, 1, 0, minute)

    asked = [("s", q, at(i)) for i, q in enumerate("abcdefg")] + [("s", "a", at(30)), ("t", "z", at(1))]
    df = spark.createDataFrame(asked, "session string, q string, at timestamp_ntz")
    got = audit.recent_questions(df, "session", "q", "at").orderBy("session", "position").collect()
    # Asking again moves a question up; only five stay.
    assert [r.q for r in got if r.session == "s"] == ["a", "g", "f", "e", "d"]
    assert [r.q for r in got if r.session == "t"] == ["z"]
