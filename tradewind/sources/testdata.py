"""Maps a TPC-H-like set of Parquet tables to the raw marketplace tables.

Each function returns one raw table, with a source position where rows repeat. How to join is left to
the optimizer, which knows the sizes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.columns import plus_days, plus_seconds
from tradewind.schemas import MONEY, POSITION

DAY = 86400
ITEM_FACT = "fact_order_item_sales"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _money(name: str) -> Column:
    return F.col(name).cast(MONEY)


def _places(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name"
    )


def _line_position() -> Column:
    return F.struct(
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_shipdate",
    ).alias(POSITION)


def orders(spark: SparkSession, folder: str) -> DataFrame:
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    purchase = plus_seconds(day, (k * 37) % DAY)
    arrived = plus_seconds(day, (5 + k % 23) * DAY + (k * 53) % DAY)
    has_arrived = ((F.col("o_orderstatus") == "F") & (k % 50 != 0)) | (
        (F.col("o_orderstatus") == "P") & (k % 97 == 0)
    )
    status = (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .when(F.col("o_orderstatus") == "P", "canceled")
    )
    return table(spark, folder, "orders").select(
        k.cast("string").alias("order_id"),
        k.cast("string").alias("customer_id"),
        status.alias("order_status"),
        purchase.alias("order_purchase_timestamp"),
        plus_seconds(purchase, F.lit(3600)).alias("order_approved_at"),
        plus_days(day, F.lit(2)).alias("order_delivered_carrier_date"),
        F.when(has_arrived, arrived).alias("order_delivered_customer_date"),
        plus_days(day, 10 + k % 20).alias("order_estimated_delivery_date"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    people = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    placed = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return (
        placed.join(people, c == F.col("c_custkey"))
        .join(_places(spark, folder), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            k.cast("string").alias("customer_id"),
            F.when(k % 10 < 7, F.concat(F.lit("u"), k.cast("string")))
            .otherwise(F.concat(F.lit("c"), c.cast("string")))
            .alias("customer_unique_id"),
            (c % 100000).cast("int").alias("customer_zip_code_prefix"),
            F.when(k % 60 == 8, F.concat("n_name", F.lit("_MOVED")))
            .otherwise(F.col("n_name"))
            .alias("customer_city"),
            F.col("r_name").alias("customer_state"),
        )
    )


def _item_details(at: str = "") -> dict[str, Column]:
    """Columns of an item that follow from the fields of its position; ``at`` stands before their names."""
    return {
        "product_id": F.col(f"{at}l_partkey").cast("string"),
        "seller_id": F.col(f"{at}l_suppkey").cast("string"),
        "shipping_limit_date": F.col(f"{at}l_shipdate"),
        "price": _money(f"{at}l_extendedprice"),
        "freight_value": _money(f"{at}l_quantity"),
    }


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        *(column.alias(c) for c, column in _item_details().items()),
        _line_position(),
    )


def _payment_details(at: str = "") -> dict[str, Column]:
    """The same of a payment."""
    price, discount, tax = (
        F.col(f"{at}{c}").cast("decimal(12,2)") for c in ("l_extendedprice", "l_discount", "l_tax")
    )
    value = price * (1 - discount) * (1 + tax)
    return {
        "payment_installments": F.col(f"{at}l_quantity").cast("int"),
        "payment_value": F.round(value, 2).cast(MONEY),
    }


def order_payments(spark: SparkSession, folder: str) -> DataFrame:
    kind = (
        F.when(F.col("l_returnflag") == "R", "credit_card")
        .when(F.col("l_returnflag") == "A", "boleto")
        .when(F.col("l_returnflag") == "N", "voucher")
    )
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        kind.alias("payment_type"),
        *(column.alias(c) for c, column in _payment_details().items()),
        _line_position(),
    )


def order_reviews(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    digit = F.substring("o_orderpriority", 1, 1).cast("int")

    def review(prefix: str, score: Column) -> Column:
        return F.struct(
            F.concat(F.lit(prefix), k.cast("string")).alias("review_id"),
            score.cast("double").alias("review_score"),
        )

    estimate = plus_days(F.col("o_orderdate"), 10 + k % 20)
    reviews = F.array_compact(
        F.array(F.when(k % 11 != 0, review("r", 6 - digit)), F.when(k % 13 == 0, review("s", digit)))
    )
    return (
        table(spark, folder, "orders")
        .select("o_orderkey", "o_orderpriority", "o_orderdate", F.explode(reviews).alias("review"))
        .select(
            "review.review_id",
            k.cast("string").alias("order_id"),
            "review.review_score",
            F.lit(None).cast("string").alias("review_comment_title"),
            F.when(k % 3 != 0, F.col("o_orderpriority")).alias("review_comment_message"),
            estimate.alias("review_creation_date"),
            plus_days(estimate, F.lit(1)).alias("review_answer_timestamp"),
        )
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size").cast("double")
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.when(F.col("p_partkey") % 40 != 0, F.col("p_type")).alias("product_category_name"),
        F.length("p_name").cast("double").alias("product_name_lenght"),
        (size * 10).alias("product_description_lenght"),
        (F.col("p_size") % 5).cast("double").alias("product_photos_qty"),
        F.col("p_retailprice").alias("product_weight_g"),
        size.alias("product_length_cm"),
        size.alias("product_height_cm"),
        size.alias("product_width_cm"),
    )


def sellers(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "supplier")
        .join(_places(spark, folder), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").cast("string").alias("seller_id"),
            F.col("s_suppkey").cast("int").alias("seller_zip_code_prefix"),
            F.col("n_name").alias("seller_city"),
            F.col("r_name").alias("seller_state"),
        )
    )


def category_translation(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "part")
        .where(F.col("p_type") != "PROMO")
        .select(F.col("p_type").alias("product_category_name"))
        .distinct()
        .withColumn("product_category_name_english", F.lower("product_category_name"))
    )


READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "customers": customers,
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "products": products,
    "sellers": sellers,
    "category_translation": category_translation,
}


def raw_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return READERS[name](spark, folder)


def by_position(name: str) -> dict[str, Column]:
    """Columns of a raw table as expressions of its position."""
    made = {"order_items": _item_details, "order_payments": _payment_details}
    return made[name](f"{POSITION}.") if name in made else {}


# --- inputs of the text and vector jobs -----------------------------------------------------------

# Statements a log may hold: accepted ones, one per rule that rejects, and the known false results.
# {n} is replaced by a number taken from the event.
STATEMENTS: tuple[str, ...] = (
    "SELECT order_status, COUNT(*) FROM fact_orders WHERE review_score < {n} GROUP BY order_status",
    "WITH recent AS (SELECT * FROM fact_orders) SELECT * FROM recent LIMIT {n}",
    "SELECT * FROM public.fact_sales LIMIT {n};",
    "select s.seller_state, sum(f.revenue) from fact_sales f join dim_sellers s using (seller_id) group by 1",
    "DELETE FROM fact_orders WHERE order_id = '{n}'",
    "DROP TABLE dim_customers",
    "SELECT {n}; SELECT 2",
    "   ",
    "SELECT * FROM raw_payments_{n}",
    "SELECT *\nINTO backup_{n}\nFROM fact_orders",
    "SELECT * FROM information_schema.tables",
    "SELECT {n} + 1",
    "WITH a AS (SELECT {n} AS x) SELECT x FROM a",
    "SELECT extract(year FROM order_date), COUNT(*) FROM fact_orders GROUP BY 1",
    "SELECT * FROM fact_orders WHERE order_status = 'a;b'",
    "SELECT 'please update' AS note FROM fact_orders",
    "EXPLAIN SELECT * FROM fact_orders",
    "  SELECT product_id FROM Dim_Products ;  ",
    "SELECT d.year FROM fact_orders, dim_date d WHERE d.year > {n}",
    "SELECT created_at, updated FROM FACT_ORDERS",
    "WITH a AS (\n  SELECT * FROM fact_orders\n), b AS (SELECT * FROM a)\n"
    "SELECT * FROM b JOIN dim_date ON b.order_date = dim_date.date",
    "WITH secret AS (SELECT {n}) SELECT * FROM fact_sales JOIN secret ON true",
    "WITH hidden AS (SELECT 1) SELECT * FROM hidden JOIN other_table ON true",
    "TRUNCATE TABLE fact_sales",
)


def sql_log(spark: SparkSession, folder: str) -> DataFrame:
    """One statement per event."""
    texts = F.array(*(F.lit(s) for s in STATEMENTS))
    number = (F.col("event_id") % 97).cast("string")
    pick = (F.col("event_id") % len(STATEMENTS)).cast("int")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("log_id"),
        F.col("user_id").alias("session_id"),
        F.replace(F.get(texts, pick), F.lit("{n}"), number).alias("sql"),
    )


def model_answers(spark: SparkSession, folder: str) -> DataFrame:
    """The statements as a model might return them: bare or inside a Markdown fence."""
    kind = F.col("log_id") % 4
    sql = F.col("sql")
    return sql_log(spark, folder).select(
        "log_id",
        F.when(kind == 1, F.concat(F.lit("```sql\n"), sql, F.lit("\n```")))
        .when(kind == 2, F.concat(F.lit("```\n"), sql, F.lit("```\n")))
        .when(kind == 3, F.concat(F.lit(" \t```SQL "), sql, F.lit(" ```  ")))
        .otherwise(sql)
        .alias("answer"),
    )


def questions(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "conversations")
        .where(F.col("role") == "user")
        .select("conv_id", "turn", "text")
    )


def _statement(number: Column) -> Column:
    texts = F.array(*(F.lit(s) for s in STATEMENTS))
    return F.get(texts, (number % len(STATEMENTS)).cast("int"))


def similarity_cache(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector as a stored question with some SQL."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("cache_id"),
        F.col("embedding").alias("vector"),
        _statement(F.col("vec_id")).alias("sql"),
    )


def similarity_queries(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector as a question: even ids slightly distorted, odd ids back to front."""
    v = F.col("embedding")
    distorted = F.transform(
        v, lambda x, i: F.when(i % 2 == 0, (x.cast("double") * 1.1).cast("float")).otherwise(x)
    )
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("query_id"),
        F.when(F.col("vec_id") % 2 == 0, distorted).otherwise(F.reverse(v)).alias("vector"),
    )


def answered_questions(spark: SparkSession, folder: str) -> DataFrame:
    """New cache entries: some replace a stored question, some are new, some asked twice."""
    n = F.col("vec_id")
    return table(spark, folder, "embeddings").select(
        n.alias("position"),
        F.when(n % 3 == 0, F.concat(F.lit(" Question "), F.floor(n / 2).cast("string")))
        .otherwise(F.concat(F.lit("follow-up "), F.floor(n / 4).cast("string")))
        .alias("question"),
        F.col("embedding").alias("vector"),
        _statement(n + 1).alias("sql"),
    )


def stored_questions(spark: SparkSession, folder: str) -> DataFrame:
    n = F.col("vec_id")
    return table(spark, folder, "embeddings").select(
        F.concat(F.lit("question "), n.cast("string")).alias("question"),
        F.col("embedding").alias("vector"),
        _statement(n).alias("sql"),
    )


# --- broken rows and files ------------------------------------------------------------------------


def _every(n: int, key: str = "order_id") -> Column:
    return F.col(key).cast("bigint") % n == 0


def _without(column: str, gone: Column) -> Column:
    return F.when(~gone, F.col(column))


def _lost_order() -> Column:
    """Some orders without id, some with an id that no order has."""
    return F.when(_every(131), None).when(_every(113), "-1").otherwise(F.col("order_id"))


def _signed(column: str, wrong: Column) -> Column:
    return F.when(wrong, -F.col(column)).otherwise(F.col(column))


def broken(name: str, cleaned: DataFrame) -> DataFrame:
    """A cleaned table, or the item fact, in which some rows break each of its rules."""
    made: dict[str, Callable[[], dict[str, Column]]] = {
        "customers": lambda: {"customer_id": _without("customer_id", _every(139, "customer_id"))},
        "orders": lambda: {
            "order_id": _without("order_id", _every(149)),
            "customer_id": F.when(_every(101), None)
            .when(_every(103), F.concat(F.lit("nobody "), F.col("customer_id")))
            .otherwise(F.col("customer_id")),
        },
        "order_items": lambda: {
            "order_item_id": _without("order_item_id", _every(137)),
            "order_id": _lost_order(),
            "product_id": F.when(_every(109), None).when(_every(127), "none").otherwise(F.col("product_id")),
            "seller_id": F.when(_every(127), None).when(_every(109), "none").otherwise(F.col("seller_id")),
            "price": _signed("price", _every(107)),
            "freight_value": _signed("freight_value", _every(109)),
        },
        "order_payments": lambda: {
            "order_id": _lost_order(),
            "payment_sequential": _without("payment_sequential", _every(137)),
            "payment_value": _signed("payment_value", _every(107)),
        },
        "order_reviews": lambda: {
            "review_id": _without("review_id", _every(137)),
            "order_id": _lost_order(),
            "review_score": F.when(_every(107), 0.0).when(_every(109), 5.9).when(_every(127), None)
            .otherwise(F.col("review_score")),
        },
        "products": lambda: {"product_id": _without("product_id", _every(17, "product_id"))},
        "sellers": lambda: {"seller_id": _without("seller_id", _every(3, "seller_id"))},
        "category_translation": lambda: {
            "product_category_name": _without(
                "product_category_name", F.col("product_category_name").startswith("S")
            )
        },
        ITEM_FACT: lambda: {
            column: _without(column, _every(n))
            for column, n in (
                ("order_id", 131), ("order_item_id", 137), ("product_id", 109), ("seller_id", 127),
                ("price", 107), ("freight_value", 113), ("revenue", 103),
                ("order_purchase_timestamp", 101),
            )
        },
    }
    return cleaned.withColumns(made[name]())


def as_file_text(name: str, raw: DataFrame) -> DataFrame:
    """A raw table as a file may hold it: whole numbers and scores with a fraction, amounts beyond ten
    digits, words in place of numbers, quotes, line breaks and words for missing values."""
    def with_end(column: str, end: str) -> Column:
        return F.concat(F.col(column).cast("int").cast("string"), F.lit(end))

    made: dict[str, dict[str, Column]] = {
        "order_items": {
            "order_item_id": F.when(_every(7), with_end("order_item_id", ".5"))
            .when(_every(2), with_end("order_item_id", ".0"))
            .otherwise(F.col("order_item_id").cast("string")),
            "price": F.when(_every(11), "98765432109.87").otherwise(F.col("price").cast("string")),
        },
        "order_payments": {
            "payment_value": F.when(_every(13), "abc").otherwise(F.col("payment_value").cast("string"))
        },
        "order_reviews": {
            "review_score": F.when(_every(17), with_end("review_score", ".9"))
            .otherwise(F.col("review_score").cast("string")),
            "review_comment_title": F.lit("n/a"),
            "review_comment_message": F.concat(
                F.col("review_comment_message"), F.lit('\nsaid "fine", twice')
            ),
        },
    }
    return raw.withColumns(made.get(name, {}))


# --- text columns with bad values, for the coercions ----------------------------------------------


def price_text(spark: SparkSession, folder: str) -> DataFrame:
    """Prices as text: words, empty text, a third decimal, blanks around, plain."""
    text = _money("l_extendedprice").cast("string")
    kind = F.col("l_orderkey") % 6
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(kind == 0, "abc")
        .when(kind == 1, "")
        .when(kind == 2, F.concat(text, F.lit("5")))
        .when(kind == 3, F.concat(F.lit(" "), text, F.lit(" ")))
        .otherwise(text)
        .alias("price"),
    )


def purchase_text(spark: SparkSession, folder: str) -> DataFrame:
    """Purchase times as text: words, missing, with fractions of a second, plain."""
    k = F.col("o_orderkey")
    text = F.concat(
        F.col("o_orderdate").cast("date").cast("string"),
        F.lit(" 10:30:"),
        F.lpad((k % 60).cast("string"), 2, "0"),
    )
    return table(spark, folder, "orders").select(
        k.alias("o_orderkey"),
        F.when(k % 7 == 0, "not-a-date")
        .when(k % 7 == 1, None)
        .when(k % 7 == 2, F.concat(text, F.lit(".75")))
        .otherwise(text)
        .alias("order_purchase_timestamp"),
    )
