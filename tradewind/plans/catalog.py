"""Every operator as a named query over one folder of Parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.columns import iso_text, plus_days
from tradewind.operators import profiling, quality, shaping, similarity, text_audit
from tradewind.operators.dedup import dedup_keep_first
from tradewind.operators.upsert import MonthlyTable, incremental_filter, write_monthly
from tradewind.plans import adhoc, incremental, kept_reports, kpis, marts, reports
from tradewind.plans.batch import REPORT_MARTS
from tradewind.plans.cleaning import coerce_numeric, coerce_timestamp
from tradewind.plans.staging import stage
from tradewind.plans.warehouse import ITEM_SALES, THREADS, Warehouse
from tradewind.schemas import MARTS, POSITION, RAW, RULES, STORED_NAME
from tradewind.session import file_system, fresh_path, small_splits
from tradewind.sources import sinks, testdata
from tradewind.sources.csv_files import extract_all, extract_text, unreadable
from tradewind.streaming import order_feed

Query = Callable[[SparkSession, str], DataFrame]

_OPEN: dict[tuple, Warehouse] = {}


def _state(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of what lies in a folder."""
    files, where = file_system(spark, folder)
    return tuple(
        sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in files.listStatus(where))
    )


def open_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """One warehouse per session and state of the source folder, so stored layers are shared by the
    queries and changed source files are seen."""
    key = (spark.sparkContext.applicationId, folder, _state(spark, folder))
    if key not in _OPEN:
        reading = small_splits(spark)
        _OPEN[key] = Warehouse(
            reading, lambda name: testdata.raw_table(reading, folder, name), late=testdata.by_position
        )
    return _OPEN[key]


def _on(plan: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, folder: plan(open_warehouse(spark, folder))


def _on_flat(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return _on(lambda w: plan(w.mart("flat_items")))


def _on_orders(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return _on(lambda w: plan(reports.read_orders(w.mart("fact_orders"))))


def _on_rollup(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return _on(lambda w: plan(profiling.order_level_rollup(w.mart("flat_items"))))


def _sales(w: Warehouse) -> DataFrame:
    return reports.read_sales(
        w.mart("fact_sales"), w.mart("fact_orders"), w.mart("dim_products")
    )


def _top_categories(w: Warehouse) -> DataFrame:
    return reports.top_categories_of_marts(
        w.mart("fact_sales"), w.mart("fact_orders"), w.mart("dim_products")
    )


# --- sources and sinks ----------------------------------------------------------------------------


def _as_text(df: DataFrame, label: str, name: str) -> DataFrame:
    """Every row as one text of all its values, by column name, so tables can be compared whole."""

    def text(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            column = F.floor(column * 1e6)  # In millionths.
        elif isinstance(field.dataType, T.TimestampNTZType):
            column = iso_text(column)
        return F.coalesce(column.cast("string"), F.lit("~"))

    fields = sorted(df.schema.fields, key=lambda f: f.name)
    return df.select(
        F.lit(name).alias(label), F.concat_ws("|", *(text(f) for f in fields)).alias("fields")
    )


def _raw_files(spark: SparkSession, folder: str) -> str:
    """All raw tables as CSV files, each in two parts whose headers name the columns in another order."""
    w, out = open_warehouse(spark, folder), fresh_path(spark, "csv")

    def write(part: tuple[str, int]) -> None:
        name, nth = part
        columns = RAW[name].fieldNames()
        rows = testdata.as_file_text(name, w.raw(name)).select(*columns)
        half = rows.where(F.pmod(F.xxhash64(*columns), F.lit(2)) == nth)
        half = half.select(*columns[::-1]) if nth else half
        sinks.write_csv_table(half, f"{out}/{name}/{('first', 'second')[nth]}")

    # Small tables fill the gaps of large ones.
    with ThreadPoolExecutor(THREADS) as pool:
        list(pool.map(write, [(name, nth) for name in RAW for nth in (0, 1)]))
    return out


def ingest_csv(spark: SparkSession, folder: str) -> DataFrame:
    """All eight raw tables through CSV files with awkward values, in full."""
    tables = extract_all(spark, _raw_files(spark, folder), {name: name for name in RAW})
    return quality.union_all(
        [_as_text(df.drop(POSITION), "table_name", name) for name, df in tables.items()]
    )


def csv_unreadable(spark: SparkSession, folder: str) -> DataFrame:
    """Texts per column of the same files that their type cannot hold."""
    tables = extract_text(spark, _raw_files(spark, folder), {name: name for name in RAW})
    return quality.union_all([unreadable(df, name) for name, df in tables.items()])


def load_full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Contents of every stored table after a full refresh."""
    bundle = open_warehouse(spark, folder).to_store()
    paths = sinks.load_full_refresh(bundle, fresh_path(spark, "load"))

    def stored(name: str) -> DataFrame:
        rows = spark.read.parquet(paths[name])
        return _as_text(rows, "table_name", STORED_NAME.get(name, name))

    return quality.union_all([stored(name) for name in bundle])


def _broken(w: Warehouse, name: str) -> DataFrame:
    return testdata.broken(name, w.mart(name) if name == ITEM_SALES else w.cleaned(name))


def _quality_report(w: Warehouse) -> DataFrame:
    return quality.quality_report(
        w.raw_all(), {**w.cleaned_all(), ITEM_SALES: w.mart(ITEM_SALES)}
    )


def write_quality_report(spark: SparkSession, folder: str) -> DataFrame:
    report, path = _quality_report(open_warehouse(spark, folder)), fresh_path(spark, "report")
    sinks.write_quality_report(report, path)
    return spark.read.schema(report.schema).json(path)


def write_summary_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Contents of each summary, read back from its CSV file."""
    w = open_warehouse(spark, folder)
    tables = reports.summaries(*(w.mart(name) for name in REPORT_MARTS))
    paths = sinks.write_summary_csv(tables, fresh_path(spark, "summaries"))

    def back(name: str) -> DataFrame:
        rows = spark.read.schema(tables[name].schema).option("header", True).csv(paths[name])
        return _as_text(rows, "summary", name)

    return quality.union_all([back(name) for name in tables])


# --- incremental load -----------------------------------------------------------------------------

BATCH_DAYS = 3
STALE_DAYS = 10


def _cut(fact: DataFrame, column: str, days: int) -> Column:
    newest = fact.agg(F.max(F.col(column).cast("timestamp_ntz"))).scalar()
    return plus_days(newest, F.lit(-days))


def _yesterday(fact: DataFrame, column: str, mark: str, value: object) -> DataFrame:
    """The fact as it stood some days ago, with outdated values in its last days.

    A refresh brings the missing days and corrects outdated rows inside the lookback; older
    outdated rows stay.
    """
    at = F.col(column).cast("timestamp_ntz")
    outdated = at >= _cut(fact, column, STALE_DAYS)
    stale = F.when(outdated, F.lit(value).cast(fact.schema[mark].dataType)).otherwise(F.col(mark))
    return fact.where(at < _cut(fact, column, BATCH_DAYS)).withColumn(mark, stale)


def lookback_rows(spark: SparkSession, folder: str) -> DataFrame:
    w = open_warehouse(spark, folder)
    return incremental_filter(
        w.stage("orders"),
        "order_purchase_timestamp",
        w.mart("fact_orders"),
        "order_purchase_timestamp",
    )


def stale_fact_orders(w: Warehouse) -> MonthlyTable:
    fact = w.mart("fact_orders")
    old = _yesterday(fact, "order_purchase_timestamp", "delivery_status", "outdated")
    return write_monthly(old, fresh_path(w.spark, "fact_orders"), "order_date")


def monthly_orders(w: Warehouse) -> DataFrame:
    """Cleaned orders by month, as a warehouse that is refreshed stores them."""
    path = fresh_path(w.spark, "orders")
    return write_monthly(w.stage("orders"), path, "order_purchase_timestamp").rows()


def refreshed_orders(w: Warehouse, old: MonthlyTable) -> MonthlyTable:
    s = w.stage
    return incremental.refresh_fact_orders(
        old,
        fresh_path(w.spark, "fact_orders"),
        monthly_orders(w),
        s("customers"),
        s("order_items"),
        s("order_payments"),
        s("order_reviews"),
    )


def upsert_fact_orders(spark: SparkSession, folder: str) -> DataFrame:
    w = open_warehouse(spark, folder)
    return refreshed_orders(w, stale_fact_orders(w)).table()


def _kept(report: Callable[[DataFrame], DataFrame]) -> Query:
    """A report made of partial sums that a refresh has brought up to date."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        w = open_warehouse(spark, folder)
        old = stale_fact_orders(w)
        counted = kept_reports.refresh_parts(None, old, fresh_path(spark, "parts"))
        new = refreshed_orders(w, old)
        return report(kept_reports.refresh_parts(counted, new, fresh_path(spark, "parts")))

    return query


def feed_fact_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The order fact after a stream has read all orders, in several files, from an inbox."""
    w = open_warehouse(spark, folder)
    inbox, old = fresh_path(spark, "inbox"), stale_fact_orders(w)
    w.cleaned("orders").write.parquet(inbox)
    details = {n: w.stage(n) for n in ("customers", "order_items", "order_payments", "order_reviews")}
    progress = fresh_path(spark, "progress")
    order_feed.follow_orders(spark, inbox, details, old.path, progress).awaitTermination()
    return old.table()


def upsert_fact_sales(spark: SparkSession, folder: str) -> DataFrame:
    w = open_warehouse(spark, folder)
    old = _yesterday(w.mart("fact_sales"), "order_date", "price", -1)
    target = write_monthly(old, fresh_path(spark, "fact_sales"), "order_date")
    return incremental.refresh_fact_sales(
        target,
        fresh_path(spark, "fact_sales"),
        w.stage("order_items"),
        monthly_orders(w),
        w.stage("customers"),
    ).table()


# --- shaping --------------------------------------------------------------------------------------


def coerce_dates_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """One text column that parses throughout, one that does not, and a numeric month."""
    rows = testdata.purchase_text(spark, folder)
    return shaping.coerce_dates_by_name(
        rows.select(
            "o_orderkey",
            F.col("order_purchase_timestamp").alias("mixed_time"),
            F.when(
                F.col("order_purchase_timestamp").startswith("not"), F.lit("1995-01-01 00:00:00")
            )
            .otherwise(F.col("order_purchase_timestamp"))
            .alias("order_date"),
            (F.col("o_orderkey") % 12 + 1).alias("month"),
        )
    )


def row_cap(spark: SparkSession, folder: str) -> DataFrame:
    sales = open_warehouse(spark, folder).mart("fact_sales")
    return shaping.row_cap(
        sales.select("order_id", "order_item_id", "revenue").orderBy("order_id", "order_item_id")
    )


# --- text and vectors -----------------------------------------------------------------------------


def strip_fences(spark: SparkSession, folder: str) -> DataFrame:
    return testdata.model_answers(spark, folder).select(
        "log_id", text_audit.strip_fences(F.col("answer")).alias("sql")
    )


def question_key(spark: SparkSession, folder: str) -> DataFrame:
    return testdata.questions(spark, folder).select(
        "conv_id", "turn", text_audit.question_key(F.col("text")).alias("question_key")
    )


def semantic_lookup(spark: SparkSession, folder: str, **sizes: int) -> DataFrame:
    found = similarity.semantic_lookup(
        testdata.similarity_queries(spark, folder), testdata.similarity_cache(spark, folder), **sizes
    )
    return found.withColumns(
        {c: F.round(c, 6) for c in ("distance", "similarity")}
    )


def semantic_upsert(spark: SparkSession, folder: str) -> DataFrame:
    stored = testdata.stored_questions(spark, folder)
    cache = stored.withColumn("id", text_audit.question_key(F.col("question")))
    merged = similarity.semantic_upsert(cache, testdata.answered_questions(spark, folder))
    return merged.select(
        "id",
        "question",
        "sql",
        # All elements, in millionths.
        F.array_join(
            F.transform("vector", lambda x: F.floor(x.cast("double") * 1e6).cast("string")), ","
        ).alias("vector"),
    )


def recent_questions(spark: SparkSession, folder: str) -> DataFrame:
    events = testdata.table(spark, folder, "events").select("user_id", "event_type", "ts")
    return text_audit.recent_questions(events, "user_id", "event_type", "ts")


def _log(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: plan(testdata.sql_log(spark, folder))


def build_queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "ingest_csv": ingest_csv,
        "csv_unreadable": csv_unreadable,
        "read_mart_orders": _on_orders(lambda orders: orders),
        "read_mart_sales": _on(_sales),
        "load_full_refresh": load_full_refresh,
        "write_quality_report": write_quality_report,
        "write_summary_csv": write_summary_csv,
        # cleaning
        "dedup_keep_first": _on(
            lambda w: dedup_keep_first(
                w.raw("order_items"), RULES["order_items"].key, late=w.late("order_items")
            )
        ),
        "coerce_numeric": lambda s, d: coerce_numeric(testdata.price_text(s, d), ["price", "absent"]),
        "coerce_timestamp": lambda s, d: coerce_timestamp(
            testdata.purchase_text(s, d), ["order_purchase_timestamp"]
        ),
        ITEM_SALES: _on(lambda w: w.item_sales()),
    }
    for name in RAW:
        q[f"clean_{name}"] = _on(lambda w, n=name: w.clean(n))
        q[f"stg_{STORED_NAME.get(name, name)}"] = _on(lambda w, n=name: stage(n, w.cleaned(n)))

    # data quality, on copies in which some rows break each rule
    def over_tables(check: Callable[[Warehouse, str], list[DataFrame]]) -> Query:
        return _on(lambda w: quality.union_all([f for t in RULES for f in check(w, t)]))

    q["check_not_null"] = over_tables(
        lambda w, t: [quality.check_not_null(_broken(w, t), t, RULES[t].required)]
    )
    # On raw tables, where repeated keys exist.
    q["check_unique"] = over_tables(
        lambda w, t: [quality.check_unique(w.raw(t), t, RULES[t].key)]
    )
    q["check_fk"] = _on(
        lambda w: quality.union_all(
            [
                quality.check_fk(_broken(w, c), c, cc, _broken(w, p), p, pc)
                for c, cc, p, pc in quality.FOREIGN_KEYS
            ]
        )
    )
    q["check_non_negative"] = over_tables(
        lambda w, t: [quality.check_non_negative(_broken(w, t), t, RULES[t].non_negative)]
        if RULES[t].non_negative
        else []
    )
    q["check_range"] = over_tables(
        lambda w, t: [quality.check_range(_broken(w, t), t, *r) for r in RULES[t].ranges]
    )
    q["check_fact_timestamp"] = _on(
        lambda w: quality.check_fact_timestamp(_broken(w, ITEM_SALES), ITEM_SALES)
    )
    q["validate_all"] = _on(
        lambda w: quality.validate_all(
            {t: _broken(w, t) for t in w.cleaned_all()}, _broken(w, ITEM_SALES)
        )
    )
    q["quality_report"] = _on(_quality_report)
    q["schema_contract"] = _on(
        lambda w: quality.schema_contract(w.marts(list(MARTS)))
    )
    q["delivery_conflict"] = _on(lambda w: marts.delivery_conflict(w.stage("orders")))

    # marts
    for name in MARTS:
        q[name] = _on(lambda w, n=name: w.build(n))
    q["flat_items"] = _on(lambda w: w.flat())
    q["rfm_base"] = _on(lambda w: w.rfm_base())
    q["rfm_scores"] = _on(lambda w: marts.rfm_scores(w.rfm_base()))
    q["rfm_segments"] = _on(lambda w: w.segments())
    q["order_items_agg"] = _on(lambda w: marts.order_items_agg(w.stage("order_items")))
    q["payments_agg"] = _on(lambda w: marts.payments_agg(w.stage("order_payments")))
    q["reviews_agg"] = _on(lambda w: marts.reviews_agg(w.stage("order_reviews")))
    q["delivery_metrics"] = _on(lambda w: marts.delivery_metrics(w.stage("orders")))

    # incremental load
    q["incremental_filter"] = lookback_rows
    q["upsert_fact_orders"] = upsert_fact_orders
    q["upsert_fact_sales"] = upsert_fact_sales
    q["feed_fact_orders"] = feed_fact_orders
    q["kept_monthly_kpi"] = _kept(kept_reports.monthly_kpi)
    q["kept_delivery_review"] = _kept(kept_reports.delivery_review)
    q["kept_weekday_weekend"] = _kept(kept_reports.weekday_weekend)

    # KPIs on the flat items, reports on the marts
    q |= {
        "kpi_monthly_revenue": _on_flat(kpis.monthly_revenue),
        "kpi_monthly": _on_flat(kpis.monthly),
        "kpi_category": _on_flat(kpis.category),
        "kpi_customer_summary": _on_flat(kpis.customer_summary),
        "kpi_review_delivery": _on_flat(kpis.review_delivery),
        "kpi_weekday_weekend": _on_flat(kpis.weekday_weekend),
        "kpi_seller": _on_flat(kpis.seller),
        "kpi_pareto_category": _on_flat(kpis.pareto_category),
        "kpi_total_revenue": _on_flat(kpis.total_revenue),
        "kpi_top10_category": _on_flat(kpis.top10_category),
        "kpi_retention": _on_flat(kpis.retention),
        "kpi_late_impact": _on_flat(kpis.late_impact),
        "report_monthly_kpi": _on_orders(reports.monthly_kpi),
        "report_top_categories": _on(_top_categories),
        "report_delivery_review": _on_orders(reports.delivery_review),
        "report_weekday_weekend": _on_orders(reports.weekday_weekend),
        "report_customer_repeat": _on_orders(reports.customer_repeat),
    }

    # ad-hoc queries and example questions
    q |= {
        "adhoc_monthly_price_revenue": _on(
            lambda w: adhoc.monthly_price_revenue(w.stage("orders"), w.stage("order_items"))
        ),
        "adhoc_top_categories": _on(
            lambda w: adhoc.top_categories(
                w.stage("order_items"), w.stage("products"), w.stage("category_translation")
            )
        ),
        "adhoc_customers_by_state": _on(lambda w: adhoc.customers_by_state(w.stage("customers"))),
        "bench_raw_category_revenue": _on(
            lambda w: adhoc.raw_category_revenue(
                w.stage("orders"),
                w.stage("order_items"),
                w.stage("products"),
                w.stage("category_translation"),
            )
        ),
        "bench_star_category_revenue": _on(
            lambda w: adhoc.star_category_revenue(w.mart(ITEM_SALES))
        ),
        "ask_monthly_revenue": _on(lambda w: adhoc.ask_monthly_revenue(w.mart("fact_orders"))),
        "ask_category_revenue": _on(
            lambda w: adhoc.ask_category_revenue(w.mart("fact_sales"), w.mart("dim_products"))
        ),
        "ask_payment_types": _on(lambda w: adhoc.ask_payment_types(w.stage("order_payments"))),
        "ask_customers_by_state": _on(
            lambda w: adhoc.ask_customers_by_state(w.mart("dim_customers"))
        ),
        "ask_avg_freight_per_order_month": _on(
            lambda w: adhoc.ask_avg_freight_per_order_month(
                w.mart("fact_sales"), w.mart("fact_orders")
            )
        ),
        "ask_review_by_delivery_status": _on(
            lambda w: adhoc.ask_review_by_delivery_status(w.mart("fact_orders"))
        ),
        "ask_top_sellers": _on(
            lambda w: adhoc.ask_top_sellers(w.mart("fact_sales"), w.mart("dim_sellers"))
        ),
        "ask_total_fact_item_revenue": _on(
            lambda w: adhoc.ask_total_fact_item_revenue(w.mart(ITEM_SALES))
        ),
        "ask_segment_counts": _on(lambda w: adhoc.ask_segment_counts(w.mart("dim_customers"))),
        "ask_payment_profile": _on(lambda w: adhoc.ask_payment_profile(w.mart("fact_orders"))),
    }

    # profiling and shaping
    q |= {
        "profile_overview": _on(lambda w: profiling.overview(w.raw_all())),
        "profile_missing": _on(lambda w: profiling.missing(w.raw_all())),
        "profile_order_status": _on(
            lambda w: profiling.value_counts(w.raw("orders"), "order_status", "orders")
        ),
        "profile_review_scores": _on(lambda w: profiling.score_counts(w.raw("order_reviews"))),
        "profile_review_histogram": _on(
            lambda w: profiling.histogram(w.raw("order_reviews"), "review_score")
        ),
        "profile_payment_types": _on(
            lambda w: profiling.value_counts(w.raw("order_payments"), "payment_type", "payments")
        ),
        "profile_untranslated": _on(
            lambda w: profiling.untranslated(w.raw("products"), w.raw("category_translation"))
        ),
        "profile_join_sanity": _on(
            lambda w: profiling.join_sanity(
                *(w.raw(n) for n in ("order_items", "orders", "customers", "products", "sellers"))
            )
        ),
        "profile_grain": _on_flat(profiling.grain),
        "order_level_rollup": _on_flat(profiling.order_level_rollup),
        "headline_kpis": _on_flat(
            lambda flat: profiling.headline_kpis(flat, profiling.order_level_rollup(flat))
        ),
        "grain_bias": _on_flat(
            lambda flat: profiling.grain_bias(flat, profiling.order_level_rollup(flat))
        ),
        "profile_monthly_kpi": _on_rollup(reports.monthly_kpi),
        "profile_top_categories": _on_flat(reports.top_categories),
        "profile_delivery_review": _on_rollup(reports.delivery_review),
        "profile_weekday_weekend": _on_rollup(reports.weekday_weekend),
        "profile_customer_repeat": _on_rollup(reports.customer_repeat),
        "round_floats": _on_orders(shaping.round_floats),
        "coerce_dates_by_name": coerce_dates_by_name,
        "result_summary": _on_orders(shaping.result_summary),
        "row_cap": row_cap,
    }

    # text and vectors
    q |= {
        "row_cap_sql": _log(
            lambda log: log.select("log_id", shaping.capped_sql(F.col("sql")).alias("sql"))
        ),
        "audit_sql_log": _log(text_audit.audit_sql_log),
        "extract_table_refs": _log(text_audit.table_usage),
        "extract_cte_names": _log(text_audit.cte_usage),
        "audit_questions": lambda s, d: text_audit.audit_questions(testdata.questions(s, d)),
        "strip_fences": strip_fences,
        "question_key": question_key,
        "semantic_lookup": semantic_lookup,
        # The same with many groups and blocks, as far larger tables have.
        "semantic_lookup_blocks": lambda s, d: semantic_lookup(s, d, anchor_limit=24, block_rows=40),
        "semantic_upsert": semantic_upsert,
        "recent_questions": recent_questions,
    }
    return q
