"""The batch flows: full build, incremental refresh, report files."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tradewind.operators.quality import assert_valid, quality_report, validate_all
from tradewind.operators.upsert import MonthlyTable, read_monthly
from tradewind.plans import kept_reports, reports
from tradewind.plans.incremental import refresh_fact_orders, refresh_fact_sales
from tradewind.plans.warehouse import (
    FACT_DATE,
    ITEM_SALES,
    THREADS,
    Warehouse,
    from_bundle,
    stored_mart,
)
from tradewind.schemas import MARTS
from tradewind.sources.csv_files import extract_all
from tradewind.sources.sinks import write_quality_report, write_summary_csv

#: Folder, below a version's, of the partial sums that the order reports are made of.
ORDER_PARTS = "parts/fact_orders"
REPORT_MARTS = ("fact_orders", "fact_sales", "dim_products")


@contextmanager
def _checked(
    spark: SparkSession, raw: Mapping[str, DataFrame], folder: str
) -> Iterator[Warehouse]:
    """Cleaned tables, stored once, counted while they are written, and checked by these counts.

    Broken data raise here, before any mart is built or touched. The quality report is written while
    the marts are built.
    """
    warehouse = from_bundle(spark, raw, folder, monthly=True)
    cleaned = warehouse.cleaned_all()
    fact = warehouse.mart(ITEM_SALES)
    assert_valid(validate_all(cleaned, fact, warehouse.measured))

    def report() -> None:
        measures = quality_report(warehouse.raw_all(), {**cleaned, ITEM_SALES: fact})
        write_quality_report(measures, f"{folder}/quality_report")

    with ThreadPoolExecutor(1) as aside:
        written = aside.submit(report)
        yield warehouse
        written.result()


def run_batch(spark: SparkSession, raw: Mapping[str, DataFrame], folder: str) -> Warehouse:
    """Build everything under a fresh folder; a caller that publishes it on success never publishes
    broken data."""
    with _checked(spark, raw, folder) as warehouse:
        warehouse.marts(list(MARTS))
        fact = read_monthly(spark, f"{folder}/marts/fact_orders", MARTS["fact_orders"])
        kept_reports.refresh_parts(None, fact, f"{folder}/{ORDER_PARTS}")
    return warehouse


def run_refresh(
    spark: SparkSession, raw: Mapping[str, DataFrame], built: str, folder: str
) -> dict[str, DataFrame]:
    """A new version of everything under the fresh ``folder``, from newer raw tables and the version in
    ``built``. Returns all marts.

    Tables are cleaned and checked, dimensions rebuilt, and the facts brought up to date: months that
    change are written anew, the others copied, and the partial sums of the order reports follow them. ``built`` is not touched, so a failure leaves it as it
    was, and the new version does not need it. A fact that ``built`` lacks is built in full.
    """
    with _checked(spark, raw, folder) as warehouse:
        stage = warehouse.stage
        marts = warehouse.marts([name for name in MARTS if name not in FACT_DATE])
        lines, orders, people = stage("order_items"), warehouse.orders_by_month(), stage("customers")

        def old(name: str) -> MonthlyTable | None:
            return read_monthly(spark, f"{built}/marts/{name}", MARTS[name])

        fact = refresh_fact_orders(
            old("fact_orders"),
            f"{folder}/marts/fact_orders",
            orders,
            people,
            lines,
            stage("order_payments"),
            stage("order_reviews"),
        )
        counted = kept_reports.read_parts(spark, f"{built}/{ORDER_PARTS}")
        kept_reports.refresh_parts(counted, fact, f"{folder}/{ORDER_PARTS}")
        marts["fact_orders"] = fact.table()
        marts["fact_sales"] = refresh_fact_sales(
            old("fact_sales"), f"{folder}/marts/fact_sales", lines, orders, people
        ).table()
    return marts


def raw_from_csv(
    spark: SparkSession, raw_folder: str, files: Mapping[str, str], folder: str
) -> dict[str, DataFrame]:
    """Typed raw tables, stored under ``folder``. So the text is parsed once, and cleaning, counting and
    profiling read columns; counting rows then reads no data at all."""

    def store(item: tuple[str, DataFrame]) -> tuple[str, DataFrame]:
        name, rows = item
        path = f"{folder}/raw/{name}"
        rows.write.parquet(path)
        return name, spark.read.schema(rows.schema).parquet(path)

    with ThreadPoolExecutor(THREADS) as pool:
        return dict(pool.map(store, extract_all(spark, raw_folder, files).items()))


def run_from_csv(
    spark: SparkSession, raw_folder: str, files: Mapping[str, str], folder: str
) -> Warehouse:
    return run_batch(spark, raw_from_csv(spark, raw_folder, files, folder), folder)


def refresh_from_csv(
    spark: SparkSession, raw_folder: str, files: Mapping[str, str], built: str, folder: str
) -> dict[str, DataFrame]:
    return run_refresh(spark, raw_from_csv(spark, raw_folder, files, folder), built, folder)


def run_reports(spark: SparkSession, built: str, folder: str) -> dict[str, str]:
    """The five report tables of an earlier build as CSV. Returns their paths.

    Those that add up over months are made of the build's partial sums, if it has them.
    """
    marts = (stored_mart(spark, built, name) for name in REPORT_MARTS)
    tables = reports.summaries(*marts)
    parts = kept_reports.read_parts(spark, f"{built}/{ORDER_PARTS}")
    if parts is not None:
        tables |= kept_reports.summaries(parts)
    return write_summary_csv(tables, folder)
