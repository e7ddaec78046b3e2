"""The layers of the model over one source: raw, cleaned, staged, marts, flat items.

Every layer is lazy until something downstream reads it; then it is written once as Parquet and the
next layer reads that table. Dedup and the large joins therefore run once per source, however many
queries follow, and later plans start from tables with known sizes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators.upsert import MonthlyTable, read_monthly, write_monthly
from tradewind.plans import marts
from tradewind.operators.quality import Measured, watch
from tradewind.plans.cleaning import clean_and_count, clean_table, fact_order_item_sales
from tradewind.plans.staging import stage
from tradewind.schemas import MARTS, RAW
from tradewind.session import STORED_AS, fresh_path

#: A plan with counters, and their values once it is stored.
Watched = tuple[DataFrame, Callable[[DataFrame], Measured | None]]

ITEM_SALES = "fact_order_item_sales"
# Independent tables built at the same time, so small ones fill the gaps of large ones.
THREADS = 4
# Date column of the facts, which a refresh rewrites by month.
FACT_DATE = {"fact_orders": "order_date", "fact_sales": "order_date"}


class Warehouse:
    """``monthly`` stores facts and cleaned orders by month, as the incremental refresh needs them.
    ``late`` gives the columns of a raw table that follow from its source position."""

    def __init__(
        self,
        spark: SparkSession,
        read_raw: Callable[[str], DataFrame],
        folder: str | None = None,
        monthly: bool = False,
        late: Callable[[str], Mapping[str, Column]] = lambda name: {},
    ) -> None:
        self.spark = spark
        self.monthly = monthly
        self._by_month: dict[str, MonthlyTable] = {}
        self.read_raw = read_raw
        self.late = late
        self.folder = folder or fresh_path(spark, "warehouse")
        #: Counts of the checks, taken while the tables were written.
        self.measured: dict[str, Measured] = {}
        self._raw: dict[str, DataFrame] = {}
        self._stored: dict[str, DataFrame] = {}
        self._locks: dict[str, Lock] = {}
        self._lock = Lock()

    # --- layers, lazy ---

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.read_raw(name)
        return self._raw[name]

    def raw_all(self) -> dict[str, DataFrame]:
        return {name: self.raw(name).select(*RAW[name].fieldNames()) for name in RAW}

    def clean(self, name: str) -> DataFrame:
        return clean_table(name, self.raw(name), self.late(name))

    def item_sales(self, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
        """Plan of the item fact over the stored cleaned tables, or over ``tables``."""
        names = ("order_items", "orders", "products", "category_translation")
        if tables is None:
            tables = self._clean_together(*names)
        return fact_order_item_sales(*(tables[name] for name in names))

    def stage(self, name: str) -> DataFrame:
        return stage(name, self.cleaned(name))

    def build(self, name: str) -> DataFrame:
        """Plan of a mart over the stored layers below it."""
        s = self.stage
        if name == "dim_date":
            return marts.dim_date(s("orders"))
        if name == "dim_products":
            return marts.dim_products(s("products"), s("category_translation"))
        if name == "dim_sellers":
            return marts.dim_sellers(s("sellers"))
        if name == "dim_customers":
            return marts.dim_customers(s("customers"), self.segments())
        if name == "fact_orders":
            self._clean_together("order_payments", "order_items", "orders", "customers", "order_reviews")
            return marts.fact_orders(
                s("orders"),
                s("customers"),
                s("order_items"),
                s("order_payments"),
                s("order_reviews"),
            )
        if name == "fact_sales":
            return marts.fact_sales(s("order_items"), s("orders"), s("customers"))
        if name == "flat_items":
            return self.flat()
        if name == ITEM_SALES:
            return self.item_sales()
        raise KeyError(name)

    def rfm_base(self) -> DataFrame:
        return marts.rfm_base(self.stage("orders"), self.stage("customers"), self.stage("order_items"))

    def segments(self) -> DataFrame:
        return marts.rfm_segments(marts.rfm_scores(self.rfm_base()))

    def flat(self) -> DataFrame:
        s = self.stage
        attributes = marts.order_attributes(
            s("orders"), s("customers"), s("order_items"), s("order_payments"), s("order_reviews")
        )
        return marts.flat_items(
            s("order_items").drop("revenue"),
            attributes,
            s("products"),
            s("category_translation"),
            s("sellers"),
        )

    # --- layers, stored on first use ---

    def _once(self, label: str, store: Callable[[str], DataFrame]) -> DataFrame:
        """The stored table; ``store`` writes it to a path when it is first asked for."""
        with self._lock:
            lock = self._locks.setdefault(label, Lock())
        with lock:
            if label not in self._stored:
                self._stored[label] = store(f"{self.folder}/{label}")
            return self._stored[label]

    def _store(self, label: str, plan: Callable[[], DataFrame]) -> DataFrame:
        return self._once(label, lambda path: self._written(plan(), path))

    def _written(self, df: DataFrame, path: str) -> DataFrame:
        df.write.mode("overwrite").option("compression", STORED_AS).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _counted(
        self, name: str, plan: Watched, write: Callable[[DataFrame], DataFrame]
    ) -> DataFrame:
        """The stored table, whose counts are kept."""
        watched, measured = plan
        stored = write(watched)
        if found := measured(stored):
            self.measured[name] = found
        return stored

    def _together(self, store: Callable[[str], DataFrame], names: Sequence[str]) -> dict[str, DataFrame]:
        with ThreadPoolExecutor(THREADS) as pool:
            return dict(zip(names, pool.map(store, names)))

    def cleaned(self, name: str) -> DataFrame:
        if self.monthly and name == "orders":
            return self.cleaned_orders().table()

        def store(path: str) -> DataFrame:
            plan = clean_and_count(name, self.raw(name), self.late(name))
            return self._counted(name, plan, lambda rows: self._written(rows, path))

        return self._once(f"clean/{name}", store)

    def cleaned_orders(self) -> MonthlyTable:
        """Orders by month of purchase, so that a refresh reads the last months only."""
        label = "clean/orders"

        def write(path: str, rows: DataFrame) -> DataFrame:
            self._by_month[label] = write_monthly(rows, path, "order_purchase_timestamp")
            return self._by_month[label].table()

        def store(path: str) -> DataFrame:
            plan = clean_and_count("orders", self.raw("orders"), self.late("orders"))
            return self._counted("orders", plan, lambda rows: write(path, rows))

        self._once(label, store)
        return self._by_month[label]

    def orders_by_month(self) -> DataFrame:
        """Staged orders with their month."""
        return self.cleaned_orders().rows()

    def _clean_together(self, *names: str) -> dict[str, DataFrame]:
        """Cleaned tables that a plan is about to read, large ones first: stored one after the other, the
        last tasks of each would leave the other cores idle."""
        return self._together(self.cleaned, names)

    def to_store(self) -> dict[str, DataFrame | Callable[[Mapping[str, DataFrame]], DataFrame]]:
        """All cleaned tables and the item fact for one who stores them: as they are stored here already, else as
        plans, so that no table is written twice."""
        found = {name: self._stored.get(f"clean/{name}") for name in RAW}
        tables = {name: self.clean(name) if df is None else df for name, df in found.items()}
        return {**tables, ITEM_SALES: self._stored.get(f"marts/{ITEM_SALES}", self.item_sales)}

    def cleaned_all(self) -> dict[str, DataFrame]:
        return self._together(self.cleaned, list(RAW))

    def mart(self, name: str) -> DataFrame:
        if self.monthly and name in FACT_DATE:
            return self._monthly_fact(name)
        if name == ITEM_SALES:
            return self._once(f"marts/{name}", self._item_sales)
        return self._store(f"marts/{name}", lambda: self.build(name))

    def _item_sales(self, path: str) -> DataFrame:
        plan = watch(self.item_sales(), ITEM_SALES, F.lit(False))
        return self._counted(ITEM_SALES, plan, lambda rows: self._written(rows, path))

    def _monthly_fact(self, name: str) -> DataFrame:
        def store(path: str) -> DataFrame:
            return write_monthly(self.build(name), path, FACT_DATE[name]).table()

        return self._once(f"marts/{name}", store)

    def marts(self, names: Sequence[str]) -> dict[str, DataFrame]:
        return self._together(self.mart, names)


def from_bundle(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    folder: str | None = None,
    monthly: bool = False,
) -> Warehouse:
    return Warehouse(spark, raw.__getitem__, folder, monthly)


def stored_mart(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A mart of an earlier build or refresh, complete as published."""
    path = f"{folder}/marts/{name}"
    if name in FACT_DATE:
        fact = read_monthly(spark, path, MARTS[name])
        if fact is None:
            raise FileNotFoundError(f"no published {name} in {folder}")
        return fact.table()
    return spark.read.schema(MARTS[name]).parquet(path)
