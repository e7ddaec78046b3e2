"""Sinks: full refresh of the stored tables, quality report as JSON, summaries as CSV."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.columns import iso_text
from tradewind.schemas import STORED_NAME
from tradewind.session import STORED_AS, file_system

#: Table that names the loads which are complete, one row each; the newest counts.
LOADS = "_loads"
LOADS_LAYOUT = "load string, loaded_at timestamp, tables array<string>"
#: A table of a load made of others of the same load, by the name they have in it.
Derived = Callable[[Mapping[str, DataFrame]], DataFrame]
# Tables of a load written at the same time, so small ones fill the gaps of large ones.
WRITERS = 4


def _stored_name(name: str) -> str:
    return STORED_NAME.get(name, name)


def loaded(spark: SparkSession, folder: str) -> dict[str, str]:
    """Paths of the tables of the newest complete load, by stored name; empty before the first one.

    A reader that asks once reads all tables from the same load.
    """
    files, where = file_system(spark, f"{folder}/{LOADS}")
    if not files.exists(where):
        return {}
    loads = spark.read.schema(LOADS_LAYOUT).parquet(f"{folder}/{LOADS}")
    newest = loads.agg(F.max(F.struct("loaded_at", "load", "tables")).alias("n")).first().n
    return {} if newest is None else {name: f"{folder}/{newest.load}/{name}" for name in newest.tables}


def load_full_refresh(cleaned: Mapping[str, DataFrame | Derived], folder: str) -> dict[str, str]:
    """Replace all stored tables at once; each is written by all tasks in parallel. Returns the paths.

    Tables may be given as plans that nothing has stored yet: each is computed and written once. Derived
    ones follow the others and read what these have written.

    The tables go to a folder of this load, and one row appended to the table of loads publishes them
    together. So readers see all old or all new tables, and a load that ends before that row changes
    nothing. The load before stays for those that still read it; older ones and the remains of failed
    ones are deleted, so loads of one folder run one at a time. Without enforced foreign keys the order
    of the tables does not matter.
    """
    if not cleaned:
        return {}
    tables = {name: df for name, df in cleaned.items() if isinstance(df, DataFrame)}
    spark = next(iter(tables.values())).sparkSession
    before = {path.split("/")[-2] for path in loaded(spark, folder).values()}
    load = f"load-{uuid.uuid4().hex}"
    paths = {name: f"{folder}/{load}/{_stored_name(name)}" for name in cleaned}

    def written(name: str, df: DataFrame) -> DataFrame:
        df.write.option("compression", STORED_AS).parquet(paths[name])
        return df.sparkSession.read.schema(df.schema).parquet(paths[name])

    with ThreadPoolExecutor(WRITERS) as pool:
        done = dict(zip(tables, pool.map(written, tables, tables.values())))
    for name, made in cleaned.items():
        if name not in done:
            done[name] = written(name, made(done))
    row = [(load, [_stored_name(name) for name in cleaned])]
    row = spark.createDataFrame(row, "load string, tables array<string>").coalesce(1)
    row = row.select("load", F.current_timestamp().alias("loaded_at"), "tables")
    row.write.mode("append").parquet(f"{folder}/{LOADS}")
    files, where = file_system(spark, folder)
    for status in files.listStatus(where):
        name = status.getPath().getName()
        if name.startswith("load-") and name not in {load, *before}:
            files.delete(status.getPath(), True)
    return paths


def write_csv_table(df: DataFrame, path: str) -> None:
    """A table as CSV files with header, written in parallel; doubled quotes, ISO timestamps."""
    stamps = {c: iso_text(F.col(c)) for c, t in df.dtypes if t == "timestamp_ntz"}
    text = df.withColumns(stamps) if stamps else df
    text.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_quality_report(report: DataFrame, path: str) -> None:
    """One JSON line per measure. The report has one row per table and column, so one file does."""
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_summary_csv(summaries: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """Small summary tables, one CSV file each. Returns the paths."""
    paths = {name: f"{folder}/{name}" for name in summaries}
    for name, df in summaries.items():
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(paths[name])
    return paths
