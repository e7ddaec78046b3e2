"""Incremental load: lookback filter, tables by month, delete-and-insert.

A table by month is a Parquet folder partitioned by month. An upsert reads keys and months, and in full
only the months that gain or lose rows. It writes either a new version, a complete table at a fresh path
that appears when its one job commits, or the months in place with Spark's dynamic partition overwrite.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.columns import month_label
from tradewind.session import STORED_AS, file_system, materialize, stored_bytes

LOOKBACK_DAYS = 3
# Fixed value: where an empty target starts.
EPOCH = "1970-01-01 00:00:00"

PARTITION = "_month"
# Rows without a date share a partition of their own.
NO_MONTH = "none"
# Stored size of a batch up to which its keys, a small part of it, are sent to every task.
BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class MonthlyTable:
    """A Parquet folder partitioned by month, with the columns of its rows.

    ``changed`` names the months that the upsert which gave the table wrote anew; None for any other table.
    """

    spark: SparkSession
    path: str
    layout: T.StructType
    changed: frozenset[str] | None = None

    def rows(self) -> DataFrame:
        """All rows, with the month as text; a filter on it reads only the months it names."""
        stored = T.StructType([*self.layout.fields, T.StructField(PARTITION, T.StringType())])
        return self.spark.read.schema(stored).parquet(self.path)

    def table(self) -> DataFrame:
        return self.rows().select(*self.layout.fieldNames())

    def months(self) -> list[str]:
        """Months with a partition; no data are read."""
        files, where = file_system(self.spark, self.path)
        names = [status.getPath().getName() for status in files.listStatus(where)]
        return sorted(n.removeprefix(f"{PARTITION}=") for n in names if n.startswith(f"{PARTITION}="))

    def last(self) -> DataFrame:
        """Rows of the newest month."""
        dated = [m for m in self.months() if m != NO_MONTH]
        return self.rows().where(F.col(PARTITION) == (dated[-1] if dated else NO_MONTH))


def _with_month(rows: DataFrame, date_column: str) -> DataFrame:
    return rows.withColumn(
        PARTITION, F.coalesce(month_label(F.col(date_column)), F.lit(NO_MONTH))
    )


def _even(rows: DataFrame) -> DataFrame:
    """Rows dealt by month. The rebalance hint lets adaptive execution merge small months and split large
    ones, so neither many small files nor one task with a whole month result."""
    return rows.hint("rebalance", PARTITION)


def _write(rows: DataFrame, path: str) -> None:
    """Write rows with a month in one job; what a failed run left at the path gives way."""
    files, where = file_system(rows.sparkSession, f"{path}/_SUCCESS")
    mode = "error" if files.exists(where) else "overwrite"
    rows.write.mode(mode).option("compression", STORED_AS).partitionBy(PARTITION).parquet(path)


def write_monthly(rows: DataFrame, path: str, date_column: str) -> MonthlyTable:
    """First build of a table by month at a fresh path."""
    _write(_even(_with_month(rows, date_column)), path)
    return MonthlyTable(rows.sparkSession, path, rows.schema)


def read_monthly(spark: SparkSession, path: str, layout: T.StructType) -> MonthlyTable | None:
    """The table at a path; None if no write there was completed."""
    files, where = file_system(spark, f"{path}/_SUCCESS")
    return MonthlyTable(spark, path, layout) if files.exists(where) else None


def lookback_start(
    target: DataFrame | MonthlyTable, column: str, days: int = LOOKBACK_DAYS
) -> str:
    """Start of the window as text: newest value in the target minus the lookback.

    One value is read, from the column alone, and of a table by month from its last month.
    """
    rows = target.last() if isinstance(target, MonthlyTable) else target
    newest = rows.agg(F.max(F.col(column).cast("timestamp_ntz")).alias("newest")).first()["newest"]
    return EPOCH if newest is None else (newest - timedelta(days=days)).isoformat(sep=" ")


def at_time(start: str) -> Column:
    return F.lit(start).cast("timestamp_ntz")


def since(source: DataFrame, column: str, start: str) -> DataFrame:
    """Rows from a start on; a source by month is read from the start's month on.

    As a literal the start prunes partitions and row groups of the source, which a join with the
    maximum could not.
    """
    kept = source.where(F.col(column) >= at_time(start))
    if PARTITION in source.columns:
        kept = kept.where((F.col(PARTITION) >= start[:7]) & (F.col(PARTITION) != NO_MONTH))
    return kept


def incremental_filter(
    source: DataFrame,
    source_column: str,
    target: DataFrame | MonthlyTable | None,
    target_column: str,
    days: int = LOOKBACK_DAYS,
) -> DataFrame:
    """Source rows inside the lookback window of the target; all rows on the first build.

    The bound is inclusive. Rows without a time never pass, and a change to a row older than the
    window is not seen.
    """
    if target is None:
        return source
    return since(source, source_column, lookback_start(target, target_column, days))


def _replace_months(target: MonthlyTable, merged: DataFrame, changed: Sequence[str]) -> None:
    """Put the months ``changed`` in the place of the target's, as ``merged`` holds them.

    One month after another, the newest last, so that a run that ends between them leaves a target whose
    lookback still covers what is missing. A month without rows any more is dropped.
    """
    rows = materialize(_even(merged), "merged")
    left = {r[0] for r in rows.select(PARTITION).distinct().collect()}
    for month in sorted(set(changed) - left):
        files, where = file_system(target.spark, f"{target.path}/{PARTITION}={month}")
        files.delete(where, True)
    # Text order puts rows without a date last; they play no part in the lookback.
    for month in sorted(left):
        writer = rows.where(F.col(PARTITION) == month).write.mode("overwrite")
        writer = writer.option("partitionOverwriteMode", "dynamic").option("compression", STORED_AS)
        writer.partitionBy(PARTITION).parquet(target.path)


def upsert(
    target: MonthlyTable | None,
    path: str,
    batch: DataFrame,
    key: Sequence[str],
    date_column: str,
) -> MonthlyTable:
    """Delete the target rows whose key is in the batch, insert the batch; the result is at ``path``.

    Which months lose rows is found by reading key and month of the target against the keys of the
    batch; there is one row per calendar month, so they may pass through the driver. With the target's
    own path only the months that gain or lose rows are written. At another, fresh path a complete new
    version is written by one job, which copies the other months as they are, without a shuffle; the
    target stays as it was and is not needed any more. Running the same batch twice gives the same
    table, so a failed run can simply be repeated. Without a target the batch is the table.
    """
    if target is None:
        return write_monthly(batch, path, date_column)
    # Read three times below and small against the target, so it is computed once.
    fresh = materialize(_with_month(batch.select(*target.layout.fieldNames()), date_column), "batch")
    keys = fresh.select(*key).distinct()
    if stored_bytes(fresh) <= BROADCAST_BYTES:
        keys = F.broadcast(keys)

    losing = target.rows().select(*key, PARTITION).join(keys, list(key), "left_semi")
    months = losing.select(PARTITION).union(fresh.select(PARTITION)).distinct()
    changed = sorted(r[0] for r in months.collect())
    rows = target.rows()
    here = F.col(PARTITION).isin(changed)
    kept = rows.where(here).join(keys, list(key), "left_anti")
    merged = kept.select(*rows.columns).unionByName(fresh)
    if path == target.path:
        _replace_months(target, merged, changed)
    else:
        _write(rows.where(~here).unionByName(_even(merged)), path)
    return MonthlyTable(target.spark, path, target.layout, frozenset(changed))
