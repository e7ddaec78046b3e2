"""Data-quality checks as distributed counts.

Every check yields rows of (check_order, check_name, table_name, column_names, violations, message).
All not-null, sign and range checks of a table share one scan. Uniqueness and references aggregate
by key before anything moves, so neither frequent keys nor long tables gather rows in one place.

A table that is being written can be counted in passing (``watch``): its rows then need no scan, and a key
that the plan has just made unique no shuffle, to be checked.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.columns import count_where, missing
from tradewind.schemas import FOREIGN_KEYS, ITEM_SALES_REQUIRED, MARTS, RULES


FACT = "fact_order_item_sales"


class DataValidationError(Exception):
    """Cleaned data break a declared rule."""


@dataclass(frozen=True)
class _Count:
    """One violation counter evaluated in a shared scan of its table."""

    check: str
    columns: str
    condition: Column
    text: str


# The messages of the checks, here and in check_unique and check_fk.
def _not_null(table: str, columns: Sequence[str]) -> list[_Count]:
    return [
        _Count("not_null", c, F.col(c).isNull(), f"{table}.{c} contains %s null values")
        for c in columns
    ]


def _non_negative(table: str, columns: Sequence[str]) -> list[_Count]:
    return [
        _Count("non_negative", c, F.col(c) < 0, f"{table}.{c} contains %s negative values")
        for c in columns
    ]


def _in_range(table: str, column: str, lo: int, hi: int) -> _Count:
    return _Count(
        "range",
        column,
        (F.col(column) < lo) | (F.col(column) > hi),
        f"{table}.{column} contains %s values outside allowed range [{lo}, {hi}]",
    )


def _fact_timestamp(table: str) -> _Count:
    return _Count(
        "fact_timestamp",
        "order_purchase_timestamp",
        F.col("order_purchase_timestamp").isNull(),
        f"{table}.order_purchase_timestamp contains null values after joins",
    )


def _rules(table: str) -> list[_Count]:
    """Everything that is checked of a table's rows one by one."""
    if table == FACT:
        return [*_not_null(FACT, ITEM_SALES_REQUIRED), _fact_timestamp(FACT)]
    rules = RULES[table]
    return [
        *_not_null(table, rules.required),
        *_non_negative(table, rules.non_negative),
        *(_in_range(table, *r) for r in rules.ranges),
    ]


@dataclass(frozen=True)
class Measured:
    """Counted while a table was written: violations by check and column, and rows whose key is not the
    one by which the table was made unique."""

    violations: Mapping[tuple[str, str], int]
    rekeyed: int


def watch(
    df: DataFrame, table: str, rekeyed: Column
) -> tuple[DataFrame, Callable[[DataFrame], Measured | None]]:
    """``df`` with counters that run when it is written, and their values once it is stored.

    ``rekeyed`` marks rows whose key may equal another's. A stage that lost executors run again can count rows
    twice; the number of rows counted then differs from the stored table's, which its files tell, and
    there is no result, so the table is checked by reading it.
    """
    observation, rules = Observation(f"{table}-{uuid.uuid4().hex}"), _rules(table)
    counters = (count_where(r.condition).alias(f"n{i}") for i, r in enumerate(rules))
    watched = df.observe(
        observation, F.count(F.lit(1)).alias("rows"), count_where(rekeyed).alias("rekeyed"), *counters
    )

    def measured(stored: DataFrame) -> Measured | None:
        found = observation.get
        if found["rows"] != stored.count():
            return None
        violations = {(r.check, r.columns): found[f"n{i}"] for i, r in enumerate(rules)}
        return Measured(violations, found["rekeyed"])

    return watched, measured


def _result(
    order: Column,
    check: Column,
    table: str | Column,
    columns: Column,
    violations: Column,
    text: Column,
) -> list[Column]:
    return [
        order.cast("int").alias("check_order"),
        check.alias("check_name"),
        (F.lit(table) if isinstance(table, str) else table).alias("table_name"),
        columns.alias("column_names"),
        violations.cast("bigint").alias("violations"),
        F.when(violations > 0, F.replace(text, F.lit("%s"), violations.cast("string"))).alias(
            "message"
        ),
    ]


def _known(
    spark: SparkSession, counts: Sequence[tuple[int, str, str, str, int, str]]
) -> DataFrame:
    """Counts that are known already: position, check, table, columns, violations, text."""
    names = ("o", "k", "b", "c", "v", "t")
    rows = F.array(
        *(F.struct(*(F.lit(v).alias(n) for n, v in zip(names, count))) for count in counts)
    )
    r = F.col("r")
    return spark.range(1).select(F.explode(rows).alias("r")).select(
        *_result(r["o"], r["k"], r["b"], r["c"], r["v"], r["t"])
    )


def _scan(df: DataFrame, table: str, counts: Sequence[tuple[int, _Count]]) -> DataFrame:
    """All counters of one table in one pass, unpivoted to one row per counter."""
    totals = df.agg(*(count_where(c.condition).alias(f"n{i}") for i, (_, c) in enumerate(counts)))
    rows = F.array(
        *(
            F.struct(
                F.lit(order).alias("o"),
                F.lit(c.check).alias("k"),
                F.lit(c.columns).alias("c"),
                F.col(f"n{i}").alias("v"),
                F.lit(c.text).alias("t"),
            )
            for i, (order, c) in enumerate(counts)
        )
    )
    r = F.col("r")
    return totals.select(F.explode(rows).alias("r")).select(
        *_result(r["o"], r["k"], table, r["c"], r["v"], r["t"])
    )


def check_not_null(df: DataFrame, table: str, columns: Sequence[str], at: int = 0) -> DataFrame:
    return _scan(df, table, [(at + i, c) for i, c in enumerate(_not_null(table, columns))])


def check_non_negative(df: DataFrame, table: str, columns: Sequence[str], at: int = 0) -> DataFrame:
    return _scan(df, table, [(at + i, c) for i, c in enumerate(_non_negative(table, columns))])


def check_range(
    df: DataFrame, table: str, column: str, lo: int, hi: int, at: int = 0
) -> DataFrame:
    return _scan(df, table, [(at, _in_range(table, column, lo, hi))])


def check_fact_timestamp(fact: DataFrame, table: str, at: int = 0) -> DataFrame:
    return _scan(fact, table, [(at, _fact_timestamp(table))])


def _unique_text(table: str, key: Sequence[str]) -> tuple[str, str]:
    names = ", ".join(key)
    return names, f"{table} has %s duplicate rows on key [{names}]"


def check_unique(df: DataFrame, table: str, key: Sequence[str], at: int = 0) -> DataFrame:
    """Rows beyond the first of their key; null keys equal each other."""
    repeats = F.coalesce(F.sum(F.col("rows") - 1), F.lit(0))
    names, text = _unique_text(table, key)
    return (
        df.groupBy(*key)
        .agg(F.count("*").alias("rows"))
        .agg(repeats.alias("v"))
        .select(
            *_result(
                F.lit(at),
                F.lit("unique"),
                table,
                F.lit(names),
                F.col("v"),
                F.lit(text),
            )
        )
    )


def check_fk(
    child: DataFrame,
    child_table: str,
    child_column: str,
    parent: DataFrame,
    parent_table: str,
    parent_column: str,
    at: int = 0,
) -> DataFrame:
    """Distinct non-null child values without a parent; distinct first, so a hot value is one row."""
    values = child.select(F.col(child_column).alias("value")).dropna().distinct()
    known = parent.select(F.col(parent_column).alias("value"))
    text = (
        f"Foreign key check failed: {child_table}.{child_column} -> "
        f"{parent_table}.{parent_column}. Missing references: %s"
    )
    return (
        values.join(known, "value", "left_anti")
        .agg(F.count("*").alias("v"))
        .select(
            *_result(
                F.lit(at), F.lit("fk"), child_table, F.lit(child_column), F.col("v"), F.lit(text)
            )
        )
    )


def check_fks(
    edges: Sequence[tuple[int, DataFrame, str, str]],
    parent: DataFrame,
    parent_table: str,
    parent_column: str,
) -> DataFrame:
    """``check_fk`` for several (position, child, table, column) with one parent, which is read and
    shuffled once."""
    values = union_all(
        [
            child.select(F.lit(at).alias("at"), F.col(column).alias("value")).dropna().distinct()
            for at, child, _, column in edges
        ]
    )
    known = parent.select(F.col(parent_column).alias("value"))
    totals = values.join(known, "value", "left_anti").agg(
        *(count_where(F.col("at") == at).alias(f"n{i}") for i, (at, *_) in enumerate(edges))
    )
    rows = F.array(
        *(
            F.struct(
                F.lit(at).alias("o"),
                F.lit(table).alias("t"),
                F.lit(column).alias("c"),
                F.col(f"n{i}").alias("v"),
            )
            for i, (at, _, table, column) in enumerate(edges)
        )
    )
    text = F.concat(
        F.lit("Foreign key check failed: "), F.col("r.t"), F.lit("."), F.col("r.c"),
        F.lit(f" -> {parent_table}.{parent_column}. Missing references: %s"),
    )
    return totals.select(F.explode(rows).alias("r")).select(
        *_result(F.col("r.o"), F.lit("fk"), F.col("r.t"), F.col("r.c"), F.col("r.v"), text)
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of frames with the same columns in the same order, joined in pairs: every union looks through
    the plan below it, so a chain of them would take time with the square of their number."""
    while len(frames) > 1:
        pairs = (frames[i : i + 2] for i in range(0, len(frames), 2))
        frames = [reduce(DataFrame.union, pair) for pair in pairs]
    return frames[0]


def validate_all(
    cleaned: Mapping[str, DataFrame],
    fact: DataFrame,
    measured: Mapping[str, Measured] | None = None,
) -> DataFrame:
    """Every rule of every table, numbered in the order in which a failure is reported.

    Tables in ``measured`` were counted while they were written. They are read for references only, and if
    no row has changed its key since it was made unique, that key is not grouped again.
    """
    measured = measured or {}
    # Reporting order: not null, unique, references, signs and ranges, then the fact.
    position = 0
    scans: dict[str, list[tuple[int, _Count]]] = {}
    parts: list[DataFrame] = []
    known: list[tuple[int, str, str, str, int, str]] = []

    def add(table: str, counts: Sequence[_Count]) -> None:
        nonlocal position
        for count in counts:
            if table in measured:
                violations = measured[table].violations[count.check, count.columns]
                known.append((position, count.check, table, count.columns, violations, count.text))
            else:
                scans.setdefault(table, []).append((position, count))
            position += 1

    for table, rules in RULES.items():
        add(table, _not_null(table, rules.required))
    for table, rules in RULES.items():
        if table in measured and not measured[table].rekeyed:
            names, text = _unique_text(table, rules.key)
            known.append((position, "unique", table, names, 0, text))
        else:
            parts.append(check_unique(cleaned[table], table, rules.key, position))
        position += 1
    parents: dict[tuple[str, str], list[tuple[int, DataFrame, str, str]]] = {}
    for child, column, parent, parent_column in FOREIGN_KEYS:
        edge = (position, cleaned[child], child, column)
        parents.setdefault((parent, parent_column), []).append(edge)
        position += 1
    for (parent, parent_column), edges in parents.items():
        parts.append(check_fks(edges, cleaned[parent], parent, parent_column))
    for table, rules in RULES.items():
        add(table, _non_negative(table, rules.non_negative))
    for table, rules in RULES.items():
        add(table, [_in_range(table, *r) for r in rules.ranges])
    add(FACT, _not_null(FACT, ITEM_SALES_REQUIRED))
    add(FACT, [_fact_timestamp(FACT)])
    for table, counts in scans.items():
        parts.append(_scan(fact if table == FACT else cleaned[table], table, counts))
    if known:
        parts.append(_known(fact.sparkSession, known))
    return union_all(parts)


def assert_valid(checks: DataFrame) -> None:
    """Raise on the first violated rule in reporting order."""
    first = checks.where(F.col("violations") > 0).orderBy("check_order").limit(1).collect()
    if first:
        raise DataValidationError(first[0]["message"])


def _measures(df: DataFrame, table: str, source: str) -> DataFrame:
    """Row count, and null count per column for cleaned tables, in one scan."""
    columns = df.columns if source == "cleaned" else []
    totals = df.agg(
        F.count("*").alias("rows"),
        *(count_where(missing(df, c)).alias(f"n{i}") for i, c in enumerate(columns)),
    )
    rows = F.array(
        F.struct(
            F.lit(f"{source}_row_counts").alias("metric"),
            F.lit(None).cast("string").alias("column_name"),
            F.col("rows").alias("value"),
        ),
        *(
            F.struct(
                F.lit("null_counts").alias("metric"),
                F.lit(c).alias("column_name"),
                F.col(f"n{i}").alias("value"),
            )
            for i, c in enumerate(columns)
        ),
    )
    return totals.select(F.lit(table).alias("table_name"), F.explode(rows).alias("m")).select(
        "table_name", "m.*"
    )


def quality_report(
    raw: Mapping[str, DataFrame], cleaned: Mapping[str, DataFrame]
) -> DataFrame:
    """Rows before and after cleaning, rows removed, nulls per column, as (table, metric, column, value)."""
    measured = union_all(
        [_measures(df, t, "raw") for t, df in raw.items()]
        + [_measures(df, t, "cleaned") for t, df in cleaned.items()]
    )
    # One signed row per table and count, so removed rows need no second scan.
    counted = F.col("metric").isin("raw_row_counts", "cleaned_row_counts")
    signed = F.when(F.col("metric") == "raw_row_counts", F.col("value")).otherwise(-F.col("value"))
    removed = F.struct(
        F.lit("rows_removed_by_cleaning").alias("metric"),
        F.lit(None).cast("string").alias("column_name"),
        signed.alias("value"),
    )
    itself = F.struct("metric", "column_name", "value")
    both = sorted(set(raw) & set(cleaned))
    paired = counted & F.col("table_name").isin(both)
    return (
        measured.select(
            "table_name",
            F.explode(F.when(paired, F.array(itself, removed)).otherwise(F.array(itself))).alias("m"),
        )
        .select("table_name", "m.*")
        .groupBy("table_name", "metric", "column_name")
        .agg(F.sum("value").alias("value"))
    )


def schema_contract(marts: Mapping[str, DataFrame]) -> DataFrame:
    """Declared against actual columns and types of the marts, with the values each column holds.

    One scan per mart counts the values of all its columns.
    """

    def one(table: str) -> DataFrame:
        declared = {f.name: f.dataType.simpleString() for f in MARTS.get(table, [])}
        actual = dict(marts[table].dtypes)
        columns = list(dict.fromkeys([*declared, *actual]))
        totals = marts[table].agg(*(F.count(c).alias(c) for c in actual))
        text = "string"
        rows = F.array(
            *(
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.lit(declared.get(c)).cast(text).alias("declared"),
                    F.lit(actual.get(c)).cast(text).alias("actual"),
                    (F.col(c) if c in actual else F.lit(None).cast("bigint")).alias("filled"),
                )
                for c in columns
            )
        )
        return totals.select(F.lit(table).alias("table_name"), F.explode(rows).alias("c")).select(
            "table_name", "c.*"
        )

    verdict = (
        F.when(F.col("actual").isNull(), "missing")
        .when(F.col("declared").isNull(), "unexpected")
        .when(F.col("actual") != F.col("declared"), "other type")
        .otherwise("ok")
    )
    return union_all([one(t) for t in marts]).withColumn("verdict", verdict)
