"""Shaping of query results: rounding, date columns by name, summary and row cap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.columns import has_word, strip

MAX_ROWS = 1000
_DATE_WORDS = ("date", "time", "month")


def round_floats(df: DataFrame, digits: int = 2) -> DataFrame:
    """Round float columns the way array libraries do: scale, round half to even, scale back."""
    scale = 10.0**digits
    return df.select(
        *(
            (F.rint(F.col(f.name) * scale) / scale).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema
        )
    )


def _parsed(name: str) -> Column:
    return F.col(name).try_cast("timestamp_ntz")


def coerce_dates_by_name(df: DataFrame) -> DataFrame:
    """Text columns named like a date become timestamps if every value parses, else stay as is.

    Whether they do is counted for all candidates in one pass; the counts are one row.
    """
    candidates = [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.StringType) and any(w in f.name.lower() for w in _DATE_WORDS)
    ]
    dates = [f.name for f in df.schema if isinstance(f.dataType, T.DateType)]
    if candidates:
        bad = df.agg(
            *(
                F.count(F.when(F.col(c).isNotNull() & _parsed(c).isNull(), 1)).alias(c)
                for c in candidates
            )
        ).first()
        candidates = [c for c in candidates if bad[c] == 0]
    named = [c for c in dates if any(w in c.lower() for w in _DATE_WORDS)]
    return df.withColumns({c: _parsed(c) for c in [*candidates, *named]})


def result_summary(df: DataFrame) -> DataFrame:
    names = F.array(*(F.lit(c) for c in df.columns))
    return df.agg(F.count("*").alias("row_count")).select(
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.array_join(names, ",").alias("columns"),
        (F.col("row_count") == 0).alias("is_empty"),
    )


def row_cap(df: DataFrame, n: int = MAX_ROWS) -> DataFrame:
    """At most n rows, in the order the result already has."""
    return df.limit(n)


def capped_sql(sql: Column, n: int = MAX_ROWS) -> Column:
    """The statement with a row limit, unless the word LIMIT occurs anywhere in it."""
    bare = F.regexp_replace(strip(sql), ";+$", "")
    suffix = F.when(has_word(bare, "limit"), F.lit(";")).otherwise(F.lit(f" LIMIT {n};"))
    return F.concat(bare, suffix)
