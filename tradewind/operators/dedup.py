"""Keep the first row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.schemas import POSITION


def dedup_keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    late: Mapping[str, Column] | None = None,
) -> DataFrame:
    """First row per key; nulls in a key equal each other.

    "First" follows ``order``, else the source position, and ties fall to the remaining columns, so
    the result does not depend on task timing. ``row_number() = 1`` is planned with a group limit
    before the shuffle: each task sends at most one row per key, so a key that holds a large share
    of the rows costs the reducer one row per task.

    ``late`` gives columns as expressions of the source position alone. They are equal on rows with equal
    positions, so they never decide, and are made after the shuffle, which carries the position in any case.
    """
    late = late or {}
    columns = [c for c in df.columns if c != POSITION]
    df = df.drop(*late)
    first = list(order) if order else [POSITION] if POSITION in df.columns else []
    rest = [c for c in df.columns if c not in keys and c not in first]
    by_first = Window.partitionBy(*keys).orderBy(*first, *rest)
    return (
        df.withColumn("_rank", F.row_number().over(by_first))
        .where(F.col("_rank") == 1)
        .select(*(late[c].alias(c) if c in late else c for c in columns))
    )
