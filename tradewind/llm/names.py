"""Helper columns that clash with no column of the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(columns: list[str]) -> list[str]:
    """Names that select these columns, dots and all."""
    return ["`" + c.replace("`", "``") + "`" for c in columns]
