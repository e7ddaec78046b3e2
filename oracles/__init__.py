"""The registered queries as SQL, written independently of the Spark plans, to check them against."""

from oracles.compose import all_sql

__all__ = ["all_sql"]
