"""Batch audit of SQL statements and questions with Catalyst expressions only.

The rules work on the whole text and reproduce a guard made of patterns, including what such a guard
gets wrong: ``extract(year from d)`` reads ``d`` as a table, a semicolon or forbidden word inside a
literal rejects, comma joins and quoted names go unseen, any schema prefix passes, and a CTE may
carry the name of a table that is not allowed.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.columns import SPACE, WORD, has_word, strip
from tradewind.schemas import MARTS

# What a statement may not contain.
FORBIDDEN_WORDS = (
    "INSERT",
    "UPDATE",
    "DELETE",
    "DROP",
    "ALTER",
    "TRUNCATE",
    "CREATE",
    "GRANT",
    "REVOKE",
)
SYSTEM_NAMES = (
    "information_schema",
    "pg_catalog",
    "pg_tables",
    "pg_class",
    "pg_attribute",
    "pg_indexes",
)

# What a question may not ask for.
FORBIDDEN_REQUESTS = (
    "delete",
    "drop",
    "truncate",
    "update",
    "insert",
    "alter",
    "remove",
    "modify",
    "create table",
    "delete all rows",
    "write sql that deletes",
)

# The messages of the guard.
SQL_OK = "SQL is valid."
SQL_EMPTY = "SQL is empty."
SQL_MANY = "Multiple SQL statements are not allowed."
SQL_NOT_SELECT = "Only SELECT queries are allowed."
SQL_FORBIDDEN = "SQL contains forbidden keywords."
SQL_INTO = "SELECT INTO is not allowed."
SQL_SYSTEM = "Access to system tables is not allowed."
SQL_NO_TABLE = "SQL must reference at least one allowed table."
SQL_NO_BASE = "SQL must reference at least one allowed base table."
QUESTION_OK = "Question is valid."
QUESTION_EMPTY = "Please enter a business analytics question."
QUESTION_FORBIDDEN = (
    "This application only supports read-only analytics questions. "
    "Requests that modify or delete data are not allowed."
)

# How the guard recognises table names, CTE names and SELECT INTO.
_NAME = "[a-zA-Z_][a-zA-Z0-9_]*"
_TABLE = rf"(?iu)(?<![{WORD}])(?:from|join){SPACE}+(?:([a-zA-Z0-9_]+)\.)?({_NAME})"
_CTE = (
    rf"(?iu)(?:(?<![{WORD}])with(?![{WORD}])|,){SPACE}*({_NAME}){SPACE}+as{SPACE}*\("
)
_INTO = rf"(?isu)(?<![{WORD}])select(?![{WORD}]).*(?<![{WORD}])into(?![{WORD}])"


def table_refs(sql: Column) -> Column:
    """Names after FROM or JOIN without schema prefix, as written, in order of appearance."""
    return F.regexp_extract_all(sql, F.lit(_TABLE), F.lit(2))


def cte_names(sql: Column) -> Column:
    """Lower-cased names defined before ``as (``, each once."""
    return F.array_distinct(
        F.transform(F.regexp_extract_all(sql, F.lit(_CTE), F.lit(1)), F.lower)
    )


def _any_word(text: Column, words: Sequence[str]) -> Column:
    return has_word(text, "(?:" + "|".join(words) + ")")


def audit_sql_log(
    log: DataFrame, column: str = "sql", allowed: Collection[str] = tuple(MARTS)
) -> DataFrame:
    """The log with the message of the first rule each statement breaks, or that it is valid.

    The parts several rules look at are columns of their own, so each is worked out once per row.
    """
    text, tables, ctes, base = (F.col(f"_{c}") for c in ("text", "tables", "ctes", "base"))
    # A literal list inside filter() has to be an array; isin() only compares with a column.
    known = F.array(*(F.lit(t) for t in sorted(allowed)))
    parts = (
        log.withColumn("_text", strip(F.col(column)))
        .withColumns({"_tables": table_refs(text), "_ctes": cte_names(text)})
        .withColumn("_base", F.filter(tables, lambda t: ~F.array_contains(ctes, F.lower(t))))
    )
    one = strip(F.regexp_replace(text, ";$", ""))
    stranger = F.get(F.filter(base, lambda t: ~F.array_contains(known, F.lower(t))), F.lit(0))
    start = F.upper(text)
    message = (
        F.when(text == "", SQL_EMPTY)
        .when(F.contains(one, F.lit(";")), SQL_MANY)
        .when(~(start.startswith("SELECT") | start.startswith("WITH")), SQL_NOT_SELECT)
        .when(_any_word(text, FORBIDDEN_WORDS), SQL_FORBIDDEN)
        .when(text.rlike(_INTO), SQL_INTO)
        .when(_any_word(text, SYSTEM_NAMES), SQL_SYSTEM)
        .when(F.size(tables) == 0, SQL_NO_TABLE)
        .when(
            stranger.isNotNull(),
            F.concat(F.lit("Table '"), stranger, F.lit("' is not allowed.")),
        )
        .when(F.size(base) == 0, SQL_NO_BASE)
        .otherwise(SQL_OK)
    )
    return (
        parts.withColumn("message", message)
        .withColumn("is_valid", F.col("message") == SQL_OK)
        .drop("_text", "_tables", "_ctes", "_base")
    )


def question_message(question: Column) -> Column:
    text = F.lower(strip(question))
    return (
        F.when(text == "", QUESTION_EMPTY)
        .when(_any_word(text, FORBIDDEN_REQUESTS), QUESTION_FORBIDDEN)
        .otherwise(QUESTION_OK)
    )


def audit_questions(questions: DataFrame, column: str = "text") -> DataFrame:
    return questions.withColumn("message", question_message(F.col(column))).withColumn(
        "is_valid", F.col("message") == QUESTION_OK
    )


def table_usage(log: DataFrame, column: str = "sql") -> DataFrame:
    """How often each table is referenced in the log."""
    return (
        log.select(F.explode(table_refs(F.col(column))).alias("table_name"))
        .groupBy("table_name")
        .agg(F.count("*").alias("references"))
    )


def cte_usage(log: DataFrame, column: str = "sql") -> DataFrame:
    """How many statements define each CTE name."""
    return (
        log.select(F.explode(cte_names(F.col(column))).alias("cte_name"))
        .groupBy("cte_name")
        .agg(F.count("*").alias("statements"))
    )


def strip_fences(text: Column) -> Column:
    """Drop a leading Markdown fence, with or without the language, and a trailing one."""
    fence = "```"
    cut = F.regexp_replace(strip(text), rf"(?iu)^{fence}sql{SPACE}*", "")
    cut = F.regexp_replace(cut, rf"^{fence}{SPACE}*", "")
    return strip(F.regexp_replace(cut, rf"{SPACE}*{fence}$", ""))


def question_key(question: Column) -> Column:
    return F.sha2(F.lower(strip(question)), 256)


def recent_questions(
    asked: DataFrame, session: str, question: str, at: str, n: int = 5
) -> DataFrame:
    """Last n distinct questions per session, newest first; asking again moves a question up.

    Repeats collapse in the partial aggregate, and the rank filter is applied inside the tasks before
    the shuffle, so a session with very many questions sends n rows per task.
    """
    last = asked.groupBy(session, question).agg(F.max(at).alias("last_asked"))
    newest = Window.partitionBy(session).orderBy(F.col("last_asked").desc(), F.col(question))
    return last.withColumn("position", F.row_number().over(newest)).where(F.col("position") <= n)
