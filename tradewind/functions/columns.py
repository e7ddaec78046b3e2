"""Column expressions shared by the plans. All of them stay inside code generation and depend
neither on the session time zone nor on the ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.schemas import MONEY

MICROS_PER_DAY = 86400e6

# Word characters and white space in the Unicode sense (Java's \w and \s know ASCII only).
WORD = r"\p{L}\p{N}_"
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"


def plus_seconds(ts: Column, seconds: Column) -> Column:
    zero = F.lit(0)
    return ts + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))


def plus_days(ts: Column, days: Column) -> Column:
    return ts + F.make_dt_interval(days.cast("int"))


def micros_between(end: Column, start: Column) -> Column:
    """end - start in microseconds; exact for zone-less timestamps."""
    gap = end - start

    def part(unit: str) -> Column:
        return F.extract(F.lit(unit), gap)

    whole = (
        part("DAY").cast("bigint") * 86400 + part("HOUR").cast("bigint") * 3600
        + part("MINUTE").cast("bigint") * 60
    )
    return whole * 1_000_000 + (part("SECOND") * 1_000_000).cast("bigint")


def days_between(end: Column, start: Column) -> Column:
    return micros_between(end, start).cast("double") / F.lit(MICROS_PER_DAY)


# English weekday names, Monday first.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def month_label(day: Column) -> Column:
    """``yyyy-MM``. Taken from the text of the date, since date_format goes through the zone."""
    return F.substring(day.cast("date").cast("string"), 1, 7)


def month_start(ts: Column) -> Column:
    """First instant of the month as a zone-less timestamp (date_trunc would go through the zone)."""
    return F.trunc(ts.cast("date"), "MM").cast("timestamp_ntz")


def weekday_name(day: Column) -> Column:
    return F.get(F.array(*(F.lit(d) for d in WEEKDAYS)), F.weekday(day.cast("date")))


def iso_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, fractions of a second cut."""
    return F.regexp_replace(ts.cast("string"), r"\.\d+$", "")


def day_type(weekday: Column) -> Column:
    return F.when(weekday.isin("Saturday", "Sunday"), "Weekend").otherwise("Weekday")


def mean_exact(value: Column) -> Column:
    """Mean of an exact number (integer or decimal); the same whatever the partitioning."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def mean_days(value: Column) -> Column:
    """Mean of a double in days. Summed as a decimal, since a sum of doubles depends on the order."""
    return mean_exact(value.cast("decimal(20,8)"))


def round_half_up(value: Column, digits: int = 2) -> Column:
    """Round on the decimal expansion, so ties do not depend on binary representation."""
    return F.round(value.cast("decimal(30,10)"), digits).cast(f"decimal(22,{digits})")


def share_pct(part: Column, whole: Column) -> Column:
    return round_half_up(F.try_divide(part.cast("double") * 100, whole.cast("double")))


def flag(condition: Column) -> Column:
    """1 where true, 0 where false or unknown."""
    return F.when(condition, 1).otherwise(0)


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def missing(df: DataFrame, name: str) -> Column:
    """Null, or not a number in a float column."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def parse_money(text: Column) -> Column:
    """Text or number as an amount; what is no number becomes null, a number too large is an error."""
    amount = text.try_cast(MONEY)
    number = text.try_cast("double")
    large = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf"))
    too_large = F.raise_error(
        F.concat(F.lit(f"amount beyond {MONEY.simpleString()}: "), text.cast("string"))
    )
    return F.when(amount.isNull() & large, too_large.cast(MONEY)).otherwise(amount)


def parse_whole(text: Column) -> Column:
    """Text as a whole number. "3.0" is one, which once shared a column with missing values; a
    fraction is not, and becomes null like any text that is no number."""
    exact = text.try_cast("decimal(38,10)")
    rough = text.try_cast("double").try_cast("decimal(38,10)")  # "1e3"
    number = F.coalesce(exact, rough)
    return F.when(number == F.floor(number), number).try_cast("int")


def parse_timestamp(text: Column) -> Column:
    """Text to a zone-less timestamp cut to the second; unparsable text becomes null."""
    return iso_text(text).try_cast("timestamp_ntz")


def cut_to_second(ts: Column) -> Column:
    second = F.extract(F.lit("SECOND"), ts)
    zero = F.lit(0)
    return ts - F.make_dt_interval(zero, zero, zero, (second - F.floor(second)).cast("decimal(18,6)"))


def strip(text: Column) -> Column:
    """Cut white space of any kind on both sides (trim would cut blanks only)."""
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+$", "")


def has_word(text: Column, word: str) -> Column:
    """The phrase occurs with no word character next to it; case does not matter."""
    return text.rlike(rf"(?iu)(?<![{WORD}]){word}(?![{WORD}])")
