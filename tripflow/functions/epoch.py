"""Time logic on epoch microseconds.

Raw trips carry their times as BIGINT microseconds, so minutes, hours and dates
come from integer arithmetic: cheaper per row than calendar functions and the
same under any session time zone.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE = 60_000_000
HOUR = 60 * MINUTE
DAY = 24 * HOUR
YEAR_ONE = 719_162 * DAY  # from 0001-01-01 to 1970-01-01


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def literal_micros(moment: str) -> Column:
    """An ISO date or time as a BIGINT literal, so comparisons reach the Parquet scan."""
    since = datetime.fromisoformat(moment) - datetime(1970, 1, 1)
    return F.lit(since // timedelta(microseconds=1)).cast("bigint")


def from_micros(micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros, _epoch())


def _minute(moment: Column) -> Column:
    """Whole minutes since the epoch of a TIMESTAMP_NTZ.

    Built from its calendar fields: Spark's timestamp differences pass through the
    session time zone, which moves or drops wall-clock times around clock changes.
    """
    days = F.unix_date(moment.cast("date")).cast("bigint")
    return days * 1440 + F.hour(moment) * 60 + F.minute(moment)


def to_micros(moment: Column) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ, read as UTC wall-clock time."""
    seconds = F.date_part(F.lit("SECOND"), moment)  # DECIMAL(8,6)
    return _minute(moment) * F.lit(MINUTE) + (seconds * 1_000_000).cast("bigint")


def minutes_between_times(start: Column, end: Column) -> Column:
    """``minutes_between`` for TIMESTAMP_NTZ columns."""
    return _minute(end) - _minute(start)


def _units(micros: Column, unit: int) -> Column:
    """Completed units since 0001-01-01.

    Counting from there keeps every valid time positive, so that integer division,
    which truncates, rounds down before 1970 too.
    """
    return F.call_function("div", micros + F.lit(YEAR_ONE), F.lit(unit))


def minutes_between(start_micros: Column, end_micros: Column) -> Column:
    """Minute boundaries crossed: 00:00:59 to 00:01:01 is one minute."""
    return _units(end_micros, MINUTE) - _units(start_micros, MINUTE)


def epoch_date(micros: Column) -> Column:
    days = _units(micros, DAY) - F.lit(YEAR_ONE // DAY)
    return F.date_from_unix_date(days.cast("int"))


def epoch_hour(micros: Column) -> Column:
    return (_units(micros, HOUR) % 24).cast("int")


def day_of_week(date: Column) -> Column:
    """0 is Sunday, 6 is Saturday."""
    return F.dayofweek(date) - 1


_YEAR_MONTH = r"\d{4}-\d{2}"


def file_month_text(file_name: Column) -> Column:
    """The first YYYY-MM in a file name, NULL if there is none."""
    return F.regexp_substr(file_name, F.lit(_YEAR_MONTH))


def file_month(file_name: Column) -> Column:
    """First day of the month a file name carries; NULL when it names no real month.

    ``regexp_extract`` is evaluated once where ``regexp_substr`` may be twice; its empty
    text for no match is no date either.
    """
    year_month = F.regexp_extract(file_name, _YEAR_MONTH, 0)
    return F.concat(year_month, F.lit("-01")).try_cast("date")


def time_period(hour: Column) -> Column:
    # Hour bands and their labels.
    return (
        F.when(hour.between(7, 9), "morning_rush")
        .when(hour.between(17, 19), "evening_rush")
        .when((hour >= 22) | (hour <= 4), "night")
        .otherwise("daytime")
    )
