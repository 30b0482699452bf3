"""Date and time helpers. Zoneless timestamps are read in the session zone, UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(text: Column, fmt: str = "yyyyMMdd") -> Column:
    """Parse to a date; text that does not match the format gives null."""
    return F.try_to_timestamp(text, F.lit(fmt)).cast("date")


def date_parts(moment: Column) -> dict[str, Column]:
    """Year, month, day and hour as integers."""
    return {
        "year": F.year(moment).cast("int"),
        "month": F.month(moment).cast("int"),
        "day": F.dayofmonth(moment).cast("int"),
        "hour": F.hour(moment).cast("int"),
    }


def weekday(moment: Column) -> Column:
    """Day of the week with Monday = 0 and Sunday = 6."""
    return F.weekday(moment).cast("int")


def is_weekend(moment: Column) -> Column:
    return (weekday(moment) >= 5).cast("int")


def duration_seconds(start: Column, stop: Column) -> Column:
    """Whole seconds between two timestamps, cut toward zero, in 64 bits."""
    millis = F.unix_millis(stop.cast("timestamp")) - F.unix_millis(start.cast("timestamp"))
    # Both are exact in double for any date, and the cast cuts toward zero.
    return (millis / F.lit(1000)).cast("long")
