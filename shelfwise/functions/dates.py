"""Date parsing and calendar expressions (JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO first (the strict format), then the lenient fallbacks,
# month-first as in the pandas default.
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "yyyy/MM/dd", "MM-dd-yyyy",
                "dd.MM.yyyy", "yyyyMMdd")


def parse_date(text: Column | str, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """First format that parses wins; unparseable text becomes NULL."""
    col = F.col(text) if isinstance(text, str) else text
    col = F.trim(col)
    return F.coalesce(*[F.try_to_date(col, fmt) for fmt in formats])


def day_of_week(d: Column) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(d).cast("int")


def is_weekend(d: Column) -> Column:
    return (F.weekday(d) >= 5).cast("int")


def day_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def quarter_label(d: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"))


def weekend_label(d: Column) -> Column:
    return F.when(F.weekday(d) >= 5, F.lit("Weekend")).otherwise(F.lit("Weekday"))


def day_number(d: Column) -> Column:
    """Days since 1970-01-01; an integer order key for calendar (RANGE) frames."""
    return F.unix_date(d)
