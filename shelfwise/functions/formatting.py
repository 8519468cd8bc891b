"""Presentation columns for planner-facing reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SUFFICIENT_DAYS = 999.0


def units_text(c: Column) -> Column:
    """1234.4 -> "1,234 units"; NULL -> "N/A"."""
    return F.coalesce(F.concat(F.format_number(c, 0), F.lit(" units")), F.lit("N/A"))


def days_text(c: Column) -> Column:
    """"3.0 days", or "Sufficient" at 999 days and beyond."""
    return (F.when(c.isNull(), F.lit("N/A"))
            .when(c >= SUFFICIENT_DAYS, F.lit("Sufficient"))
            .otherwise(F.concat(F.format_number(c, 1), F.lit(" days"))))


def money_text(c: Column) -> Column:
    """1234.5 -> "$1,234.50"."""
    return F.coalesce(F.concat(F.lit("$"), F.format_number(c, 2)), F.lit("N/A"))
