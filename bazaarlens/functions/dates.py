"""Calendar helpers over zone-less timestamps and dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Order in which non-ISO spellings are tried; fixed values. A text that fits two
# of them (05/11/2024) takes the first, so month-first wins by default.
DATE_PATTERNS = ("M/d/yyyy", "M-d-yyyy", "d-MMM-yyyy", "d/M/yyyy")


def parse_date(text: Column, patterns: Sequence[str] = DATE_PATTERNS) -> Column:
    """ISO date, else the first pattern that fits, else NULL; blank is NULL."""
    cleaned = F.nullif(F.trim(text), F.lit(""))
    return F.coalesce(cleaned.try_cast("date"), *[F.try_to_date(cleaned, p) for p in patterns])


def month_of(timestamp: Column | str) -> Column:
    """First day of the month, as a date."""
    column = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    return F.trunc(column.cast("date"), "MM")


def months_apart(later: Column, earlier: Column) -> Column:
    """Whole months between two month starts."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def iso_weekday(date: Column) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(date) + 1
