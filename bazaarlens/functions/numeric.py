"""Exact arithmetic for totals, averages and percentages.

Money is added up in whole cents: a sum of big integers does not depend on the
order in which tasks finish, and is several times cheaper per row than a sum of
wide decimals. Ratios are decimal and round a half away from zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

TOTAL = "decimal(24,2)"
COUNT = "decimal(20,0)"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def cents(value: Column | str) -> Column:
    """Money as a whole number of cents."""
    return (_col(value) * F.lit(100)).cast("bigint")


def money(value: Column | str) -> Column:
    """Cents back to a decimal amount."""
    return (_col(value).cast("decimal(22,2)") / F.lit(100)).cast(TOTAL)


def mean(numerator: Column | str, count: Column | str, digits: int) -> Column:
    """Average from a sum and a count, rounded."""
    return F.round(_col(numerator).cast(TOTAL) / F.nullif(_col(count).cast(COUNT), F.lit(0).cast(COUNT)), digits)


def percent(numerator: Column | str, denominator: Column | str, digits: int = 1) -> Column:
    """``100 * numerator / denominator``, rounded; NULL where the divisor is zero."""
    hundredfold = F.lit(100) * _col(numerator).cast(TOTAL)
    return F.round(hundredfold / F.nullif(_col(denominator).cast(TOTAL), F.lit(0).cast(TOTAL)), digits)


def average_money(value: Column | str, count: Column | str, digits: int = 2) -> Column:
    """Average amount from a sum in cents and a count, rounded."""
    return mean(money(value), count, digits)


def sum_if(condition: Column, value: Column | str) -> Column:
    """Sum over matching rows; NULL, not zero, when none match."""
    return F.sum(F.when(condition, _col(value)))


def plain_types(df: DataFrame) -> DataFrame:
    """Decimals to double and integers to bigint, for comparison across engines.

    Ratios carry more digits than a double keeps; they are rounded to six.
    """
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            if field.dataType.scale > 6:
                column = F.round(column, 6)
            column = column.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)
