"""What cleaning leaves out: rows without a place in the clean tables, and values that become NULL, each with its reason.

Cleaning and rejecting are two outputs of one pass: a raw table is typed and tagged once (``tagged``), written, and
split, so that kept and rejected rows together are always the raw ones.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from bazaarlens.functions.dates import DATE_PATTERNS, parse_date
from bazaarlens.functions.text import blank_to_null, natural_key
from bazaarlens.operators.joins import broadcast_if_small
from bazaarlens.schemas import PRIMARY_KEYS

DUPLICATE, UNREAD, NEGATIVE = "duplicate", "unread date", "negative"
#: Of a raw table the date columns, and numbers that may not be negative.
DATES = {"customers": "signup_date", "restaurants": "active_since", "riders": "join_date", "reviews": "review_date"}
NOT_NEGATIVE = {"orders": "delivery_time_minutes"}
#: Of a child the parents that a row needs, in the order in which they are named as the reason.
PARENTS = {
    "orders": (("restaurant_id", "restaurants"), ("customer_id", "customers")),
    "order_items": (("order_id", "orders"),),
    "reviews": (("order_id", "orders"),),
}


@dataclass(frozen=True)
class Sorted:
    """Of one raw table: its ``kept`` rows as they came, and (table_name, row_id, column_name, value, reason) of what is left out."""

    kept: DataFrame
    rejects: DataFrame


def _first_of_person(raw: DataFrame) -> Column:
    """Whether a row is the one of its person and city that stays: the lowest id, of equal ids any one row."""
    number = F.col("customer_id").cast("bigint")
    person = Window.partitionBy(natural_key(F.col("name")), natural_key(F.coalesce("city", F.lit("")))).orderBy(number)
    return F.row_number().over(person) == 1


def _values(table: str, patterns: Sequence[str]) -> list[tuple[str, Column, str]]:
    """(column, whether its value is lost, reason)."""
    found = []
    if table in DATES:
        column = F.col(DATES[table])
        found.append((DATES[table], blank_to_null(column).isNotNull() & parse_date(column, patterns).isNull(), UNREAD))
    if table in NOT_NEGATIVE:
        name = NOT_NEGATIVE[table]
        found.append((name, F.coalesce(F.nullif(F.col(name), F.lit("")).cast("int") < 0, F.lit(False)), NEGATIVE))
    return found


def tagged(table: str, raw: DataFrame, parents: Mapping[str, DataFrame], patterns: Sequence[str] = DATE_PATTERNS) -> DataFrame:
    """``raw`` with ``_row_reject`` (column, value, reason; null if the row stays) and ``_value_rejects``, a list of the same.

    ``parents`` are the kept rows of the tables that this one refers to. Their keys are one column, sent to
    every task where that is small.
    """
    entry = lambda c, reason: F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"), F.lit(reason).alias("reason"))
    df, reasons = raw, []
    if table == "customers":
        df = df.withColumn("_first", _first_of_person(raw))
        reasons.append(F.when(~F.col("_first"), entry("customer_id", DUPLICATE)))
    for column, parent in PARENTS.get(table, ()):
        keys = parents[parent].select(F.col(PRIMARY_KEYS[parent]).cast("bigint").alias(f"_{parent}")).distinct()
        df = df.join(broadcast_if_small(keys), F.col(column).cast("bigint") == F.col(f"_{parent}"), "left")
        reasons.append(F.when(F.col(f"_{parent}").isNull(), entry(column, f"not in {parent}")))
    lost = [F.when(broken, entry(c, reason)) for c, broken, reason in _values(table, patterns)]
    kind = "struct<column_name:string,value:string,reason:string>"
    return df.select(
        *[raw[c] for c in raw.columns],
        (F.coalesce(*reasons) if reasons else F.lit(None)).cast(kind).alias("_row_reject"),
        F.array_compact(F.array(*lost)).cast(f"array<{kind}>").alias("_value_rejects") if lost else F.array().cast(f"array<{kind}>").alias("_value_rejects"),
    )


def split(table: str, done: DataFrame) -> Sorted:
    """The two outputs of a table as ``tagged``; a rejected row is one entry, its values are not looked at."""
    own = [c for c in done.columns if c not in ("_row_reject", "_value_rejects")]
    key = F.col(PRIMARY_KEYS[table] if PRIMARY_KEYS[table] in own else own[0])
    of_row = F.when(F.col("_row_reject").isNotNull(), F.array("_row_reject")).otherwise(F.col("_value_rejects"))
    rejects = done.select(F.lit(table).alias("table_name"), key.cast("string").alias("row_id"), F.col("_row_reject").isNotNull().alias("whole_row"), F.explode(of_row).alias("x"))
    return Sorted(done.filter("_row_reject is null").select(*own), rejects.select("table_name", "row_id", "whole_row", "x.*"))


def sort_out(raw: Mapping[str, DataFrame], put: Callable[[str, DataFrame], DataFrame], patterns: Sequence[str] = DATE_PATTERNS) -> dict[str, Sorted]:
    """Kept rows and rejects of every raw table, parents first.

    ``put(name, df)`` writes a tagged table and returns it as written; each raw table is read once.
    """
    found: dict[str, Sorted] = {}
    for table in ("customers", "restaurants", "menu_items", "riders", "orders", "order_items", "reviews"):
        if table in raw:
            kept = {name: done.kept for name, done in found.items()}
            found[table] = split(table, put(table, tagged(table, raw[table], kept, patterns)))
    return found


def balance(raw: Mapping[str, DataFrame], found: Mapping[str, Sorted]) -> DataFrame:
    """Per table: raw, kept and rejected rows, and values lost from kept rows."""
    parts = []
    for table, done in found.items():
        lost = done.rejects.agg(F.count_if("whole_row").alias("rejected_rows"), F.count_if(~F.col("whole_row")).alias("lost_values"))
        kept = done.kept.agg(F.count("*").alias("n")).scalar()
        parts.append(lost.select(F.lit(table).alias("table_name"), raw[table].agg(F.count("*").alias("n")).scalar().alias("raw_rows"), kept.alias("kept_rows"), "rejected_rows", "lost_values"))
    return reduce(DataFrame.union, parts).orderBy("table_name")
