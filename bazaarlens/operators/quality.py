"""Row counts, quality summary, and an audit of keys and domains."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from bazaarlens.functions.dates import DATE_PATTERNS, parse_date
from bazaarlens.functions.text import blank_to_null
from bazaarlens.operators.aggregates import VALID_MINUTES, count_where
from bazaarlens.schemas import DOMAINS, FOREIGN_KEYS, PRIMARY_KEYS, RANGES, REQUIRED


def _union(frames: list[DataFrame]) -> DataFrame:
    """All frames have the same columns in the same order."""
    return reduce(DataFrame.union, frames)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One labelled count per table."""
    return _union(
        [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    ).orderBy("table_name")


def dq_summary(
    raw_customers: DataFrame, customers: DataFrame, restaurants: DataFrame, orders: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Duplicates removed, missing ratings, missing and implausible delivery times."""

    def scalar(df: DataFrame, column: Column) -> Column:
        return df.agg(column.alias("n")).scalar()

    minutes = F.col("delivery_time_minutes")
    times = orders.agg(
        count_where(minutes.isNull()).alias("null_delivery_times"),
        count_where(minutes > VALID_MINUTES[1]).alias("outlier_delivery_times"),
    )
    kept = scalar(customers, F.count("*"))
    return times.select(
        kept.alias("customers_after_dedup"),
        (scalar(raw_customers, F.count("*")) - kept).alias("dupes_removed"),
        scalar(restaurants, count_where(F.col("avg_rating").isNull())).alias("null_ratings"),
        scalar(reviews, count_where(F.col("rating").isNull())).alias("null_review_ratings"),
        "null_delivery_times",
        "outlier_delivery_times",
    )


# Date columns of the raw tables.
RAW_DATES = {"customers": "signup_date", "restaurants": "active_since", "riders": "join_date", "reviews": "review_date"}


def unparsed_dates(raw: Mapping[str, DataFrame], patterns: Sequence[str] = DATE_PATTERNS) -> DataFrame:
    """Date texts per raw table, and how many of them fit no pattern and so become NULL."""
    found = []
    for table, column in RAW_DATES.items():
        text = blank_to_null(F.col(column))
        counts = raw[table].agg(
            F.count(text).alias("date_texts"),
            count_where(text.isNotNull() & parse_date(F.col(column), patterns).isNull()).alias("unparsed"),
        )
        found.append(counts.select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "date_texts", "unparsed"))
    return _union(found).orderBy("table_name")


def _value_rules(table: str, columns: list[str], domains: Mapping, ranges: Mapping) -> dict[str, Column]:
    """Violating-row condition per single-row rule; a NULL never breaks a domain or range."""
    rules = {f"{c} not null": F.col(c).isNull() for c in REQUIRED[table] if c in columns}
    for (owner, column), allowed in domains.items():
        if owner == table:
            rules[f"{column} in domain"] = ~F.col(column).isin(allowed)
    for (owner, column), (low, high) in ranges.items():
        if owner == table and column in columns:
            broken = F.col(column) < low
            rules[f"{column} in range"] = broken if high is None else broken | (F.col(column) > high)
    return rules


# Columns and rules of a table have numbers of so many bits.
_ITEM_BITS = 6


def _marks(df: DataFrame, keys: Sequence[str], rules: Mapping[str, Column]) -> DataFrame:
    """(item, bucket, bits, n) of one table in one pass: for each key column bitmaps of its values, for each rule its violations.

    A bitmap covers 32,768 neighbouring values; tasks combine theirs before the shuffle, so a popular value or a table with dense
    keys sends little. ``n`` counts rows, of a rule those that break it.
    """
    whole = lambda c: F.col(c).cast("bigint")
    pairs = [(F.lit(k), whole(c)) for k, c in enumerate(keys)]
    pairs += [(F.lit(k), F.when(broken, F.lit(0).cast("bigint"))) for k, broken in enumerate(rules.values(), len(keys))]
    exploded = df.select(F.inline(F.array(*[F.struct(k.alias("k"), v.alias("value")) for k, v in pairs]))).filter("value is not null")
    # Number of the column and bucket in one long, by which a task sorts quickest; bitmaps are combined in order of the group.
    place = F.shiftleft(F.call_function("bitmap_bucket_number", F.col("value")), _ITEM_BITS) + F.col("k")
    marks = exploded.groupBy(place.alias("place")).agg(
        F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", F.col("value"))).alias("bits"), F.count("*").alias("n")
    )
    names = F.array(*[F.lit(name) for name in (*keys, *rules)])
    number = F.col("place").bitwiseAND((1 << _ITEM_BITS) - 1).cast("int")
    return marks.select(F.get(names, number).alias("item"), F.shiftright("place", _ITEM_BITS).alias("bucket"), "bits", "n")


def _orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> Column:
    """Rows whose reference has no target, counted per value before the join."""
    used = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("bigint").alias("value")).agg(F.count("*").alias("n"))
    known = parent.select(F.col(key).cast("bigint").alias("value"))
    return used.join(known, "value", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n")).scalar()


def constraint_audit(
    tables: Mapping[str, DataFrame], domains: Mapping = DOMAINS, ranges: Mapping = RANGES
) -> DataFrame:
    """Violations of every key, reference, domain, range and not-null rule.

    Each table is read once, into bitmaps of its key values and counts of broken rules (``_marks``). A key is
    unique if its bitmaps have as many bits as it has rows, and a reference whole if the parent's
    bitmaps gain no bit from the child's. Only for a reference that is not, child and parent are read
    again, to count rows. What reaches the driver is one row for each rule.
    """
    references = [r for r in FOREIGN_KEYS if r[0] in tables and r[2] in tables]
    references = [r for r in references if r[1] in tables[r[0]].columns and r[3] in tables[r[2]].columns]
    marked, rules = [], []
    for name, df in tables.items():
        own = _value_rules(name, df.columns, domains, ranges)
        keyed = [PRIMARY_KEYS[name], *[c for child, c, _, _ in references if child == name]]
        keyed += [key for _, _, parent, key in references if parent == name]
        keys = [c for c in dict.fromkeys(keyed) if c in df.columns]
        marked.append(_marks(df, keys, own).select(F.lit(name).alias("table"), "*"))
        rules += [(name, rule, rule) for rule in own]
        if PRIMARY_KEYS[name] in keys:
            rules.append((name, f"{PRIMARY_KEYS[name]} unique", PRIMARY_KEYS[name]))
    # A key's own marks, and for each reference those of either end under one name, so that they meet by bucket.
    ends = [(child, column, f"{k}", False) for k, (child, column, _, _) in enumerate(references)]
    ends += [(parent, key, f"{k}", True) for k, (_, _, parent, key) in enumerate(references)]
    role = lambda use, of: F.struct(F.lit(use).alias("use"), F.lit(of).alias("parent"))
    uses = F.array(
        role("", False), *[F.when((F.col("table") == t) & (F.col("item") == c), role(use, of)) for t, c, use, of in ends]
    )
    marks = _union(marked).withColumn("x", F.explode(F.array_compact(uses)))
    mine = F.col("x.use") == ""
    bits = F.call_function("bitmap_count", F.col("bits"))
    owner = F.when(mine, F.concat_ws(":", "table", "item"))
    met = marks.groupBy("x.use", owner.alias("owner"), "bucket").agg(
        F.call_function("bitmap_or_agg", F.col("bits")).alias("all_bits"),
        F.sum(F.when(F.col("x.parent"), bits).otherwise(0)).alias("parent_bits"),
        F.sum("n").alias("n"),
    )
    all_bits = F.call_function("bitmap_count", F.col("all_bits"))
    counted = {
        (r["use"], r["owner"]): r
        for r in met.groupBy("use", "owner").agg(F.sum("n").alias("n"), F.sum(all_bits).alias("bits"), F.sum("parent_bits").alias("parent_bits")).collect()
    }

    def violations(table: str, rule: str, item: str) -> int:
        found = counted.get(("", f"{table}:{item}"))
        return 0 if found is None else found["n"] - found["bits"] if rule.endswith(" unique") else found["n"]

    known = [(table, rule, violations(table, rule, item)) for table, rule, item in rules]
    broken = []
    for k, (child, column, parent, key) in enumerate(references):
        found = counted.get((str(k), None))
        if found is None or found["bits"] == found["parent_bits"]:
            known.append((child, f"{column} in {parent}", 0))
        else:
            broken.append((child, f"{column} in {parent}", _orphans(tables[child], column, tables[parent], key)))
    one = lambda t, r, n: F.struct(F.lit(t).alias("table_name"), F.lit(r).alias("rule"), F.coalesce(n, F.lit(0)).cast("bigint").alias("violations"))
    listed = [one(t, r, F.lit(n)) for t, r, n in known] + [one(*x) for x in broken]
    spark = next(iter(tables.values())).sparkSession
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*listed))).orderBy("table_name", "rule")
