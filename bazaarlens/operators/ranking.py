"""Ranking that never gathers one large group in a single task.

A window without ``PARTITION BY``, or with one very large partition, sorts all
those rows in one task. The functions here range-partition by the sort keys
instead, number the rows inside each slice, and add the size of all earlier
slices. Sort keys must end in a unique column, so that every order is total.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from bazaarlens.session import cut_lineage

# Up to this many rows are ordered by a plain window in one task. Both ways number the same total
# order, so the limit never shows in a result; tests compare them just below, at and above it.
TASK_ROWS = 200_000

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def _slices(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows cut into sorted ranges; ``_slice`` and ``_row`` give each row's place.

    The ranges come from a sample, so the tagged rows are written out once:
    counting the slices and numbering the rows must see the same cut.
    """
    tagged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    return cut_lineage(
        tagged.withColumn("_slice", F.shiftright("_id", _ROW_BITS))
        .withColumn("_row", F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1))
        .drop("_id")
    )


def measured(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` written to the shared folder, and its row count."""
    written = cut_lineage(df)
    return written, written.count()


def global_row_number(
    df: DataFrame, order: Sequence[Column], name: str, rows: int | None = None, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Position of every row in one overall order, from 1.

    ``rows`` is the row count where the caller knows it.
    """
    if rows is None:
        df, rows = measured(df)
    if rows <= task_rows:
        return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    tagged = _slices(df, order)
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice, so at most spark.sql.shuffle.partitions rows.
    starts = (
        tagged.groupBy("_slice")
        .agg(F.count("*").alias("_n"))
        .select("_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    return tagged.join(F.broadcast(starts), "_slice").select(
        *df.columns, (F.col("_start") + F.col("_row") + 1).alias(name)
    )


def global_ntile(
    df: DataFrame,
    buckets: int,
    order: Sequence[Column],
    name: str,
    rows: int | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """``NTILE(buckets)`` over all rows: the first buckets take the surplus rows."""
    if rows is None:
        df, rows = measured(df)
    if rows <= task_rows:
        return df.withColumn(name, F.ntile(buckets).over(Window.orderBy(*order)))
    size, surplus = divmod(rows, buckets)
    wide = surplus * (size + 1)  # rows held by the buckets that take a surplus row
    index = F.col("_position") - 1
    bucket = F.when(index < wide, F.call_function("div", index, F.lit(size + 1))).otherwise(
        surplus + F.call_function("div", index - wide, F.lit(max(size, 1)))
    )
    placed = global_row_number(df, order, "_position", rows, task_rows)
    return placed.select(*df.columns, (bucket + 1).cast("int").alias(name))


#: Bins of one search range; a range of 2**64 values needs five rounds of them.
_BINS = 1 << 14


def _selected(
    df: DataFrame, columns: Sequence[Column], places: Sequence[Sequence[int]], ends: Sequence[tuple[int, int]]
) -> list[list[tuple[int, int]]]:
    """For each of the whole-number ``columns``, with their least and greatest value, the value at every given place (from 1) of its
    ascending order, and the place among the rows of that value.

    Each round counts rows per bin of the ranges that are still open, those of all columns and places in one pass, and narrows every
    range to the bin that holds its place. The driver gets some ten thousand counts a range and round; rows are never moved. Nulls are left out.
    """
    # (column, place) -> range that holds the value, and the rank left inside it
    ranges = {(i, p): (*ends[i], p) for i, own in enumerate(places) for p in own}
    while wide := sorted({(i, low, high) for (i, _), (low, high, _) in ranges.items() if low < high}):
        marks = []
        for k, (i, low, high) in enumerate(wide):
            step = -(-(high - low + 1) // _BINS)
            at = F.call_function("div", columns[i] - F.lit(low), F.lit(step))
            marks.append(F.struct(F.lit(k).alias("k"), F.when(columns[i].between(low, high), at).alias("bin")))
        binned = df.select(F.inline(F.array(*marks))).filter("bin is not null").groupBy("k", "bin").agg(F.count("*").alias("n"))
        counts: dict[int, list[tuple[int, int]]] = {}
        for row in sorted(binned.collect()):
            counts.setdefault(row["k"], []).append((row["bin"], row["n"]))
        narrowed = {}
        for (i, p), (low, high, left) in ranges.items():
            if low < high:
                step = -(-(high - low + 1) // _BINS)
                for found, n in counts[wide.index((i, low, high))]:
                    if left <= n:
                        break
                    left -= n
                low, high = low + found * step, min(high, low + (found + 1) * step - 1)
            narrowed[i, p] = (low, high, left)
        ranges = narrowed
    return [[(ranges[i, p][0], ranges[i, p][2]) for p in own] for i, own in enumerate(places)]


def ntiles_by_bounds(
    df: DataFrame, buckets: int, axes: Sequence[tuple[str, str, bool]], key: str, rows: int, task_rows: int = TASK_ROWS
) -> DataFrame:
    """``NTILE(buckets)`` by each of several whole numbers, ties by a unique whole-number key, where NULLs rank worst.

    ``axes`` are (column, name of the result, descending); nulls come last, in descending order first. Many rows are not
    sorted: the last (number, key) pair of each bucket is found by counting (``_selected``), first its number, then its key among
    the rows of that number, and a row's bucket is the number of such pairs before it.
    """
    if rows <= task_rows:
        for axis, name, descending in axes:
            order = [F.desc_nulls_first(axis) if descending else F.asc_nulls_last(axis), F.asc(key)]
            df = df.withColumn(name, F.ntile(buckets).over(Window.orderBy(*order)))
        return df
    size, surplus = divmod(rows, buckets)
    last = [k * size + min(k, surplus) for k in range(1, buckets)]
    last = [p for p in last if p]
    values = [-F.col(axis).cast("bigint") if descending else F.col(axis).cast("bigint") for axis, _, descending in axes]
    ends = df.agg(
        F.min(key).alias("low"), F.max(key).alias("high"),
        *[f(c).alias(f"{n}{i}") for i, c in enumerate(values) for n, f in (("n", F.count), ("low", F.min), ("high", F.max))],
    ).first()
    filled = {axis: ends[f"n{i}"] for i, (axis, _, _) in enumerate(axes)}
    places = []
    for axis, _, descending in axes:
        # Nulls are the first ``nulls`` rows of a descending order and the last ones of an ascending one.
        nulls = rows - filled[axis]
        places.append([p - nulls for p in last if p > nulls] if descending else [p for p in last if p <= filled[axis]])
    found = _selected(df, values, places, [(ends[f"low{i}"], ends[f"high{i}"]) for i in range(len(values))])
    bounds = [[value for value, _ in own] for own in found]
    # Among the rows of a bound's number (or among the nulls): the key at the place that is left.
    conditions, at = [v == b for v, own in zip(values, bounds) for b in own], [left for own in found for _, left in own]
    n_tied = len(conditions)
    for axis, _, descending in axes:
        rest = [p for p in last if p <= rows - filled[axis]] if descending else [p - filled[axis] for p in last if p > filled[axis]]
        conditions += [F.col(axis).isNull()] * len(rest)
        at += rest
    tied = [F.when(c, F.col(key).cast("bigint")) for c in conditions]
    keys = [own[0][0] for own in _selected(df, tied, [[p] for p in at], [(ends["low"], ends["high"])] * len(tied))]
    own_keys, null_keys = iter(keys[:n_tied]), iter(keys[n_tied:])
    for (axis, name, descending), value, own in zip(axes, values, bounds):
        score, nulls = F.lit(1), rows - filled[axis]
        for b in own:
            after = (value > b) | ((value == b) & (F.col(key) > next(own_keys)))
            score = score + F.coalesce(after, F.lit(not descending)).cast("int")
        for _ in range(sum(p <= nulls for p in last) if descending else sum(p > filled[axis] for p in last)):
            after = F.col(axis).isNull() & (F.col(key) > next(null_keys))
            score = score + ((after | F.col(axis).isNotNull()) if descending else after).cast("int")
        df = df.withColumn(name, score)
    return df


def ntile_by_bounds(
    df: DataFrame,
    buckets: int,
    axis: str,
    key: str,
    name: str,
    rows: int,
    descending: bool = False,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """``ntiles_by_bounds`` for one axis."""
    return ntiles_by_bounds(df, buckets, [(axis, name, descending)], key, rows, task_rows)


def rank_by_value(
    df: DataFrame,
    value: str,
    rank: str,
    percent_rank: str,
    rows: int | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """``RANK`` and ``PERCENT_RANK`` over all rows by one ascending column.

    ``rows`` is the row count where the caller knows it; few rows take the plain
    window. Otherwise ties are counted per distinct value first, so a value shared by many rows
    costs one row; NULLs rank last.
    """
    order = [F.col(value).asc_nulls_last()]
    if rows is not None and rows <= task_rows:
        window = Window.orderBy(*order)
        return df.withColumn(rank, F.rank().over(window).cast("bigint")).withColumn(
            percent_rank, F.percent_rank().over(window)
        )
    values = cut_lineage(df.groupBy(value).agg(F.count("*").alias("_n")))
    distinct, rows = values.agg(F.count("*"), F.coalesce(F.sum("_n"), F.lit(0))).first()
    up_to = Window.rowsBetween(Window.unboundedPreceding, -1)
    if distinct <= task_rows:
        before = F.sum("_n").over(up_to.orderBy(*order))
        ranked = values.withColumn("_rank", F.coalesce(before, F.lit(0)) + 1)
    else:
        tagged = _slices(values, order)
        sizes = tagged.groupBy("_slice").agg(F.sum("_n").alias("_size"))
        starts = sizes.select(
            "_slice", F.coalesce(F.sum("_size").over(up_to.orderBy("_slice")), F.lit(0)).alias("_start")
        )
        local = F.sum("_n").over(up_to.partitionBy("_slice").orderBy("_row"))
        ranked = tagged.join(F.broadcast(starts), "_slice").withColumn(
            "_rank", F.col("_start") + F.coalesce(local, F.lit(0)) + 1
        )
    ranked = ranked.select(F.col(value).alias("_value"), "_rank")
    share = (F.col("_rank") - 1) / F.lit(max(rows - 1, 1))
    return df.join(ranked, F.col(value).eqNullSafe(F.col("_value"))).select(
        *df.columns, F.col("_rank").alias(rank), share.alias(percent_rank)
    )


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, name: str, ties: bool = False
) -> DataFrame:
    """First ``k`` rows of each group, or all rows of the first ``k`` distinct ranks.

    The limit on the rank is applied before the shuffle as well, so a large group
    sends at most its own top rows from each task.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    rank = F.dense_rank() if ties else F.row_number()
    return df.withColumn(name, rank.over(window)).filter(F.col(name) <= k)


def sequence_in_group(
    df: DataFrame,
    group: str,
    order: Sequence[Column],
    name: str,
    previous: tuple[str, str] | None = None,
    rows: int | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Row number inside each group and, as ``previous=(column, name)``, the value one row before.

    ``rows`` bounds the row count where the caller knows it. Up to ``task_rows`` rows a window per group does. More are sorted by
    group and order and cut into slices, all groups alike, in one pass that writes them; counts and last values per group and
    slice then carry the numbers from slice to slice. So no group ends in one task, and no size has to be known before.
    """
    if (df.count() if rows is None else rows) <= task_rows:
        return _plain_sequence(df, group, order, name, previous)
    return _sliced_sequence(df, group, order, name, previous)


def _plain_sequence(df, group, order, name, previous) -> DataFrame:
    window = Window.partitionBy(group).orderBy(*order)
    numbered = df.withColumn(name, F.row_number().over(window).cast("bigint"))
    if previous:
        numbered = numbered.withColumn(previous[1], F.lag(previous[0]).over(window))
    return numbered


def _sliced_sequence(df, group, order, name, previous) -> DataFrame:
    tagged = _slices(df, [F.col(group), *order])
    inside = Window.partitionBy(group, "_slice").orderBy("_row")
    local = tagged.withColumn("_local", F.row_number().over(inside))
    last = F.max_by(previous[0], "_row") if previous else F.lit(None).cast("string")
    # One row per group and slice; a large group has at most as many rows as there are slices.
    runs = tagged.groupBy(group, "_slice").agg(F.count("*").alias("_n"), last.alias("_last"))
    by_slice = Window.partitionBy(group).orderBy("_slice")
    # A slice continues at most one group of earlier slices: one row per slice at most.
    carried = (
        runs.withColumn("_start", F.sum("_n").over(by_slice.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_before", F.lag("_last").over(by_slice))
        .filter(F.col("_start").isNotNull())
        .select(F.col("_slice").alias("_s"), F.col(group).alias("_g"), "_start", "_before")
    )
    if previous:
        local = local.withColumn("_lag", F.lag(previous[0]).over(inside))
    joined = local.join(
        F.broadcast(carried),
        (F.col("_slice") == F.col("_s")) & F.col(group).eqNullSafe(F.col("_g")),
        "left",
    )
    added = [(F.col("_local") + F.coalesce("_start", F.lit(0))).alias(name)]
    if previous:
        added.append(F.when(F.col("_local") == 1, F.col("_before")).otherwise(F.col("_lag")).alias(previous[1]))
    return joined.select(*df.columns, *added)
