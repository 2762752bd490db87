from __future__ import annotations

import pytest
from pyspark.sql import Window, functions as F

from bazaarlens.operators.ranking import (
    global_ntile,
    global_row_number,
    ntile_by_bounds,
    ntiles_by_bounds,
    rank_by_value,
    sequence_in_group,
    top_per_group,
)

from conftest import rows


def same(left, right) -> bool:
    return sorted(rows(left), key=repr) == sorted(rows(right), key=repr)


@pytest.fixture(scope="module")
def scores(spark):
    """A third of all rows share one value, some have none."""
    value = "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id * 37 % 90 END"
    return spark.range(0, 700, 1, 5).selectExpr("id", f"{value} AS v")


@pytest.mark.parametrize("task_rows", [0, 10_000])
@pytest.mark.parametrize("buckets", [1, 4, 5, 699, 1000])
def test_ntile_equals_window(scores, buckets, task_rows):
    order = [F.desc_nulls_first("v"), F.asc("id")]
    expected = scores.withColumn("b", F.ntile(buckets).over(Window.orderBy(*order)))
    assert same(global_ntile(scores, buckets, order, "b", task_rows=task_rows), expected)


@pytest.mark.parametrize("task_rows", [0, 10_000])
def test_row_number_equals_window(scores, task_rows):
    order = [F.asc_nulls_last("v"), F.desc("id")]
    expected = scores.withColumn("n", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    assert same(global_row_number(scores, order, "n", task_rows=task_rows), expected)


def test_row_number_over_many_slices(spark, scores):
    """Values in every slice, and ties that straddle slices."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        order = [F.asc("v"), F.asc("id")]
        found = global_row_number(scores, order, "n", task_rows=0)
        expected = scores.withColumn("n", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
        assert same(found, expected)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("task_rows", [0, 10_000])
def test_rank_and_percent_rank_equal_window(scores, task_rows):
    window = Window.orderBy(F.asc_nulls_last("v"))
    expected = scores.withColumn("r", F.rank().over(window).cast("bigint")).withColumn(
        "p", F.percent_rank().over(window)
    )
    assert same(rank_by_value(scores, "v", "r", "p", task_rows=task_rows), expected)
    assert same(rank_by_value(scores, "v", "r", "p", scores.count(), task_rows), expected)


def test_rank_of_one_row_and_of_none(spark):
    single = spark.createDataFrame([(3,)], "v int")
    assert rows(rank_by_value(single, "v", "r", "p", task_rows=0)) == [(3, 1, 0.0)]
    assert rows(rank_by_value(single.limit(0), "v", "r", "p", task_rows=0)) == []
    assert rows(global_ntile(single.limit(0), 5, [F.asc("v")], "b", task_rows=0)) == []


@pytest.mark.parametrize("coalesce", ["true", "false"])
@pytest.mark.parametrize("task_rows", [0, 20, 10_000])
def test_sequence_with_hot_group(spark, task_rows, coalesce):
    """One group holds a third of the rows, one has a NULL key."""
    group = "CASE WHEN id % 3 = 0 THEN 0 WHEN id % 29 = 1 THEN NULL ELSE id % 40 END"
    df = spark.range(0, 900, 1, 6).selectExpr("id", f"{group} AS g", "id * 7 % 30 AS t")
    order = [F.asc("t"), F.asc("id")]
    window = Window.partitionBy("g").orderBy(*order)
    expected = df.withColumn("n", F.row_number().over(window).cast("bigint")).withColumn("p", F.lag("t").over(window))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        assert same(sequence_in_group(df, "g", order, "n", ("t", "p"), task_rows=task_rows), expected)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_top_per_group_keeps_ties_only_when_asked(spark):
    df = spark.createDataFrame([("a", 5, 1), ("a", 5, 2), ("a", 4, 3), ("a", 3, 4), ("b", 1, 5)], "g string, v int, id int")
    by_value = top_per_group(df, ["g"], [F.desc("v")], 2, "k", ties=True)
    assert sorted(rows(by_value)) == [("a", 4, 3, 2), ("a", 5, 1, 1), ("a", 5, 2, 1), ("b", 1, 5, 1)]
    by_row = top_per_group(df, ["g"], [F.desc("v"), F.asc("id")], 2, "k")
    assert sorted(rows(by_row)) == [("a", 5, 1, 1), ("a", 5, 2, 2), ("b", 1, 5, 1)]


def test_rank_limit_reaches_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id", "id % 2 AS g")
    plan = top_per_group(df, ["g"], [F.desc("id")], 3, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("rows", [3, 4, 5, 37])
@pytest.mark.parametrize("descending", [False, True])
def test_ntile_by_bounds_at_the_limit(spark, rows, descending):
    data = [(k, None if k % 7 == 3 else k * 5 % 11) for k in range(rows)]
    df = spark.createDataFrame(data, "id int, v int")
    plain = ntile_by_bounds(df, 5, "v", "id", "q", rows, descending, task_rows=rows)
    for limit in (rows - 1, 1):
        sliced = ntile_by_bounds(df, 5, "v", "id", "q", rows, descending, task_rows=limit)
        assert sorted(sliced.collect(), key=repr) == sorted(plain.collect(), key=repr)


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("buckets", [1, 5, 12])
def test_selected_bounds_of_many_kinds(spark, buckets, descending):
    """Wide ranges, negative numbers, one value for a third of the rows, nulls for many or all."""
    df = spark.range(0, 600, 1, 5).selectExpr(
        "id * 7919 % 600 AS id",
        "CASE WHEN id % 3 = 0 THEN 5 ELSE id * 104729 * 1000003 - 20000000000 END AS wide",
        "CASE WHEN id % 4 <> 0 THEN cast(id % 7 AS int) - 3 END AS few",
        "cast(NULL AS bigint) AS none",
        "cast(1 AS bigint) AS same",
    )
    axes = [(c, f"{c}_q", descending) for c in ("wide", "few", "none", "same")]
    plain = ntiles_by_bounds(df, buckets, axes, "id", 600, task_rows=600)
    found = ntiles_by_bounds(df, buckets, axes, "id", 600, task_rows=0)
    assert same(found, plain)
    assert "Exchange rangepartitioning" not in found._jdf.queryExecution().executedPlan().toString()
