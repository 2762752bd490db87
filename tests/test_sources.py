from __future__ import annotations

import glob
from decimal import Decimal as D

import pyarrow.parquet as pq
import pytest

from bazaarlens.operators import star
from bazaarlens.operators.metrics import Dimension, metric
from bazaarlens.plans import revenue
from bazaarlens.schemas import TABLES, as_text
from bazaarlens.session import shared_dir
from bazaarlens.sources import sinks, staging
from bazaarlens.operators import cleaning
from bazaarlens.sources.marketplace import create_star_views, create_views, read_marketplace

from conftest import rows


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_csv_keeps_text_as_it_is(spark, tmp_path):
    values = [("1", " Ann, \"A\" ", "pune ", "05/01/2024", None), ("x", "Bob", None, "never", "vip")]
    raw = spark.createDataFrame(values, as_text("customers"))
    staging.write_text(raw, str(tmp_path / "customers.csv"))
    again = staging.read_text(spark, str(tmp_path / "customers.csv"), as_text("customers"))
    assert sorted(rows(again)) == sorted(values)
    assert {kind for _, kind in again.dtypes} == {"string"}


def csv(tmp_path, text: str) -> str:
    path = tmp_path / "t.csv"
    path.write_text(text)
    return str(path)


PAIR = "a string, b string"


def test_csv_values_keep_line_breaks_and_quotes(spark, tmp_path):
    path = csv(tmp_path, 'a,b\n1,"nice\nfood"\n2,"say ""hi"", please"\n')
    found = staging.read_text(spark, path, spark.createDataFrame([], PAIR).schema)
    assert sorted(rows(found)) == [("1", "nice\nfood"), ("2", 'say "hi", please')]


@pytest.mark.parametrize("row", ["1,2,3", "1"])
def test_csv_rows_of_wrong_width_fail_or_are_set_aside(spark, tmp_path, row):
    path, schema = csv(tmp_path, f"a,b\nx,y\n{row}\n"), spark.createDataFrame([], PAIR).schema
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        staging.read_text(spark, path, schema).select("a").collect()
    found = staging.read_text(spark, path, schema, rejects="bad")
    assert rows(found.filter("bad is null").select("a", "b")) == [("x", "y")]
    assert [r["bad"] for r in found.filter("bad is not null").collect()] == [row]


def test_csv_header_in_another_order_fails(spark, tmp_path):
    path = csv(tmp_path, "b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        staging.read_text(spark, path, spark.createDataFrame([], PAIR).schema).collect()


def test_stage_reads_every_table(spark, tmp_path, market):
    for name, df in market.items():
        staging.write_text(staging.to_text(df), str(tmp_path / f"{name}.csv"))
    staged = staging.stage(spark, str(tmp_path))
    assert {n: df.count() for n, df in staged.items()} == {n: df.count() for n, df in market.items()}


def test_refresh_replaces_and_reads_back(spark, tmp_path, market):
    for _ in range(2):
        sinks.refresh(market, str(tmp_path))
    again = read_marketplace(spark, str(tmp_path))
    for name, df in market.items():
        assert sorted(rows(getattr(again, name)), key=repr) == sorted(rows(df), key=repr)
        assert getattr(again, name).schema == TABLES[name]
    create_views(again, "mart_")
    assert spark.sql("SELECT count(*) FROM mart_orders").first()[0] == 7


def test_refresh_onto_its_own_source_keeps_every_row(spark, tmp_path, market):
    sinks.refresh(market, str(tmp_path))
    again = read_marketplace(spark, str(tmp_path))
    counts = {name: df.count() for name, df in again.items()}
    sinks.refresh(again, str(tmp_path))
    assert {name: df.count() for name, df in read_marketplace(spark, str(tmp_path)).items()} == counts
    assert not glob.glob(f"{tmp_path}/.new-*")


def test_refresh_from_text_equals_cleaning(spark, tmp_path, fixtures):
    sinks.refresh_from_text(fixtures.raw, str(tmp_path))
    loaded = read_marketplace(spark, str(tmp_path))
    for name, df in cleaning.clean_all(fixtures.raw).items():
        found = getattr(loaded, name).select(df.columns)
        assert df.exceptAll(found).isEmpty() and df.count() == found.count()


def test_star_views_have_names(spark, market):
    names = create_star_views(star.star_schema(market), "v_")
    assert len(names) == 8 and spark.sql("SELECT count(*) FROM v_fact_orders").first()[0] == 7


def test_marts_are_split_by_month(spark, tmp_path, market):
    sinks.write_marts(star.star_schema(market), str(tmp_path))
    months = sorted(p.rsplit("=", 1)[1] for p in glob.glob(f"{tmp_path}/fact_orders/month=*"))
    assert months == ["2024-01-01", "2024-03-01"]
    facts = spark.read.parquet(f"{tmp_path}/fact_orders")
    january = facts.filter("month = DATE '2024-01-01'")
    assert january.count() == 2 and "PartitionFilters: [isnotnull(month" in plan(january)


def test_slicers_prune_months_of_a_mart(spark, tmp_path, market):
    star_tables = star.star_schema(market)
    sinks.write_marts(star_tables, str(tmp_path))
    facts = spark.read.parquet(f"{tmp_path}/fact_orders")
    dims = {"year_month": Dimension(spark.read.parquet(f"{tmp_path}/dim_date"), "date_key")}
    sliced = metric(facts, ["total_revenue"], by=[], dims=dims, slicers={"year_month": ["2024-01"]})
    assert rows(sliced) == [(D("150.00"),)]
    scan = next(line for line in plan(sliced).splitlines() if "FileScan" in line and "total_amount" in line)
    assert "month" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(date_key,2024-01-05)" in scan


def test_lookup_layout_skips_files(spark, tmp_path, fixtures):
    path = str(tmp_path / "orders")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_lookup_layout(fixtures.orders, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hits = total = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        column = meta.schema.names.index("restaurant_id")
        for group in range(meta.num_row_groups):
            stats = meta.row_group(group).column(column).statistics
            hits += stats.min <= 3 <= stats.max
            total += 1
    assert total >= 4 and hits <= 2
    found = sinks.lookup(spark.read.parquet(path), "restaurant_id", 3)
    assert "EqualTo(restaurant_id,3)" in plan(found) and "EqualTo(status,delivered)" in plan(found)
    assert sorted(rows(found)) == sorted(rows(sinks.lookup(fixtures.orders, "restaurant_id", 3)))


def test_bucketed_tables_join_without_shuffle(spark, tmp_path, fixtures):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name, df in (("bucketed_orders", fixtures.orders), ("bucketed_items", fixtures.order_items)):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        sinks.save_bucketed(df, name, "order_id", 4)
    try:
        lines = revenue.delivered_lines(spark.table("bucketed_items"), spark.table("bucketed_orders"))
        assert "Exchange" not in plan(lines)
        direct = revenue.delivered_lines(fixtures.order_items, fixtures.orders)
        assert lines.count() == direct.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("bucketed_orders", "bucketed_items"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


class _Context:
    master = "spark://host:7077"

    def getCheckpointDir(self):
        return None


class _Session:
    """Stand-in for a session on a cluster."""

    sparkContext = _Context()

    def __init__(self, **settings: str):
        self.conf = settings


def test_shared_folder_comes_from_the_session():
    assert shared_dir(_Session(**{"spark.checkpoint.dir": "hdfs://cluster/shared"})) == "hdfs://cluster/shared"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session())


def test_scan_reads_only_needed_columns(spark, tmp_path, market):
    sinks.refresh(market, str(tmp_path))
    orders = read_marketplace(spark, str(tmp_path)).orders
    text = plan(revenue.last_order(orders))
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,delivered)]" in text
    assert "ReadSchema: struct<customer_id:bigint,order_timestamp:timestamp_ntz,status:string>" in text


def test_a_large_file_without_line_breaks_is_read_by_many_tasks(spark, tmp_path):
    """Quotes and commas inside values are no line breaks; a file that has one is read whole, with the same rows."""
    (tmp_path / "t").mkdir()
    lines = [f'{k},"say ""hi"", {k}"' if k % 3 else f"{k}," for k in range(20_000)]
    (tmp_path / "t" / "one part.csv").write_text("a,b\n" + "\n".join(lines) + "\n")
    schema = spark.createDataFrame([], PAIR).schema
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = staging.read_text(spark, str(tmp_path / "t"), schema)
        assert found.rdd.getNumPartitions() > 4
        whole = staging.read_text(spark, str(tmp_path / "t"), schema, multiline=True)
        assert sorted(rows(found), key=str) == sorted(rows(whole), key=str)
        (tmp_path / "t" / "two.csv").write_text('a,b\nx"y,"open\nstill, ""it"""\n')
        closed, wide = staging.files_with_open_lines(spark, str(tmp_path / "t"))
        assert [len(closed), len(wide)] == [1, 1]
        both = staging.read_text(spark, str(tmp_path / "t"), schema)
        whole = staging.read_text(spark, str(tmp_path / "t"), schema, multiline=True)
        assert sorted(rows(both), key=str) == sorted(rows(whole), key=str)
        assert ('x"y', 'open\nstill, "it"') in rows(both)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_lookup_of_a_further_key_skips_row_groups(spark, tmp_path, fixtures):
    """Clustered by restaurant; the customer's Bloom filter leaves out the row groups without it."""
    orders = fixtures.orders.unionAll(fixtures.orders.selectExpr("order_id + 10000000 AS order_id", "customer_id + 10000000 AS customer_id", *fixtures.orders.columns[2:]))
    plain, filtered = str(tmp_path / "plain"), str(tmp_path / "filtered")
    sinks.write_lookup_layout(orders, plain, group_bytes=4096)
    sinks.write_lookup_layout(orders, filtered, also={"customer_id": 500}, group_bytes=4096)
    one = orders.groupBy("customer_id").count().orderBy("count", "customer_id").first()["customer_id"]

    def read(path):
        df = sinks.lookup(spark.read.parquet(path), "customer_id", one)
        found = sorted(rows(df))
        nodes, scanned = [df._jdf.queryExecution().executedPlan()], 0
        while nodes:
            node = nodes.pop()
            if node.nodeName().startswith("Scan parquet"):
                scanned += node.metrics().apply("numOutputRows").value()
            children = node.children()
            nodes += [children.apply(k) for k in range(children.size())]
        return found, scanned

    (want, all_rows), (found, some) = read(plain), read(filtered)
    assert found == want and some < all_rows


def test_bucketed_facts_join_without_a_shuffle(spark, fixtures):
    import __spark_entry__ as contract

    df = contract._bucketed_lines(fixtures)
    text = plan(df)
    assert "Exchange" not in text and "SortMergeJoin" in text
    assert df.count() == star.fact_order_items(fixtures.order_items, fixtures.orders).count()
