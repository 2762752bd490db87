from __future__ import annotations

from bazaarlens.operators import cleaning, rejects
from bazaarlens.schemas import as_text

from conftest import rows


def _raw(spark, table: str, values: list[tuple]):
    return spark.createDataFrame(values, as_text(table))


def _tables(spark):
    return {
        "customers": _raw(spark, "customers", [
            ("1", "Ann", "Pune", "2024-01-05", "vip"), ("7", " ann ", "PUNE", "05/01/2024", None),
            ("2", "Bob", None, "some day", ""), ("3", "Cy", "Goa", " ", "new"),
        ]),
        "restaurants": _raw(spark, "restaurants", [("10", "T", "north", "Pune", "2024-13-45", "4.5")]),
        "orders": _raw(spark, "orders", [
            ("1", "1", "10", "1", "2024-01-05 10:00:00", "delivered", "card", "5", "-3", "0"),
            ("2", "7", "10", "", "2024-01-06 10:00:00", "delivered", "card", "5", "30", ""),
            ("3", "2", "11", "", "2024-01-07 10:00:00", "cancelled", "card", "", "", ""),
            ("4", "9", "11", "", "2024-01-07 10:00:00", "cancelled", "card", "", "-1", ""),
        ]),
        "reviews": _raw(spark, "reviews", [("1", "1", "5", "x", "never"), ("2", "2", "5", "x", "never")]),
    }


def test_every_reject_has_its_reason(spark):
    found = rejects.sort_out(_tables(spark), lambda name, df: df)
    listed = sorted(tuple(r) for done in found.values() for r in done.rejects.collect())
    assert listed == [
        ("customers", "2", False, "signup_date", "some day", "unread date"),
        ("customers", "7", True, "customer_id", "7", "duplicate"),
        ("orders", "1", False, "delivery_time_minutes", "-3", "negative"),
        ("orders", "2", True, "customer_id", "7", "not in customers"),
        ("orders", "3", True, "restaurant_id", "11", "not in restaurants"),
        ("orders", "4", True, "restaurant_id", "11", "not in restaurants"),
        ("restaurants", "10", False, "active_since", "2024-13-45", "unread date"),
        ("reviews", "1", False, "review_date", "never", "unread date"),
        ("reviews", "2", True, "order_id", "2", "not in orders"),
    ]


def test_kept_rows_are_those_that_cleaning_keeps(spark, fixtures):
    found = rejects.sort_out(fixtures.raw, lambda name, df: df)
    clean = cleaning.clean_all(fixtures.raw)
    for name, key in (("customers", "customer_id"), ("orders", "order_id"), ("reviews", "review_id")):
        kept = found[name].kept.selectExpr(f"cast({key} as bigint) k")
        want = getattr(clean, name).selectExpr(f"{key} k")
        assert kept.exceptAll(want).isEmpty() and want.exceptAll(kept).isEmpty()


def test_kept_and_rejected_rows_are_all_rows(spark):
    tables = _tables(spark)
    tables["customers"] = tables["customers"].union(tables["customers"].limit(1))  # a row twice
    found = rejects.sort_out(tables, lambda name, df: df)
    for name, raw, kept, gone, _ in rows(rejects.balance(tables, found)):
        assert raw == kept + gone, name
    assert rows(rejects.balance({"reviews": tables["reviews"].limit(0)}, {"reviews": rejects.split("reviews", rejects.tagged("reviews", tables["reviews"].limit(0), {"orders": found["orders"].kept}))}))[0][1:] == (0, 0, 0, 0)
