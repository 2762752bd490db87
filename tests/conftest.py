from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bazaarlens.schemas import TABLES  # noqa: E402
from bazaarlens.session import local_session  # noqa: E402
from bazaarlens.sources.fixtures import open_fixtures  # noqa: E402
from bazaarlens.sources.marketplace import Marketplace  # noqa: E402

TESTDATA = os.environ.get("BAZAARLENS_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def fixtures(spark):
    return open_fixtures(spark, TESTDATA)


def order(key, customer, restaurant, when, amount, status="delivered", rider=1, minutes=30, method="card", discount=0):
    return (
        key,
        customer,
        restaurant,
        rider,
        dt.datetime.fromisoformat(when),
        status,
        method,
        None if amount is None else Decimal(str(amount)),
        minutes,
        Decimal(str(discount)),
    )


@pytest.fixture(scope="session")
def make(spark):
    """Typed table from plain rows."""

    def build(table: str, rows: list[tuple]):
        return spark.createDataFrame(rows, TABLES[table])

    return build


@pytest.fixture(scope="session")
def market(make) -> Marketplace:
    """A few hand-made rows: a month gap, a missing city, orphans of every optional kind."""
    day = dt.date(2024, 1, 1)
    return Marketplace(
        customers=make("customers", [(1, "Ann", "Pune", day, "vip"), (2, "Bob", None, day, None), (3, "Cy", "Goa", day, "new")]),
        restaurants=make(
            "restaurants",
            [
                (10, "Tandoor", "north", "Pune", day, Decimal("4.50")),
                (11, "Dosa", "south", None, day, None),
                (12, "Thali", "north", "Pune", day, Decimal("3.00")),
            ],
        ),
        menu_items=make(
            "menu_items",
            [(100, 10, "naan", "Breads", Decimal("2.00")), (101, 11, "dosa", "Mains", Decimal("5.00"))],
        ),
        riders=make("riders", [(1, "Ria", "Pune", day, "bike"), (2, "Raj", None, day, "car")]),
        orders=make(
            "orders",
            [
                order(1, 1, 10, "2024-01-05T10:00:00", "100.00"),
                order(2, 1, 11, "2024-01-20T11:00:00", "50.00", minutes=45),
                order(3, 2, 10, "2024-03-02T23:30:00", "25.25", rider=2, minutes=46, discount=5),
                order(4, 1, 10, "2024-03-03T09:00:00", "10.00", minutes=None),
                order(5, 2, 11, "2024-03-04T09:00:00", "7.00", status="cancelled", rider=None, minutes=None),
                order(6, 2, 10, "2024-03-05T09:00:00", "9.00", status="refunded", minutes=20),
                order(7, 2, 12, "2024-03-06T09:00:00", None, minutes=0),
            ],
        ),
        order_items=make(
            "order_items",
            [
                (1, 1, 100, 2, Decimal("2.00")),
                (2, 1, 101, 1, Decimal("5.00")),
                (3, 3, 100, 1, Decimal("2.00")),
                (4, 5, 101, 9, Decimal("5.00")),
            ],
        ),
        reviews=make(
            "reviews",
            [
                (1, 1, 5, "good", dt.date(2024, 1, 6)),
                (2, 2, None, "", dt.date(2024, 1, 21)),
                (3, 6, 1, "late", dt.date(2024, 3, 6)),
            ],
        ),
    )


def rows(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]
