from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.schemas import BRONZE_ORDERS, BRONZE_PEOPLE, BRONZE_RETURNS  # noqa: E402
from tillroll.session import get_session  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "local[4]", app_name="tillroll-tests", shuffle_partitions=4,
        conf={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tillroll-test-ckpt-"))
    yield session


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="tillroll-test-")


def sf_dir(sf: str) -> str:
    return f"{TESTDATA}/sf{sf}"


def order_row(row_id, order_id="O-1", order_date=dt.date(1998, 1, 10), ship_date=dt.date(1998, 1, 14),
              ship_mode="First Class", customer_id="C-1", customer_name="Ann", segment="RETAIL",
              country_region="United States", city="NATION_1", state="AMERICA", postal_code="00001",
              region="AMERICA", product_id="P-1", category="Brand#1", sub_category="SMALL",
              product_name="blue bolt", sales="10.0000", quantity=2, discount="0.1000", profit="1.0000"):
    dec = lambda v: None if v is None else Decimal(v)
    return (row_id, order_id, order_date, ship_date, ship_mode, customer_id, customer_name, segment,
            country_region, city, state, postal_code, region, product_id, category, sub_category,
            product_name, dec(sales), quantity, dec(discount), dec(profit))


def bronze_frames(spark, orders, people=None, returns=None):
    people = people if people is not None else [("Rep AMERICA", "AMERICA")]
    returns = returns if returns is not None else []
    return {
        "orders": spark.createDataFrame(orders, BRONZE_ORDERS),
        "people": spark.createDataFrame(people, BRONZE_PEOPLE),
        "returns_order": spark.createDataFrame(returns, BRONZE_RETURNS),
    }
