"""Readers, tolerant import, profile and writers."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest

from tillroll.sources.profile import head, profile
from tillroll.sources.readers import SchemaMismatchError, read_landing, read_raw, read_tolerant
from tillroll.sources.sinks import create_schemas, write_table

HEADER = ("Row ID,Order ID,Order Date,Ship Date,Ship Mode,Customer ID,Customer Name,Segment,Country/Region,"
          "City,State,Postal Code,Region,Product ID,Category,Sub-Category,Product Name,Sales,Quantity,"
          "Discount,Profit")


def _write(tmp_root, name, lines):
    path = os.path.join(tmp_root, name)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def test_read_landing_renames_by_position_and_types(spark, tmp_root):
    path = _write(tmp_root, "orders.csv", [
        HEADER,
        "1,CA-1,2016-01-02,2016-01-05,null,C-1,Ann,Consumer,123,Burlington,Vermont,,East,P-1,Office,Paper,"
        "a  b,10.5,2,0.2,1.25",
    ])
    df = read_landing(spark, "orders", path)
    row = df.first()
    assert df.columns[1] == "order_id" and row.order_date == dt.date(2016, 1, 2)
    assert row.ship_mode == "null"          # the text 'null' stays text (G1)
    assert row.postal_code is None          # an empty cell becomes NULL
    assert row.sales == Decimal("10.5000") and row.discount == Decimal("0.2000") and row.quantity == 2


def test_wrong_width_fails(spark, tmp_root):
    path = _write(tmp_root, "people.csv", ["Person,Region,Extra", "Ann,West,1"])
    with pytest.raises(SchemaMismatchError):
        read_landing(spark, "people", path)


def test_bad_value_raises_in_strict_read(spark, tmp_root):
    path = _write(tmp_root, "orders_bad.csv", [HEADER, "x,CA-1,2016-01-02,2016-01-05,First Class,C-1,Ann,"
                                               "Consumer,US,A,B,1,East,P-1,O,P,n,1,1,0,0"])
    with pytest.raises(Exception):
        read_landing(spark, "orders", path).collect()


def test_tolerant_read_sets_bad_rows_aside(spark, tmp_root):
    path = _write(tmp_root, "returns.csv", ["Returned,Order ID", "Yes,CA-1", "Yessss,CA-2"])
    good, rejected = read_tolerant(spark, "returns_order", path)
    assert sorted(r.returned for r in good.collect()) == ["Yes", "Yessss"]  # whole by default
    cut, _ = read_tolerant(spark, "returns_order", path, truncate_overlong=True)
    assert sorted(r.returned for r in cut.collect()) == ["Yes", "Yes"]      # VARCHAR(3) cut, on request
    assert rejected.count() == 0
    opath = _write(tmp_root, "orders_tol.csv", [
        HEADER,
        "1,CA-1,2016-01-02,2016-01-05,First Class,C-1,Ann,Consumer,US,A,B,1,East,P-1,O,P,n,1,1,0,0",
        "x,CA-2,not-a-date,2016-01-05,First Class,C-1,Ann,Consumer,US,A,B,1,East,P-1,O,P,n,1,1,0,0",
    ])
    good, rejected = read_tolerant(spark, "orders", opath)
    assert good.count() == 1
    bad = rejected.first()
    assert bad.failed_columns == "row_id,order_date" and bad.order_id == "CA-2"


def test_read_raw_whole_sheet(spark, tmp_root):
    path = _write(tmp_root, "people2.csv", ["Person,Region", "Ann,West", "Bob,East"])
    assert read_raw(spark, path).count() == 2


def test_profile_and_head(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "x int, y string")
    prof = {r.column_name: r for r in profile(df).collect()}
    assert prof["x"].n_nulls == 1 and prof["x"].min_value == "1" and prof["x"].max_value == "3"
    assert prof["y"].data_type == "string" and prof["x"].n_rows == 3
    assert head(df, 2).count() == 2


def test_write_table_observes_rows(spark, tmp_root):
    df = spark.range(42)
    metrics = write_table(df, os.path.join(tmp_root, "t"))
    assert metrics["rows"] == 42
    assert spark.read.parquet(os.path.join(tmp_root, "t")).count() == 42


def test_create_schemas(spark):
    create_schemas(spark, names=("tillroll_test_bronze",))
    assert "tillroll_test_bronze" in [d.name for d in spark.catalog.listDatabases()]


def test_empty_table_has_declared_schema(spark):
    from tillroll.schemas import BRONZE_ORDERS
    from tillroll.sources.sinks import empty_table
    df = empty_table(spark, BRONZE_ORDERS)
    assert df.count() == 0 and df.schema == BRONZE_ORDERS


def test_json_is_matched_by_name_and_parquet_nan_becomes_null(spark, tmp_root):
    path = _write(tmp_root, "returns.json", ['{"order_id": "CA-9", "returned": "Yes"}'])
    row = read_landing(spark, "returns_order", path, fmt="json").first()
    assert (row.returned, row.order_id) == ("Yes", "CA-9")
    people = spark.createDataFrame([("Ann", "West")], "Person string, Region string")
    ppath = os.path.join(tmp_root, "people.parquet")
    people.write.parquet(ppath)
    assert read_landing(spark, "people", ppath, fmt="parquet").first().person_name == "Ann"
    from tillroll.sources.readers import nan_to_null
    nan = spark.createDataFrame([(float("nan"),), (1.5,)], "x double")
    assert [r.x for r in nan_to_null(nan).collect()] == [None, 1.5]


def test_tolerant_json(spark, tmp_root):
    path = _write(tmp_root, "people.json", ['{"region": "West", "person_name": "Ann"}'])
    good, rejected = read_tolerant(spark, "people", path, fmt="json")
    assert good.first().person_name == "Ann" and rejected.count() == 0


def test_create_schemas_reset_drops_contents(spark):
    create_schemas(spark, names=("tillroll_test_reset",))
    spark.sql("CREATE OR REPLACE VIEW tillroll_test_reset.v AS SELECT 1 AS a")
    assert spark.catalog.tableExists("tillroll_test_reset.v")
    create_schemas(spark, names=("tillroll_test_reset",), reset=True)
    assert not spark.catalog.tableExists("tillroll_test_reset.v")
    assert spark.catalog.databaseExists("tillroll_test_reset")


ORDER = "1,CA-1,{d},2016-01-05,First Class,C-1,Ann,Consumer,US,A,B,1,East,P-1,O,P,{n},10.5,2,0.2,1.25"


def test_quoted_cells_are_read_whole(spark, tmp_root):
    path = _write(tmp_root, "quoted.csv", [HEADER, ORDER.format(d="2016-01-02", n='"Acme 8"" Scissors, Blue"'),
                                           ORDER.format(d="2016-01-02", n='"two\nlines, and ""more"""')])
    names = sorted(r.product_name for r in read_landing(spark, "orders", path, multiline=True).collect())
    assert names == ['Acme 8" Scissors, Blue', 'two\nlines, and "more"']
    good, rejected = read_tolerant(spark, "orders", path, multiline=True)
    assert good.count() == 2 and rejected.count() == 0


def test_rows_of_the_wrong_width_are_not_lost(spark, tmp_root):
    path = _write(tmp_root, "ragged.csv", ["Person,Region", "Ann,West", "Cid,East,Extra", "Bob"])
    with pytest.raises(Exception):
        read_landing(spark, "people", path).collect()
    good, rejected = read_tolerant(spark, "people", path)
    assert [tuple(r) for r in good.collect()] == [("Ann", "West")]
    assert sorted((r.failed_columns, r.raw_line) for r in rejected.collect()) == [
        ("_corrupt_record", "Bob"), ("_corrupt_record", "Cid,East,Extra")]


def test_json_names_must_be_the_declared_ones(spark, tmp_root):
    path = _write(tmp_root, "wrong.json", ['{"Person": "Ann", "Region": "West"}'])
    for read in (read_landing, read_tolerant):
        with pytest.raises(SchemaMismatchError):
            read(spark, "people", path, fmt="json")


def test_date_format(spark, tmp_root):
    path = _write(tmp_root, "us.csv", [HEADER, ORDER.format(d="11/8/2016", n="x").replace("2016-01-05", "11/11/2016")])
    row = read_landing(spark, "orders", path, date_format="M/d/yyyy").first()
    assert (row.order_date, row.ship_date) == (dt.date(2016, 11, 8), dt.date(2016, 11, 11))
    good, rejected = read_tolerant(spark, "orders", path)
    assert good.count() == 0 and rejected.first().failed_columns == "order_date,ship_date"
    assert read_tolerant(spark, "orders", path, date_format="M/d/yyyy")[0].count() == 1
