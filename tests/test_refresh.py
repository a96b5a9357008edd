"""A refreshed dimension equals a full rebuild and writes only what changed."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tests.conftest import sf_dir
from tillroll.operators.keys import dense_key
from tillroll.plans import refresh as R
from tillroll.plans.registry import warehouse_for

COLUMNS = ["a", "b"]


def rebuilt(df, columns, key):
    return sorted(map(str, dense_key(df.select(*columns).distinct(), columns, key).collect()))


def same(found, df, columns=COLUMNS, key="k"):
    assert sorted(map(str, found.rows.collect())) == rebuilt(df, columns, key)


def folders(path, version):
    top = f"{path}/members/{version}"
    return sorted(int(d[len("range="):]) for d in os.listdir(top) if d.startswith("range=")) if os.path.isdir(top) else []


def members(spark, n=4000):
    return spark.range(n).select(F.when(F.col("id") % 100 != 0, F.format_string("m%05d", F.col("id") * 7 % n)).alias("a"), (F.col("id") % 3).cast("int").alias("b"))


def test_changes_rewrite_their_ranges_only(spark, tmp_root):
    path = os.path.join(tmp_root, "dim")
    first = members(spark)
    start = R.refresh(first, COLUMNS, "k", path, ranges=32)
    assert start.written == sorted(start.written) and len(start.written) == start.ranges and 30 <= start.ranges <= 32
    same(start, first)
    again = R.refresh(first, COLUMNS, "k", path)
    assert again.written == [] and folders(path, again.version) == []
    same(again, first)
    # One hundredth changes: in a few names' second column, a new member at the very front, some gone.
    changed = first.where("a IS NULL OR a NOT LIKE 'm0123%'").withColumn("b", F.when(F.col("a").startswith("m020"), F.lit(9)).otherwise(F.col("b")))
    changed = changed.unionByName(spark.createDataFrame([("", 0), ("zz", None), (None, None)], changed.schema))
    found = R.refresh(changed, COLUMNS, "k", path)
    assert 0 < len(found.written) <= 6 and folders(path, found.version) == found.written
    same(found, changed)
    assert sorted(map(str, R.read(spark, first.schema, "k", path, version=start.version).collect())) == rebuilt(first, COLUMNS, "k")


def test_a_value_that_moves_between_columns_is_a_change(spark, tmp_root):
    path = os.path.join(tmp_root, "dim")
    one = spark.createDataFrame([("x", None), ("y", "y")], "a string, b string")
    two = spark.createDataFrame([(None, "x"), ("y", "y")], "a string, b string")
    R.refresh(one, COLUMNS, "k", path, ranges=1)
    found = R.refresh(two, COLUMNS, "k", path)
    assert found.written and sorted(map(str, found.rows.collect())) == rebuilt(two, COLUMNS, "k")


def test_empty_and_emptied(spark, tmp_root):
    path = os.path.join(tmp_root, "dim")
    none = members(spark).limit(0)
    assert R.refresh(none, COLUMNS, "k", path).rows.count() == 0
    same(R.refresh(members(spark, 50), COLUMNS, "k", path), members(spark, 50))
    emptied = R.refresh(none, COLUMNS, "k", path)
    assert emptied.rows.count() == 0 and emptied.written == []


def test_a_refresh_that_dies_changes_nothing(spark, tmp_root):
    path = os.path.join(tmp_root, "dim")
    first = members(spark, 300)
    R.refresh(first, COLUMNS, "k", path, ranges=4)
    more = members(spark, 310)
    placed = more.withColumn("range", F.lit(0)).withColumn("_place", F.lit(1))
    placed.write.partitionBy("range").parquet(f"{path}/members/1")  # members of a version without a state
    assert R.read(spark, first.schema, "k", path).count() == first.distinct().count()
    same(R.refresh(more, COLUMNS, "k", path), more)


def test_the_warehouse_dimension(spark, tmp_root):
    wh = warehouse_for(spark, sf_dir("0.001"))
    columns = ["customer_id", "customer_name", "segment"]
    orders = wh.silver["orders"].select(*columns)
    R.refresh(orders.where("customer_id NOT LIKE 'C-1%'"), columns, "customer_key", tmp_root, ranges=8)
    found = R.refresh(orders, columns, "customer_key", tmp_root)
    assert len(found.written) < found.ranges
    assert sorted(map(str, found.rows.collect())) == sorted(map(str, wh.gold.dim_customer.collect()))
