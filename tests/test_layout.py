"""A filter on one key of the fact leaves most of its files unread."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import sf_dir
from tillroll.plans.pipeline import index_fact
from tillroll.plans.registry import warehouse_for
from tillroll.sources.layout import BITS, CURVE, curve, file_statistics, read_where, touched, write_by_key
from tillroll.sources.sinks import fact_layout, write_table

N_FILES = 1024


def scan_metric(df, name):
    """A metric of the one scan of ``df``, after running it, and its rows."""
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().apply(0)
    return leaf.metrics().get(name).get().value(), rows


@pytest.fixture(scope="module")
def many(spark, tmp_path_factory):
    """A fact of 1,024 files in both layouts; a third of all rows are one customer's, and some keys are missing."""
    root = str(tmp_path_factory.mktemp("layout"))
    i = F.col("id")
    h = lambda seed, n: (F.pmod(F.xxhash64(i, F.lit(seed)), F.lit(n)) + 1).cast("int")
    day = F.date_add(F.lit("1998-01-01").cast("date"), h(1, 730) - 1)
    fact = spark.range(0, 40_000, 1, 4).select(
        i.alias("fact_key"), F.date_format(day, "yyyyMMdd").cast("int").alias("order_date_key"),
        F.when(i % 50 != 0, F.date_format(F.date_add(day, h(2, 9) - 1), "yyyyMMdd").cast("int")).alias("ship_date_key"),
        F.when(i % 3 == 0, 7).otherwise(h(3, 5000)).alias("customer_key"), h(4, 2000).alias("product_key"), h(5, 25).alias("location_key"),
        F.concat(F.lit("O-"), i).alias("order_id"))
    conf = {"spark.sql.shuffle.partitions": str(N_FILES), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        by_date = os.path.join(root, "date")
        write_table(fact_layout(fact), by_date, partition_by=["order_year"])
        with_year = fact.withColumn("order_year", F.expr("order_date_key div 10000").cast("int"))
        layouts = [file_statistics(spark, by_date, with_year.schema), write_by_key(with_year, os.path.join(root, "key"))]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return with_year.cache(), layouts


@pytest.mark.parametrize("where", [
    {"customer_key": [4321]}, {"product_key": [77]}, {"location_key": [13]}, {"customer_key": [7], "location_key": [25]},
    {"customer_key": (2010, 2040)}, {"customer_key": [2001, 2002, 2003]}])
def test_a_key_skips_most_files(spark, many, where):
    fact, layouts = many
    files, rows = scan_metric(read_where(spark, layouts, where), "numFiles")
    total = touched(spark, layouts[1], where)[2]
    assert N_FILES * 0.9 <= total <= N_FILES
    assert files <= 0.2 * total
    expected = fact.where(" AND ".join(
        f"{k} BETWEEN {v[0]} AND {v[1]}" if isinstance(v, tuple) else f"{k} IN ({', '.join(map(str, v))})" for k, v in where.items()))
    keys = lambda rows: sorted(r["order_id"] for r in rows)
    assert keys(rows) == keys(expected.collect()) and rows


def test_a_hot_member_and_missing_keys_are_whole(spark, many):
    fact, layouts = many
    assert read_where(spark, layouts, {"customer_key": [7]}).count() == fact.where("customer_key = 7").count() > 13_000
    assert read_where(spark, layouts, {"customer_key": []}).count() == 0
    assert read_where(spark, layouts, {"customer_key": [9_999_999]}).count() == 0
    assert read_where(spark, layouts, {}).count() == 40_000
    assert read_where(spark, layouts, {"ship_date_key": (0, 99999999)}).count() == fact.where("ship_date_key IS NOT NULL").count()
    with pytest.raises(ValueError):
        read_where(spark, layouts, {"sales": [1]})


def test_dates_skip_no_fewer_files_than_the_date_layout(spark, many):
    fact, layouts = many
    for where in ({"order_date_key": (19980301, 19980331)}, {"order_date_key": [19990704]}):
        alone, _ = scan_metric(read_where(spark, layouts[:1], where), "numFiles")
        both, rows = scan_metric(read_where(spark, layouts, where), "numFiles")
        total = touched(spark, layouts[0], where)[2]
        assert both <= alone <= 0.06 * total and rows


def test_bloom_filters_pass_over_row_groups(spark, many):
    """A product within a file's band that the file doesn't have: no row leaves the scan."""
    _, layouts = many
    files = spark.read.parquet(layouts[1].files).where("most_product_key - least_product_key > 20").orderBy("file").first()
    own = spark.read.parquet(files["file"])
    held = {r[0] for r in own.select("product_key").collect()}
    absent = next(k for k in range(files["least_product_key"], files["most_product_key"]) if k not in held)
    rows, _ = scan_metric(own.where(F.col("product_key") == absent), "numOutputRows")
    some, _ = scan_metric(own.where(F.col("product_key") == files["least_product_key"]), "numOutputRows")
    assert rows == 0 and some == len(own.collect())


def test_curve_interleaves_bits(spark):
    one = spark.range(1).select(*[F.lit(v).cast("long").alias(f"_rank_{k}") for k, v in zip(CURVE, (1 << (BITS - 1), 0, 0, 0))])
    bounds = {k: (0, 1) for k in CURVE}
    assert one.select(curve(bounds).alias("c")).first()["c"] == 1 << (BITS * 4 - 1)
    last = spark.range(1).select(*[F.lit(1 if k == "order_date_key" else 0).cast("long").alias(f"_rank_{k}") for k in CURVE])
    assert last.select(curve(bounds).alias("c")).first()["c"] == 1


def test_warehouse_layouts_hold_the_fact(spark):
    wh = warehouse_for(spark, sf_dir("0.001"))
    layouts = index_fact(spark, wh)
    assert index_fact(spark, wh) is layouts
    n = wh.gold.fact_sales.count()
    for layout in layouts:
        assert read_where(spark, [layout], {}).count() == n
    empty = wh.gold.fact_sales.limit(0)
    path = f"{wh.root}/gold/empty_by_key"
    assert read_where(spark, [write_by_key(empty, path)], {"customer_key": [1]}).count() == 0
