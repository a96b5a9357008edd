"""What a build holds on disk at once: findings of round 4."""

from __future__ import annotations

import dataclasses
import datetime as dt
import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import bronze_frames, order_row, sf_dir
from tillroll.operators.dedup import suspected
from tillroll.plans import lattice as L
from tillroll.plans import registry
from tillroll.plans.gold import date_slices
from tillroll.plans.measures import measures
from tillroll.plans.pipeline import KEY_BITS, run_pipeline
from tillroll.plans.registry import warehouse_for
from tillroll.session import FILE_CLEANUP, shuffles_dropped
from tillroll.sources import sinks
from tillroll.sources.layout import write_by_key
from tillroll.sources.readers import split_tagged, to_be_split, tolerant_tagged
from tillroll.sources.sinks import passes_for, shares, write_passes, write_table


@pytest.fixture(scope="module")
def gold(spark):
    return warehouse_for(spark, sf_dir("0.001")).gold


def rows(df):
    return sorted(map(str, df.collect()))


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in folders for f in glob.glob(os.path.join(d.getPath(), "*", "shuffle_*.data"))}


def left_behind(spark, run):
    """The shuffle files that ``run`` made and that stay; they go in the background."""
    before = shuffle_files(spark)
    run()
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


def test_shuffle_files_go_with_the_write(spark, gold, tmp_path):
    """F1-F8: no file of the shuffles of a write, of the digests or of the index outlives it; a DataFrame run twice is whole."""
    df = spark.range(3000).repartition(4, "id").withColumn("k", F.col("id") % 7).groupBy("k").agg(F.sum("id").alias("s"))
    assert left_behind(spark, lambda: write_table(df, str(tmp_path / "a"))) == set()
    assert left_behind(spark, lambda: suspected(df, ["k"])) == set()
    assert left_behind(spark, lambda: write_by_key(gold.fact_sales, str(tmp_path / "by_key"), 1000)) == set()
    with shuffles_dropped(spark):
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, df.collect())) == sorted(map(tuple, spark.read.parquet(str(tmp_path / "a")).collect()))


def test_the_setting_is_put_back(spark):
    before = spark.conf.get(FILE_CLEANUP, None)
    with pytest.raises(ValueError):
        with shuffles_dropped(spark), shuffles_dropped(spark):
            assert spark.conf.get(FILE_CLEANUP) == "true"
            raise ValueError
    assert spark.conf.get(FILE_CLEANUP, None) == before
    spark.conf.set(FILE_CLEANUP, "false")
    with shuffles_dropped(spark):
        assert spark.conf.get(FILE_CLEANUP) == "true"
    assert spark.conf.get(FILE_CLEANUP) == "false"
    spark.conf.unset(FILE_CLEANUP)


def test_parts_are_the_whole(spark, tmp_path):
    df = spark.range(500).selectExpr("CASE WHEN id % 5 > 0 THEN id % 40 END AS k", "id")
    parts = shares(df, ["k"], 3)
    assert sum(p.count() for p in parts) == 500 and sum(p.select("k").distinct().count() for p in parts) == df.select("k").distinct().count()
    found = write_passes(parts, str(tmp_path / "p"), extra_metrics=[F.count_if(F.col("k").isNull()).alias("n")])
    assert found == {"rows": 500, "n": 100} and rows(spark.read.parquet(str(tmp_path / "p"))) == rows(df)
    assert [passes_for(n) for n in (None, 0, sinks.ROWS_PER_PASS, sinks.ROWS_PER_PASS + 1, 10 ** 12)] == [1, 1, 1, 2, sinks.MOST_PASSES]


def test_slices_of_dates(spark):
    day = lambda i: None if i % 10 == 0 else dt.date(1998, 1, 1) + dt.timedelta(days=i % 50)
    lines = bronze_frames(spark, [order_row(i, order_date=day(i)) for i in range(200)])["orders"]
    slices = date_slices(lines, 3)
    assert len(slices) == 3 and rows(slices[0].unionByName(slices[1]).unionByName(slices[2])) == rows(lines)
    assert all(s.count() > 40 for s in slices) and slices[0].where("order_date IS NULL").count() == 20
    assert date_slices(lines, 1) == [lines] and [s.count() for s in date_slices(lines.limit(0), 3)] == [0]
    hot = bronze_frames(spark, [order_row(i) for i in range(9)])["orders"]
    assert sum(s.count() for s in date_slices(hot, 4)) == 9


def test_the_fact_is_written_in_passes(spark, tmp_root, monkeypatch):
    """Stretches of dates are joined and laid out one after the other, for the same rows, each with a key of its own."""
    lines = [order_row(i, order_id=f"O-{i % 30}", order_date=dt.date(1997 + i % 3, 1 + i % 12, 5), customer_id=f"C-{i % 4}",
                       postal_code=None if i % 9 == 0 else "00001") for i in range(60)] + [order_row(99, order_date=None), order_row(None, order_id=None)]
    bronze = bronze_frames(spark, lines, returns=[("Yes", "O-3")])

    def run(name):
        return run_pipeline(spark, bronze, root=f"{tmp_root}/{name}", on_unmatched="quarantine", register_views=False, date_range="data")
    whole = run("whole")
    monkeypatch.setattr(sinks, "ROWS_PER_PASS", 10)
    wh = run("passes")
    assert wh.gold.fact_sales.select(F.shiftright("fact_key", KEY_BITS).alias("p")).distinct().count() == sinks.MOST_PASSES
    assert wh.gold.fact_sales.select("fact_key").distinct().count() == wh.gold.fact_sales.count() == whole.gold.fact_sales.count() > 0
    assert rows(wh.gold.fact_sales.drop("fact_key")) == rows(whole.gold.fact_sales.drop("fact_key"))
    assert wh.warnings == whole.warnings and [(s.step, s.status, s.rows) for s in wh.steps] == [(s.step, s.status, s.rows) for s in whole.steps]
    assert rows(wh.quarantine.drop("fact_key")) == rows(whole.quarantine.drop("fact_key")) != []


def test_stored_aggregates_are_written_in_passes(spark, gold, tmp_path, monkeypatch):
    """the rows of an order are in one pass, so no cell and order is stored twice; lines without an order are whole."""
    some = gold.fact_sales.withColumn("order_id", F.when(F.col("fact_key") % 7 != 0, F.col("order_id")))
    g = dataclasses.replace(gold, fact_sales=some)
    store = [registry.STORED[2], ["region", "ship_mode", "customer_id"]]
    once = L.build(g, store, str(tmp_path / "once"), dense=10 ** 9)
    monkeypatch.setattr(sinks, "ROWS_PER_PASS", 100)
    found = L.build(g, store, str(tmp_path / "passes"), dense=10 ** 9)
    assert passes_for(found.stored[0].rows) == sinks.MOST_PASSES
    for a, b in zip(once.stored, found.stored):
        assert (a.grouping, a.form, a.rows) == (b.grouping, b.form, b.rows)
        assert a is once.stored[0] or rows(a.sums) == rows(b.sums) != []
    for by in (["region", "ship_mode"], ["customer_id"], []):
        assert rows(L.answer(found, by)) == rows(L.answer(once, by)) == rows(measures(g, by=by))


def test_customers_are_counted_where_asked_for(gold, tmp_path):
    """order counts alone move no customers."""
    lattice = L.build(gold, registry.STORED[1:2], str(tmp_path), dense=10 ** 9)
    by = registry.VIEW_GROUPS["vw_customer_analysis"]
    orders, both = L.answer(lattice, by, ["total_orders"]), L.answer(lattice, by, ["total_orders", "total_customers"])
    used = lambda df: [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "_person" in x and "Relation" not in x]
    assert not used(orders) and used(both)
    assert rows(orders) == rows(both.drop("total_customers"))


def test_tolerant_landing_is_stored_once(spark, monkeypatch):
    """the landing file is packed, and raw text is stored for the rows that are kept as text."""
    bad = [(str(i), "O-1", "x" if i % 3 == 0 else "1998-01-01", "1998-01-02", *["1"] * 17) for i in range(9)]
    names = registry.ORDERS_COLUMNS
    text = spark.createDataFrame(bad, ", ".join(f"{c} string" for c in names))
    tagged = tolerant_tagged(spark, "orders", raw=text)
    stored = to_be_split(tagged, "orders")
    assert stored.columns == tagged.columns
    assert stored.where("failed_columns = '' AND _raw_row_id IS NOT NULL").count() == 0 < stored.where("_raw_row_id IS NOT NULL").count()
    for a, b in zip(split_tagged(tagged, "orders"), split_tagged(stored, "orders")):
        assert rows(a) == rows(b) != []
    monkeypatch.setattr(registry, "LINES_PER_FILE", 500)
    read = []
    monkeypatch.setattr(registry, "tolerant_tagged", lambda s, t, path: read.append(path) or tolerant_tagged(s, t, path))
    good, rejected = registry._tolerant(spark, sf_dir("0.001"))
    files = spark.read.text(read[0]).groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n")).collect()
    assert all(r["f"].endswith(".csv.gz") and r["n"] <= 501 for r in files)
    assert good.count() + rejected.count() == warehouse_for(spark, sf_dir("0.001")).bronze["orders"].count()
