"""Publishing a run switches all names at once."""

from __future__ import annotations

import threading

from tests.conftest import bronze_frames, order_row, sf_dir
from tillroll.plans import catalog
from tillroll.plans.pipeline import publish_names, run_pipeline
from tillroll.plans.registry import warehouse_for

QUERY = """SELECT (SELECT count(*) FROM gold.fact_sales) AS facts, (SELECT count(*) FROM gold.dim_customer) AS customers,
  (SELECT count(*) FROM silver.orders) AS lines, (SELECT sum(total_orders) FROM gold.vw_customer_analysis) AS orders"""


def small_run(spark, root, n):
    return run_pipeline(spark, bronze_frames(spark, [order_row(i, order_id=f"O-{i}", customer_id=f"C-{i}") for i in range(n)]),
                        root=root, date_range="data", register_views=False)


def test_a_reader_in_a_loop_sees_whole_runs_only(spark, tmp_root):
    runs = {n: small_run(spark, tmp_root, n) for n in (2, 5, 9)}
    publish_names(spark, runs[2])
    seen, errors, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append(tuple(spark.sql(QUERY).first()))
            except Exception as e:  # a missing name would be one
                errors.append(str(e)[:300])
    readers = [threading.Thread(target=read) for _ in range(2)]
    for r in readers:
        r.start()
    try:
        for n in (5, 9, 2, 9, 5):
            publish_names(spark, runs[n])
            assert tuple(spark.sql(QUERY).first()) == (n,) * 4
    finally:
        stop.set()
        for r in readers:
            r.join()
    assert not errors and len(seen) > 3
    assert {len(set(row)) for row in seen} == {1} and {row[0] for row in seen} <= {2, 5, 9}


def test_the_idle_slot_costs_nothing_and_members_are_summed_first(spark):
    wh = warehouse_for(spark, sf_dir("0.001"))
    publish_names(spark, wh)
    assert spark.table("gold.fact_sales").count() == wh.gold.fact_sales.count()

    def plan(sql):
        df = spark.sql(sql)
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    whole = plan("SELECT customer_key, sales FROM gold.fact_sales")
    assert whole.count("FileScan parquet") == 1 and "Union" not in whole
    year = plan("SELECT sum(sales) FROM gold.fact_sales WHERE order_year = 1998")
    assert "order_year" in year.split("PartitionFilters: [")[1].split("]")[0]
    lines = [x.strip(" :+-*()0123456789") for x in plan("SELECT * FROM gold.vw_product_performance").splitlines()]
    join = next(i for i, x in enumerate(lines) if "Join" in x)
    assert any(x.startswith("HashAggregate") for x in lines[join:])


def test_slots_alternate(spark, tmp_root):
    run = small_run(spark, tmp_root, 3)
    publish_names(spark, run)
    first = catalog.current_slot(spark)
    publish_names(spark, run)
    assert {first, catalog.current_slot(spark)} == set(catalog.SLOTS)
