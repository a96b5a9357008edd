"""SURVEY section 5 properties on the driver data (whole tables, sf0.001)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.conftest import sf_dir
from tillroll.operators import quality
from tillroll.plans import views
from tillroll.plans.measures import measures
from tillroll.plans.registry import warehouse_for
from tillroll.plans.silver import dedup_orders
from tillroll.schemas import DIMENSIONS, ORDERS_DEDUP_COLUMNS


def test_warehouse_properties(spark):
    wh = warehouse_for(spark, sf_dir("0.001"))
    gold = wh.gold
    # Exact dedup leaves no two rows equal on the 20 raw columns.
    deduped = dedup_orders(wh.bronze["orders"])
    assert deduped.count() == deduped.select(*ORDERS_DEDUP_COLUMNS).distinct().count()
    # The fixture plants natural-key duplicates in three dimensions: each line has as many fact rows as its keys have members.
    report = quality.natural_key_report({n: (getattr(gold, n), s["join_on"]) for n, s in DIMENSIONS.items()})
    assert {r["dim_name"] for r in report.collect()} == {"dim_customer", "dim_location", "dim_sales_person"}
    lines = wh.silver["orders"].withColumn("_n", F.lit(1))
    for name, spec in DIMENSIONS.items():
        on = spec["join_on"]
        members = getattr(gold, name).groupBy(*on).agg(F.count("*").alias("_m"))
        lines = lines.join(members, on, "left").withColumn("_n", F.col("_n") * F.coalesce("_m", F.lit(1))).drop("_m")
    expected = lines.agg(F.sum("_n"), F.sum(F.col("_n") * F.col("sales"))).first()
    assert expected[0] > wh.silver["orders"].count()
    both = gold.fact_sales.select("sales").unionAll(wh.quarantine.select("sales"))
    assert tuple(both.agg(F.count("*"), F.sum("sales")).first()) == tuple(expected)
    assert wh.quarantine.count() > 0
    # The same sales total everywhere.
    total = gold.fact_sales.agg(F.sum("sales")).first()[0]
    for name, view in views.VIEWS.items():
        col = {"vw_customer_analysis": "total_spent", "vw_sales_summary": "sales"}.get(name, "total_sales")
        assert view(gold).agg(F.sum(col)).first()[0] == total, name
    assert measures(gold, names=["total_sales"]).first()[0] == total
    # Calendar flags partition the days; keys are dense.
    assert gold.dim_date.filter("is_weekend + is_business_day <> 1").count() == 0
    for name, spec in DIMENSIONS.items():
        keys = getattr(gold, name).agg(F.min(spec["key"]), F.max(spec["key"]), F.count("*")).first()
        assert (keys[0], keys[1]) == (1, keys[2]), name
