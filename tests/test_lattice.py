"""Stored aggregates: every grouping equals the measures over the fact, in either form of the sets."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import sf_dir
from tillroll.plans import lattice as L
from tillroll.plans.gold import Gold
from tillroll.plans.measures import measures
from tillroll.plans.registry import REPORT, STORED, VIEW_GROUPS, warehouse_for


@pytest.fixture(scope="module")
def gold(spark):
    return warehouse_for(spark, sf_dir("0.001")).gold


@pytest.fixture(scope="module", params=[1, 10, 10 ** 9], ids=["bits", "mixed", "rows"])
def stored(request, spark, gold, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lattice"))
    return request.param, L.build(gold, STORED, root, dense=request.param), root


def rows(df):
    return sorted(map(str, df.collect()))


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_forms_follow_density(stored):
    dense, lattice, _ = stored
    forms = {s.grouping: s.form for s in lattice.stored[1:]}
    assert lattice.stored[0].form == "rows" and len(forms) == 4
    if dense != 10:
        assert set(forms.values()) == ({"bits"} if dense == 1 else {"rows"})
    else:
        assert set(forms.values()) == {"rows", "bits"}


@pytest.mark.parametrize("by", [*REPORT, *VIEW_GROUPS.values(), ["customer_id"], STORED[2], ["category", "segment"]], ids=",".join)
def test_answers_equal_the_measures(gold, stored, by):
    _, lattice, _ = stored
    for options in ({}, {"numeric": "double"}, {"order_rule": "all", "horizon": 2.5}):
        assert rows(L.answer(lattice, by, **options)) == rows(measures(gold, by=by, **options))


def test_the_smallest_stored_aggregate_answers(stored):
    _, lattice, _ = stored
    assert lattice.smallest(["category", "sub_category"]).grouping == tuple(STORED[0])
    assert lattice.smallest(["segment", "year"]).grouping == tuple(STORED[1])
    mode = lattice.smallest(["ship_mode"])
    assert mode.rows == min(s.rows for s in lattice.stored if "ship_mode" in s.grouping)
    assert lattice.smallest(["category", "segment"]) is lattice.stored[0]
    with pytest.raises(ValueError):
        lattice.smallest(["postal_code"])


def test_eight_groupings_read_the_fact_once(gold, stored):
    _, lattice, root = stored
    once = plan(L.order_rows(gold, sorted({a for g in STORED for a in g})))
    assert sum("FileScan parquet" in line and "sales#" in line.split("Batched")[0] for line in once.splitlines()) == 1
    # The report itself reads stored aggregates only.
    together = L.report(lattice, REPORT)
    assert all(root in f for f in together.inputFiles()) and "fact_sales" not in plan(together)
    assert together.groupBy("grouping").count().count() == len(REPORT) == 8


def test_sets_across_many_stretches_and_missing_values(spark, gold, tmp_path):
    """More numbers than one bitmap holds, repeated lines, missing attributes; a third of all lines are one member's."""
    n = 70_000
    fact = spark.range(n * 2).select(
        (F.col("id") % n).alias("o"), F.col("id")).select(
        F.col("id").alias("fact_key"), F.lit(19980101).cast("int").alias("order_date_key"), F.lit(19980104).cast("int").alias("ship_date_key"),
        F.lit(1).cast("long").alias("customer_key"), F.lit(1).cast("long").alias("product_key"), F.lit(1).cast("long").alias("location_key"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 3 == 1, F.lit(2)).cast("long").alias("ship_mode_key"),
        F.lit(None).cast("long").alias("sales_person_key"), F.concat(F.lit("O-"), F.col("o")).alias("order_id"),
        F.lit(1).cast("decimal(10,4)").alias("sales"), F.lit(1).alias("quantity"), F.lit(0).cast("decimal(5,4)").alias("discount"),
        F.lit(1).cast("decimal(10,4)").alias("profit"), F.lit(1).cast("decimal(10,4)").alias("unit_price"),
        F.lit(1).cast("decimal(10,4)").alias("profit_margin"), F.lit(3).alias("days_to_ship"), (F.col("o") % 7 == 0).cast("int").alias("is_returned"))
    small = Gold(gold.dim_date, gold.dim_customer, gold.dim_product, gold.dim_location, gold.dim_ship_mode, gold.dim_sales_person, fact, gold.rows)
    lattice = L.build(small, [["ship_mode", "sales_person"], ["ship_mode"], ["segment", "ship_mode"]], str(tmp_path))
    assert {s.form for s in lattice.stored[1:]} == {"bits"}
    assert lattice.stored[-1].sets.select("bucket").distinct().count() == 3
    for by in ([], ["ship_mode"], ["sales_person"], ["segment"]):
        assert rows(L.answer(lattice, by)) == rows(measures(small, by=by))


def test_an_empty_fact(spark, gold, tmp_path):
    none = Gold(gold.dim_date, gold.dim_customer, gold.dim_product, gold.dim_location, gold.dim_ship_mode, gold.dim_sales_person,
                gold.fact_sales.limit(0), gold.rows)
    lattice = L.build(none, [["ship_mode"], ["segment", "year"]], str(tmp_path))
    assert rows(L.answer(lattice, ["ship_mode"])) == []
    assert rows(L.answer(lattice)) == rows(measures(none))
