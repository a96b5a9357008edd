"""The rule suite: every kind of rule, its failing rows, and one scan per checked table."""

from __future__ import annotations

import pytest

from tests.conftest import sf_dir
from tillroll.operators import rules as R
from tillroll.plans.registry import WAREHOUSE_RULES, _rule_tables, warehouse_for

RULES = {
    "child": [R.NotNull("a"), R.MaxLength("t", 3), R.InRange("v", 0, 10), R.InRange("v", None, 5), R.Unique(("a",)), R.Unique(("a", "t")),
              R.ForeignKey(("a",), "parent", ("id",)), R.ForeignKey(("a", "t"), "parent", ("id", "name"))],
    "parent": [R.Unique(("id",))],
    "empty": [R.NotNull("x"), R.Unique(("x",))],
}


@pytest.fixture(scope="module")
def tables(spark):
    child = [(1, "x", 3), (1, "x", 11), (2, "long", -1), (None, None, None), (3, "y", 6), (None, "y", 5), (2, None, 5)]
    return {"child": spark.createDataFrame(child, "a int, t string, v int"),
            "parent": spark.createDataFrame([(1, "x"), (2, "z"), (2, "z"), (None, "y")], "id int, name string"),
            "empty": spark.createDataFrame([], "x int")}


def test_counts_per_rule(tables):
    found = {(r["table_name"], r["rule"]): (r["n_rows"], r["n_failed"]) for r in R.check(RULES, tables).collect()}
    assert found == {
        ("child", "not_null(a)"): (7, 2), ("child", "max_length(t, 3)"): (7, 1), ("child", "in_range(v, 0, 10)"): (7, 2),
        ("child", "in_range(v, None, 5)"): (7, 2), ("child", "unique(a)"): (7, 2), ("child", "unique(a, t)"): (7, 1),
        ("child", "foreign_key(a, parent)"): (7, 1), ("child", "foreign_key(a, t, parent)"): (7, 2),
        ("parent", "unique(id)"): (4, 1), ("empty", "not_null(x)"): (0, 0), ("empty", "unique(x)"): (0, 0)}


def test_failing_rows_are_set_aside(tables):
    found = sorted(map(str, (tuple(r) for r in R.failing_rows(RULES, tables, "child").collect())))
    assert found == sorted(map(str, [
        (None, None, None, "not_null(a)"), (None, "y", 5, "not_null(a)"), (2, "long", -1, "max_length(t, 3)"), (2, "long", -1, "in_range(v, 0, 10)"),
        (1, "x", 11, "in_range(v, 0, 10)"), (1, "x", 11, "in_range(v, None, 5)"), (3, "y", 6, "in_range(v, None, 5)"),
        (3, "y", 6, "foreign_key(a, parent)"), (3, "y", 6, "foreign_key(a, t, parent)"), (2, "long", -1, "foreign_key(a, t, parent)"),
        (1, "x", 3, "unique(a)"), (1, "x", 11, "unique(a)"), (2, "long", -1, "unique(a)"), (2, None, 5, "unique(a)"),
        (1, "x", 3, "unique(a, t)"), (1, "x", 11, "unique(a, t)")]))
    assert R.failing_rows(RULES, tables, "empty").count() == 0


def test_one_scan_of_each_checked_table(spark):
    wh = warehouse_for(spark, sf_dir("0.001"))
    tables, rows = _rule_tables(wh)
    for name, column in (("bronze_orders", "product_name"), ("fact_sales", "fact_key")):
        df = R.check({name: WAREHOUSE_RULES[name]}, tables, rows)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert sum("FileScan parquet" in line and column in line.split("Batched")[0] for line in plan.splitlines()) == 1


def test_counts_agree_with_the_rows_set_aside(spark):
    tables, rows = _rule_tables(warehouse_for(spark, sf_dir("0.001")))
    counted = {r["rule"]: r["n_failed"] for r in R.check({"bronze_orders": WAREHOUSE_RULES["bronze_orders"]}, tables, rows).collect()}
    aside = {r["rule"]: r["count"] for r in R.failing_rows(WAREHOUSE_RULES, tables, "bronze_orders", rows).groupBy("rule").count().collect()}
    for rule, n in counted.items():
        assert aside.get(rule, 0) >= n if rule.startswith("unique") else aside.get(rule, 0) == n
    assert counted["unique(row_id)"] > 0 and counted["in_range(quantity, 1, None)"] > 0
