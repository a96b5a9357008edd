"""W1 by digest: the rows of the plain dedup, clashes of digests included, for fewer bytes moved."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import BRONZE_ORDERS, order_row, sf_dir
from tillroll.operators import dedup
from tillroll.plans.registry import warehouse_for
from tillroll.plans.silver import dedup_orders
from tillroll.schemas import ORDERS_DEDUP_COLUMNS


def rows(df):
    return sorted(map(str, df.collect()))


def both(df):
    plain, digest = dedup_orders(df, "n"), dedup_orders(df, "n", by_digest=True)
    assert plain.columns == digest.columns
    assert rows(plain) == rows(digest)
    return digest


def test_clashing_digests_stay_two_rows(spark):
    """Hashes pass over missing values, so these two rows have one digest."""
    lines = [order_row(1, state="X", postal_code=None), order_row(2, state=None, postal_code="X"), order_row(3, order_id="O-9"),
             order_row(5, order_id="O-7"), order_row(4, order_id="O-7"), order_row(None, order_id="O-8"), order_row(6, order_id="O-8")]
    df = spark.createDataFrame(lines, BRONZE_ORDERS)
    one = df.where("row_id IN (1, 2)").select(*dedup.digests(ORDERS_DEDUP_COLUMNS)).distinct()
    assert one.count() == 1
    found = both(df)
    assert {(r["row_id"], r["n"]) for r in found.collect()} == {(1, 1), (2, 1), (3, 1), (4, 2), (None, 2)}
    marked = dedup.suspected(df, ORDERS_DEDUP_COLUMNS)
    assert marked.where("_suspected AND row_id = 3").count() == 0 and marked.where("_suspected").count() >= 6


def test_all_alike_none_alike_and_empty(spark):
    one = [order_row(i) for i in range(50)]
    for lines in (one, [order_row(i, order_id=f"O-{i}") for i in range(50)], []):
        both(spark.createDataFrame(lines, BRONZE_ORDERS))


def test_a_full_filter_only_suspects_more(spark, monkeypatch):
    monkeypatch.setattr(dedup, "MOST_STRETCHES", 1)
    lines = spark.range(120_000).select((F.col("id") % 60_000).alias("row_id"), F.concat(F.lit("O-"), (F.col("id") % 60_000).cast("string")).alias("order_id"))
    found = dedup.drop_exact_duplicates_by_digest(lines, ["order_id"], "row_id", "n")
    assert found.count() == 60_000 and found.agg(F.min("n"), F.max("n")).first()[:] == (2, 2)


def test_collated_columns_take_the_plain_way(spark):
    df = spark.createDataFrame([(1, "a"), (2, "A"), (3, "b")], "row_id long, t string").select("row_id", F.collate("t", "UTF8_LCASE").alias("t"))
    assert dedup.drop_exact_duplicates_by_digest(df, ["t"], "row_id").count() == 2


def written_bytes(spark, df):
    """Bytes that the exchanges below an action write, from the plan's own metrics."""
    df.collect()
    seen, total = set(), 0

    def visit(node):
        nonlocal total
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return visit(node.finalPhysicalPlan())
        if hasattr(node, "plan") and "QueryStage" in name:
            return visit(node.plan())
        if name == "Exchange" and node.id() not in seen:
            seen.add(node.id())
            metric = node.metrics().get("shuffleBytesWritten")
            total += metric.get().value() if metric.isDefined() else 0
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))
    visit(df._jdf.queryExecution().executedPlan())
    return total


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_fewer_bytes_are_moved(spark, sf):
    if sf == "0.1" and not os.environ.get("TILLROLL_LARGE"):
        pytest.skip("set TILLROLL_LARGE for the larger table")
    orders = warehouse_for(spark, sf_dir(sf)).bronze["orders"]
    plain = written_bytes(spark, dedup_orders(orders).agg(F.sum(F.xxhash64(*orders.columns).cast("decimal(38,0)"))))
    one, two = dedup.digests(ORDERS_DEDUP_COLUMNS)
    first = written_bytes(spark, orders.select(one.alias("a"), two.alias("b")).groupBy("a", "b").count().where("count > 1").agg(F.count("*")))
    rest = written_bytes(spark, dedup_orders(orders, by_digest=True).agg(F.sum(F.xxhash64(*orders.columns).cast("decimal(38,0)"))))
    print(json.dumps({"sf": sf, "plain": plain, "digests": first, "suspected": rest}))
    assert 3 * (first + rest) <= plain
