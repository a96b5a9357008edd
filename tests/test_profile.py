"""The whole profile, its sketches against exact values."""

from __future__ import annotations

import statistics
from decimal import Decimal

from pyspark.sql import functions as F

from tillroll.sources.profile import DISTINCT_ERROR, RANK_ERROR, describe, describe_checked


def test_moments_and_sketches(spark):
    n = 50_000
    df = spark.range(n).select(
        (F.col("id") % 1000).alias("v"), F.when(F.col("id") % 10 != 0, F.col("id").cast("decimal(12,2)")).alias("d"),
        F.concat(F.lit("t"), F.col("id") % 7777).alias("t"), F.lit(None).cast("int").alias("none"), F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 365).cast("int")).alias("day"))
    found = {r["column_name"]: r for r in describe(df).collect()}
    v, d = [i % 1000 for i in range(n)], [i for i in range(n) if i % 10]
    assert found["v"]["mean"] == statistics.fmean(v) and abs(found["v"]["stddev"] - statistics.stdev(v)) < 1e-6
    assert found["d"]["n_nulls"] == n // 10 and found["d"]["mean"] == sum(map(Decimal, d)) / len(d)
    for name, values in (("v", sorted(v)), ("d", d)):
        for q, got in zip((0.25, 0.5, 0.75), (found[name][c] for c in ("p25", "p50", "p75"))):
            below, up_to = sum(x < got for x in values), sum(x <= got for x in values)
            assert below <= (q + RANK_ERROR) * len(values) and up_to >= (q - RANK_ERROR) * len(values)
    for name, exact in (("v", 1000), ("d", len(d)), ("t", 7777), ("day", 365)):
        assert abs(found[name]["approx_distinct"] - exact) <= DISTINCT_ERROR * exact
    assert found["t"]["mean"] is None and found["t"]["p50"] is None and found["day"]["stddev"] is None
    assert all(found["none"][c] is None for c in ("min_value", "mean", "stddev", "p25", "p50", "p75")) and found["none"]["n_nulls"] == n and found["none"]["approx_distinct"] == 0
    checked = {r["column_name"]: r for r in describe_checked(df).collect()}
    assert all(r["distinct_holds"] for r in checked.values()) and checked["v"]["quartiles_hold"] and checked["t"]["quartiles_hold"] is None


def test_an_empty_table(spark):
    found = describe(spark.createDataFrame([], "a int, b string")).collect()
    assert [(r["n_rows"], r["n_nulls"], r["mean"], r["p50"], r["approx_distinct"]) for r in found] == [(0, 0, None, None, 0)] * 2


def test_one_pass(spark):
    plan = describe(spark.range(10).selectExpr("id", "id * 2 AS b"))._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Range (") == 1 and plan.count("Exchange") == 1
