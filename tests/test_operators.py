"""Operators: dense keys, dedup, lookups, quality checks."""

from __future__ import annotations

import pytest

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.operators import quality
from tillroll.operators.dedup import drop_exact_duplicates, first_per_key
from tillroll.operators.keys import dense_key, unique_key
from tillroll.operators.lookup import estimated_row_bytes, fits_broadcast, lookup


def _global_rank(df, cols):
    return df.select(F.row_number().over(Window.orderBy(*[F.col(c).asc_nulls_first() for c in cols])).alias("k"), *df.columns)


def test_dense_key_equals_global_row_number(spark):
    rows = [(f"C-{i % 97}", f"name{i % 13}" if i % 11 else None, i % 5) for i in range(700)]
    df = spark.createDataFrame(rows, "id string, name string, seg int").distinct()
    keyed = dense_key(df, ["id", "name", "seg"], "k", num_partitions=7)
    expected = _global_rank(df, ["id", "name", "seg"])
    assert keyed.count() == df.count()
    assert keyed.exceptAll(expected).count() == 0
    assert keyed.columns[0] == "k"


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(-5, 5), st.text(alphabet="ab ", max_size=3)), min_size=0, max_size=40, unique=True),
       st.integers(1, 6))
def test_dense_key_property(spark, rows, parts):
    df = spark.createDataFrame(rows, "a int, b string")
    keyed = dense_key(df, ["a", "b"], "k", num_partitions=parts).collect()
    assert sorted(r.k for r in keyed) == list(range(1, len(rows) + 1))
    ordered = sorted(keyed, key=lambda r: r.k)
    assert [(r.a, r.b) for r in ordered] == sorted(rows)


def test_dense_key_reuses_the_range_exchange(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x"))
    keyed = dense_key(df, ["x"], "k", num_partitions=4)
    keyed.collect()
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan or plan.count("rangepartitioning") == 1


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_dense_key_of_a_column_that_is_not_sorted_by(spark, reuse):
    df = spark.range(0, 50_000, 1, 7).select((F.col("id") * 7919 % 50_000).alias("x"), (F.col("id") * 3).alias("payload"))
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        keyed = dense_key(df, ["x"], "k", num_partitions=9)
        assert keyed.filter("k <> x + 1").count() == 0 and keyed.select("k").distinct().count() == 50_000
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_unique_key_is_unique(spark):
    df = spark.range(0, 5000, numPartitions=5)
    keyed = unique_key(df, "fk")
    assert keyed.select("fk").distinct().count() == 5000
    assert keyed.filter("fk < 1").count() == 0


def test_exact_dedup_keeps_lowest_row_id_and_treats_null_equal(spark):
    rows = [(5, "a", None), (3, "a", None), (4, "b", 1), (9, "b", 1), (1, "b", 2)]
    df = spark.createDataFrame(rows, "row_id long, x string, y int")
    out = drop_exact_duplicates(df, ["x", "y"], "row_id", count_as="n").orderBy("row_id").collect()
    assert [(r.row_id, r.x, r.y, r.n) for r in out] == [(1, "b", 2, 1), (3, "a", None, 2), (4, "b", 1, 2)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 9)), st.sampled_from("ab"), st.one_of(st.none(), st.integers(0, 1))), max_size=30))
def test_exact_dedup_is_the_first_row_with_null_first(spark, rows):
    df = spark.createDataFrame(rows, "row_id long, x string, y int")
    want = {}
    for r, *key in rows:
        want.setdefault(tuple(key), []).append((r is not None, r or 0, r))
    got = {(r.x, r.y): r.row_id for r in drop_exact_duplicates(df, ["x", "y"], "row_id").collect()}
    assert got == {k: min(v)[2] for k, v in want.items()}


@pytest.mark.parametrize("order", [1, -1])
def test_collated_dedup_keeps_the_spelling_of_its_row(spark, order):
    from tillroll.plans.silver import collated

    rows = [(2, "ann", "Bob "), (1, "ANN", "bob"), (None, "cy", "d"), (3, "CY", "D"), (4, "e", None), (4, "E", None)][::order]
    df = collated(spark.createDataFrame(rows, "row_id long, x string, y string").repartition(3), "UTF8_LCASE_RTRIM")
    out = drop_exact_duplicates(df, ["x", "y"], "row_id", count_as="n")
    assert {(r.row_id, r.x, r.y, r.n) for r in out.collect()} == {(1, "ANN", "bob", 2), (None, "cy", "d", 2), (4, "E", None, 2)}
    assert out.schema["x"].dataType == df.schema["x"].dataType


def test_first_per_key_sorts_null_first(spark):
    rows = [("p1", "WEST"), ("p1", "EAST"), ("p2", None), ("p2", "AAA"), ("p3", "Z")]
    df = spark.createDataFrame(rows, "person_name string, region string")
    out = {r.person_name: r.region for r in first_per_key(df, ["person_name"], "region").collect()}
    assert out == {"p1": "EAST", "p2": None, "p3": "Z"}


def test_lookup_broadcasts_only_proven_small_dims(spark):
    fact = spark.range(100).select(F.col("id").alias("k"))
    dim = spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    assert fits_broadcast(dim, 10) and not fits_broadcast(dim, None)
    assert not fits_broadcast(dim, 10_000_000_000)
    assert estimated_row_bytes(dim.schema) > 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = lookup(fact, dim, ["k"], right_rows=10)
        unknown = lookup(fact, dim, ["k"], right_rows=None)
        assert "BroadcastHashJoin" not in small._jdf.queryExecution().executedPlan().toString()  # -1 is honoured
        assert "BroadcastHashJoin" in lookup(fact, dim, ["k"], right_rows=10, limit=10_000)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in unknown._jdf.queryExecution().sparkPlan().toString()
        assert small.count() == 100 and unknown.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_quality_checks(spark):
    fact = spark.createDataFrame([(1, None), (None, None), (3, 4)], "a int, b int")
    row = quality.unmatched_keys(fact, ["a", "b"]).first()
    assert (row.total_rows, row.rows_with_missing_key, row.null_a, row.null_b) == (3, 2, 1, 2)
    dups = quality.duplicate_keys(spark.createDataFrame([(1,), (1,), (2,)], "k int"), ["k"]).collect()
    assert [(r.k, r.n_rows) for r in dups] == [(1, 2)]
    long = quality.text_length_violations(spark.createDataFrame([("abcd", "x"), ("ab", "y")], "s string, t string"),
                                          {"s": 3, "t": 5})
    assert {r.column_name: r.n_too_long for r in long.collect()} == {"s": 1, "t": 0}
    counts = quality.row_counts({"one": fact, "two": fact.limit(1)})
    assert {r.table_name: r.n_rows for r in counts.collect()} == {"one": 3, "two": 1}


def test_dense_key_without_exchange_reuse(spark):
    rows = [(i * 7919 % 1000, f"v{i % 17}") for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b string").distinct()
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        keyed = dense_key(df, ["a", "b"], "k", num_partitions=5)
        assert keyed.exceptAll(_global_rank(df, ["a", "b"])).count() == 0
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_size_parsing():
    from tillroll.operators.lookup import size_in_bytes
    assert size_in_bytes("10485760b") == 10485760 and size_in_bytes("64MB") == 64 * 1024 ** 2
    assert size_in_bytes("1g") == 1024 ** 3 and size_in_bytes("-1") == -1


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.sampled_from(["a", "b", "a "]))),
                min_size=0, max_size=30))
def test_exact_dedup_equals_row_number_window(spark, values):
    rows = [(i, x, y) for i, (x, y) in enumerate(values)]
    df = spark.createDataFrame(rows, "row_id long, x int, y string")
    w = Window.partitionBy("x", "y").orderBy("row_id")
    expected = df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    got = drop_exact_duplicates(df, ["x", "y"], "row_id")
    assert sorted(got.collect()) == sorted(expected.collect())


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["p1", "p2", "p3"]), st.one_of(st.none(), st.sampled_from(["E", "W", "N"]))),
                min_size=0, max_size=20))
def test_first_per_key_equals_row_number_window(spark, values):
    df = spark.createDataFrame(values, "person_name string, region string")
    w = Window.partitionBy("person_name").orderBy(F.col("region").asc_nulls_first())
    expected = df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    got = first_per_key(df, ["person_name"], "region")
    assert sorted(got.collect(), key=str) == sorted(expected.collect(), key=str)
