"""Plans whose exchanges grow no faster than the input: findings of round 3."""

from __future__ import annotations

import dataclasses

import pytest
from pyspark.sql import functions as F

from tests.conftest import bronze_frames, order_row, sf_dir
from tillroll.operators import rules as R
from tillroll.operators.dedup import marked_by
from tillroll.operators.keys import ROWS_PER_KEY_PARTITION, dense_key, ranges_for
from tillroll.operators.lookup import sparse_lookup
from tillroll.plans import gold as gold_plan
from tillroll.plans import registry, silver, views
from tillroll.plans.gold import dimension
from tillroll.plans.lattice import build
from tillroll.plans.measures import measures
from tillroll.plans.refresh import refresh
from tillroll.plans.registry import warehouse_for
from tillroll.sources import adapter, layout
from tillroll.sources.profile import describe_checked
from tillroll.sources.sinks import fact_layout


@pytest.fixture(scope="module")
def gold(spark):
    return warehouse_for(spark, sf_dir("0.001")).gold


def rows(df):
    return [str(r) for r in df.collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [1, 10, 100_000])
def test_first_rows_of_the_summary_join_few_lines(gold, n):
    """the joins meet the lines of the first orders only; the rows are those of the whole summary."""
    found = views.first_orders(gold, n)
    order = [F.col(c).asc_nulls_first() for c in registry.SUMMARY_ORDER]
    assert rows(views.sales_summary(found).orderBy(*order).limit(n)) == rows(views.sales_summary(gold).orderBy(*order).limit(n))
    if n < 1000:
        assert found.rows["fact_sales"] == found.fact_sales.count() <= n + 200
        assert found.dim_product.count() <= found.rows["fact_sales"] and found.dim_customer.count() <= found.rows["fact_sales"]


def test_first_rows_without_order_ids(spark, gold):
    """missing order ids come first; an empty fact gives no row."""
    some = gold.fact_sales.withColumn("order_id", F.when(F.col("fact_key") % 5 != 0, F.col("order_id")))
    order = [F.col(c).asc_nulls_first() for c in registry.SUMMARY_ORDER]
    for fact in (some, gold.fact_sales.withColumn("order_id", F.lit(None).cast("string")), gold.fact_sales.limit(0)):
        g = dataclasses.replace(gold, fact_sales=fact)
        assert rows(views.sales_summary(views.first_orders(g, 7)).orderBy(*order).limit(7)) == rows(views.sales_summary(g).orderBy(*order).limit(7))


def test_refresh_finds_the_members_once(spark, tmp_root):
    """the lines are read once a refresh, however often bounds, digests and rows read the members."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    lines = spark.range(1000).selectExpr("CAST(id % 50 AS STRING) AS a").mapInArrow(count, "a string")
    assert refresh(lines, ["a"], "k", tmp_root, ranges=4).rows.count() == 50
    assert seen.value == 1000


def test_rules_on_keys_count_by_key(spark):
    """no row is copied per unique key, and joins meet counts per key."""
    child = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (None, "y"), (4, "z")], "a int, t string")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "a int")
    rules = {"child": [R.Unique(("a",)), R.Unique(("a", "t")), R.ForeignKey(("a",), "parent", ("a",)), R.NotNull("t")]}
    found = R.check(rules, {"child": child, "parent": parent})
    assert {r["rule"]: (r["n_rows"], r["n_failed"]) for r in found.collect()} == {
        "unique(a)": (5, 1), "unique(a, t)": (5, 1), "foreign_key(a, parent)": (5, 2), "not_null(t)": (5, 1)}
    assert "Expand" not in plan(found)


def test_checked_profile_copies_no_rows(spark):
    """distinct values are counted column by column, not by copying each row once per column."""
    df = spark.range(3000).selectExpr("id", "id % 7 AS b", "CAST(id % 11 AS STRING) AS c", "CAST(NULL AS STRING) AS none")
    found = describe_checked(df)
    assert all(r["distinct_holds"] for r in found.collect()) and found.count() == 4
    assert "Expand" not in plan(found)


def test_first_member_sorts_members_not_lines(spark):
    """the minimum of a struct meets distinct rows."""
    orders = bronze_frames(spark, [order_row(i, customer_name=n) for i, n in enumerate(["Bo", "Ann", None, "Ann", "Bo"])])["orders"]
    found = dimension(orders, "dim_customer", dedupe="first")
    assert [(r["customer_id"], r["customer_name"]) for r in found.collect()] == [("C-1", None)]
    text = plan(found).split("== Initial Plan ==")[-1]
    assert "SortAggregate" not in text or "HashAggregate" in text.split("SortAggregate")[-1]


@pytest.mark.parametrize("query", [registry.q_silver_orders_dedup_exact, registry.q_ship_mode_repair])
def test_dedup_moves_only_possible_copies(spark, query):
    """Rows without a copy are not shuffled whole."""
    assert "_bits" in query(spark, sf_dir("0.001"))._jdf.queryExecution().analyzed().toString()


def test_summary_moves_narrow_rows(gold):
    """the date's texts join after the dimensions that may have to be shuffled."""
    lines = views.sales_summary(gold)._jdf.queryExecution().analyzed().toString().splitlines()
    depth = {key: next(x.index("Join") for x in lines if "Join" in x and f"({key}#" in x) for key in ("order_date_key", "customer_key", "product_key")}
    assert depth["order_date_key"] < depth["product_key"] < depth["customer_key"]


def test_lattice_keeps_lines_without_texts(gold, tmp_path):
    """what is stored of each line is keys, numbers and flags; no copy with names is written first."""
    lattice = build(gold, registry.STORED, str(tmp_path))
    schema = gold.fact_sales.sparkSession.read.parquet(str(tmp_path / "base")).schema
    assert not [f.name for f in schema.fields if f.dataType.simpleString() == "string"] and not (tmp_path / "lines").exists()
    assert set(lattice.stored[0].grouping) <= set(lattice.stored[0].sums.columns)


@pytest.mark.parametrize("by, role", [(["region", "ship_mode"], "order"), (["segment", "year"], "order"), (["year", "month"], "ship"), (["customer_id"], "order"), ([], "order")])
def test_measures_copy_no_rows_and_join_large_dimensions_last(gold, by, role):
    """no row is copied per distinct count; dimensions not known to be small give the same rows."""
    found = measures(gold, by=by, date_role=role)
    assert "Expand" not in plan(found)
    unknown = dataclasses.replace(gold, rows={})
    assert sorted(rows(measures(unknown, by=by, date_role=role))) == sorted(rows(found))
    late = measures(unknown, by=by, date_role=role, order_rule="all", where="sales > 100")
    assert sorted(rows(late)) == sorted(rows(measures(gold, by=by, date_role=role, order_rule="all", where="sales > 100")))


def test_numbering_with_a_payload_writes_compressed_rows(spark):
    """rows with further columns are pinned by a compressed write, not by a checkpoint; ranges follow their number."""
    df = spark.range(0, 3000, 1, 5).select((F.col("id") * 7 % 3000).alias("x"), F.col("id").alias("a b"), F.lit(None).cast("string").alias("none"))
    keyed = dense_key(df, ["x"], "k", 7)
    assert "ExistingRDD" not in plan(keyed) and "FileScan parquet" in plan(keyed)
    assert keyed.columns == ["k", "x", "a b", "none"] and keyed.where("k = x + 1 AND x = `a b` * 7 % 3000 AND none IS NULL").count() == 3000
    assert ranges_for(spark, 10**9) == 10**9 // ROWS_PER_KEY_PARTITION and ranges_for(spark, 10) == 4 and ranges_for(spark, None) is None


def test_landing_files_of_quoted_line_breaks_are_bounded(spark, monkeypatch):
    """such a file is read by one task, so no file holds more lines than the bound, whatever the input."""
    monkeypatch.setattr(registry, "LINES_PER_FILE", 500)
    found = registry.q_landing_csv(spark, sf_dir("0.001"))
    files = [r["n"] for r in found.groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(files) <= 500 and sum(files) == warehouse_for(spark, sf_dir("0.001")).bronze["orders"].count()


def test_layout_by_key_has_ranges_by_the_number_of_rows(spark, tmp_path, monkeypatch):
    """ranges along the curve are not merged by their compressed size."""
    monkeypatch.setattr(layout, "ROWS_PER_RANGE", 100)
    key = lambda n: (F.col("id") % n + 1).cast("int")
    fact = spark.range(2000).select(key(7).alias("location_key"), key(300).alias("customer_key"), key(90).alias("product_key"),
                                    (key(300) + 19980100).alias("order_date_key"), (key(300) + 19980100).alias("ship_date_key"),
                                    F.concat(F.lit("O-"), "id").alias("order_id"))
    found = layout.write_by_key(fact, str(tmp_path / "by_key"), 2000)
    files = [r["rows"] for r in spark.read.parquet(found.files).collect()]
    assert sum(files) == 2000 and len(files) >= 15
    assert layout.read_where(spark, [found], {"customer_key": [5]}).count() == fact.where("customer_key = 5").count()


LINES = ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
         "l_discount double")


def test_lines_move_once_by_order(spark):
    """Lines are numbered and joined where one shuffle by order puts them; an order of many lines, missing keys and copies are whole."""
    def check(lines, many):
        df = spark.createDataFrame(lines, LINES)
        orders = spark.createDataFrame([(k, k * 10) for k in range(5)] + [(None, 1)], "o_orderkey long, o_custkey long")
        found = adapter.lines_with_orders(df, orders)
        assert ("rangepartitioning(l_orderkey" in plan(found)) == many
        expected = adapter.number_lines(df).join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(found.columns)
        assert sorted(rows(found)) == sorted(rows(expected)) and found.count() == sum(r[0] is not None for r in lines)
    few = [(i % 5, i % 3, i, 1, 1.0, float(i), 0.1) for i in range(40)] + [(1, 1, 1, 1, 1.0, 1.0, None)] * 3 + [(None, 1, 1, 1, 1.0, 1.0, 0.0)] * 2
    check(few, many=False)
    check(few + [(2, i % 7, i, 1, 1.0, 2.0, 0.0) for i in range(3000)], many=True)


def test_silver_is_built_by_digest(spark):
    """The build moves whole only the lines that may have a copy, for the same rows."""
    lines = [order_row(i, order_id=f"O-{i % 30}") for i in range(40)] + [order_row(None, order_id="O-3"), order_row(1, order_id=None)]
    bronze = bronze_frames(spark, lines)
    built = silver.build_silver(bronze, load_stamp=False)["orders"]()
    assert "bitmap_construct_agg" in plan(built) and "Union" in plan(built)
    assert sorted(rows(built)) == sorted(rows(silver.silver_orders(bronze["orders"], load_stamp=False)))


def test_lines_that_match_nothing_do_not_move(spark):
    """As the plain lookup, with missing, repeated and collated keys; the rest passes by the join."""
    left = spark.createDataFrame([(f"O-{i}", i) for i in range(2000)] + [(None, 7), ("O-5", 8)], "k string, v int")
    right = spark.createDataFrame([("O-5", 1), ("O-6", 1), ("O-6", 2), (None, 3), ("O-9999", 1)], "k string, w int")
    found = sparse_lookup(left, right, "k", 5, limit=1)
    assert sorted(rows(found)) == sorted(rows(left.join(right, ["k"], "left").select(found.columns)))
    assert "bitmap_construct_agg" in plan(found) and "Union" in plan(found)
    assert marked_by(left, F.xxhash64("k"), right.select(F.xxhash64("k").alias("_d1")), 5).where("_suspected").count() < 100
    assert sorted(rows(sparse_lookup(left, right, "k", 5))) == sorted(rows(found)) == sorted(rows(sparse_lookup(left, right, "k")))
    spelt = [df.withColumn("k", F.collate(F.lower("k") if df is left else F.col("k"), "UTF8_LCASE")) for df in (left, right)]
    assert sparse_lookup(*spelt, "k", 5, limit=1).where("w IS NOT NULL").count() == found.where("w IS NOT NULL").count() == 4


def test_computed_fact_columns_do_not_move(spark, gold):
    """The layout's shuffle comes before what is computed from a line; its tables of lines are written compactly."""
    wh = warehouse_for(spark, sf_dir("0.001"))
    args = (wh.silver["orders"], wh.silver["returns_order"], gold.dim_date, gold.dims(), gold.rows)
    laid, plain = gold_plan.fact_sales(*args, arrange=fact_layout), gold_plan.fact_sales(*args)
    below = laid._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1]
    assert "unit_price" not in below and "profit_margin" not in below and "order_year" in laid.columns
    shown = [c for c in plain.columns if c != "fact_key"]
    assert sorted(rows(laid.select(shown))) == sorted(rows(plain.select(shown)))
    assert laid.select("fact_key").distinct().count() == laid.count()
    for path in ("bronze/orders", "silver/orders", "gold/fact_sales"):
        assert all(f.endswith(".zstd.parquet") for f in spark.read.parquet(f"{wh.root}/{path}").inputFiles())
