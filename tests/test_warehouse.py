"""Hand-made cases through the whole pipeline (bronze -> silver -> gold -> views)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import bronze_frames, order_row
from tillroll.operators import quality
from tillroll.operators.quality import DataQualityError
from tillroll.plans import views
from tillroll.plans.gold import dim_date
from tillroll.plans.measures import MEASURE_NAMES, measures
from tillroll.plans.pipeline import run_pipeline
from tillroll.rules import SilverRules
from tillroll.schemas import DIMENSIONS, ORDERS_COLUMNS

RANGE = (dt.date(1998, 1, 1), dt.date(1998, 12, 31))
RULES = SilverRules().extended(order_date_overrides={"O-100": dt.date(1998, 1, 14)})
D = dt.date


def mixed_orders():
    return [
        # order date override with a bad ship mode: the repair uses the raw dates (5 days)
        order_row(1, order_id="O-100", order_date=D(1998, 1, 10), ship_date=D(1998, 1, 15), ship_mode="null"),
        # one customer id with two segments
        order_row(2, order_id="O-2", customer_id="C-2", segment="RETAIL"),
        order_row(3, order_id="O-3", customer_id="C-2", segment="CORPORATE"),
        # region with two sales people
        order_row(4, order_id="O-4", city="NATION_3", state="EUROPE", postal_code="00003", region="EUROPE"),
        # ship date outside the date range
        order_row(5, order_id="O-5", order_date=D(1998, 12, 30), ship_date=D(1999, 1, 2)),
        # equal only after cleaning: both kept
        order_row(6, order_id="O-6", product_id="P-6", product_name="a  b"),
        order_row(7, order_id="O-6", product_id="P-6", product_name="a b"),
        # zero quantity, zero sales
        order_row(8, order_id="O-8", quantity=0),
        order_row(9, order_id="O-9", sales="0.0000"),
        # discount rounds half up
        order_row(10, order_id="O-10", discount="0.1250"),
        # negative duration with a bad ship mode
        order_row(11, order_id="O-11", order_date=D(1998, 3, 10), ship_date=D(1998, 3, 7), ship_mode="0"),
        # three spaces
        order_row(12, order_id="O-12", product_id="P-12", product_name="x   y"),
        # exact duplicates: lowest row_id kept
        order_row(113, order_id="O-13"),
        order_row(13, order_id="O-13"),
    ]


PEOPLE = [("Rep AMERICA", "AMERICA"), ("Rep A", "EUROPE"), ("Rep B", "EUROPE"), ("Rep AMERICA", "ZZZ")]
RETURNS = [("Yes", "O-2"), ("Yes", "O-2"), (None, "O-8")]


@pytest.fixture(scope="module")
def mixed(spark):
    import tempfile
    bronze = bronze_frames(spark, mixed_orders(), PEOPLE, RETURNS)
    return run_pipeline(spark, bronze, root=tempfile.mkdtemp(prefix="tillroll-mixed-"), rules=RULES,
                        date_range=RANGE)


def test_steps_all_ok(mixed):
    assert all(s.status == "ok" for s in mixed.steps), mixed.steps
    assert [s.step for s in mixed.steps][:3] == ["bronze.orders", "bronze.people", "bronze.returns_order"]


def test_silver_rules(mixed):
    s = {r.row_id: r for r in mixed.silver["orders"].collect()}
    assert 113 not in s and 13 in s                                   # W1 keeps the lowest row_id
    assert s[1].order_date == D(1998, 1, 14) and s[1].ship_mode == "Standard Class"   # G15
    assert 6 in s and 7 in s and s[6].product_name == s[7].product_name == "a b"      # G14
    assert s[10].discount == Decimal("0.13")
    assert s[11].ship_mode == "Same Day"                                # negative duration
    assert s[12].product_name == "x  y"                                 # G10
    assert len(s) == len(mixed_orders()) - 1
    assert list(mixed.silver["orders"].columns) == ORDERS_COLUMNS + ["dw_load_date"]


def test_silver_people_and_returns(mixed):
    people = {r.person_name: r.region for r in mixed.silver["people"].collect()}
    assert people == {"Rep AMERICA": "AMERICA", "Rep A": "EUROPE", "Rep B": "EUROPE"}
    returns = sorted((r.order_id, r.returned) for r in mixed.silver["returns_order"].collect())
    assert returns == [("O-2", "Yes"), ("O-8", None)]


def test_dimensions_and_fan_out(mixed):
    g = mixed.gold
    cust = g.dim_customer.filter("customer_id = 'C-2'").collect()
    assert len(cust) == 2                                            # G4: two segments, two rows
    fact = g.fact_sales
    orders_c2 = fact.filter(F.col("order_id").isin("O-2", "O-3")).count()
    assert orders_c2 == 4                                            # 2 order rows x 2 dim rows
    assert fact.filter("order_id = 'O-4'").count() == 2               # G7: two people in EUROPE
    report = quality.natural_key_report({n: (getattr(g, n), s["join_on"]) for n, s in DIMENSIONS.items()})
    found = {(r.dim_name, r.natural_key) for r in report.collect()}
    assert ("dim_customer", "C-2") in found and ("dim_sales_person", "EUROPE") in found
    keys = [r.customer_key for r in g.dim_customer.orderBy("customer_key").collect()]
    assert keys == list(range(1, len(keys) + 1))


def test_fact_derived_measures(mixed):
    f = {r.order_id: r for r in mixed.gold.fact_sales.collect()}
    assert f["O-5"].ship_date_key is None and f["O-5"].order_date_key == 19981230
    assert f["O-8"].unit_price is None and f["O-9"].profit_margin is None
    assert f["O-10"].discount == Decimal("0.1300")
    assert f["O-11"].days_to_ship == -3
    assert f["O-2"].is_returned == 1 and f["O-8"].is_returned == 1 and f["O-3"].is_returned == 0
    assert f["O-13"].unit_price == Decimal("5.0000")


def test_sales_total_is_equal_across_layers(mixed):
    g = mixed.gold
    fact_total = g.fact_sales.agg(F.sum("sales")).first()[0]
    for name, view in views.VIEWS.items():
        col = "total_spent" if name == "vw_customer_analysis" else ("sales" if name == "vw_sales_summary" else "total_sales")
        total = view(g).agg(F.sum(col)).first()[0]
        assert total == fact_total, name
    overall = measures(g).first()
    assert overall.total_sales == fact_total
    assert overall.total_orders == g.fact_sales.select("order_id").distinct().count()


def test_views_semantics(mixed):
    g = mixed.gold
    ship = {r.ship_mode: r for r in views.shipping_performance(g).collect()}
    assert ship["Same Day"].min_days == -3
    region = {(r.region, r.sales_person): r.total_orders for r in views.regional_performance(g).collect()}
    assert region[("EUROPE", "Rep A")] == 1 and region[("EUROPE", "Rep B")] == 1
    trends = views.monthly_trends(g).collect()
    assert {(r.year, r.month) for r in trends} == {(1998, 1), (1998, 3), (1998, 12)}
    cust = {r.customer_id: r for r in views.customer_analysis(g).collect()}
    assert cust["C-1"].avg_order_value is not None


def test_measures_roles_and_filters(mixed):
    g = mixed.gold
    by_ship = {(r.year, r.month): r.total_orders
               for r in measures(g, by=["year", "month"], date_role="ship", names=["total_orders"]).collect()}
    assert by_ship[(None, None)] == 1                                 # ship date outside the range
    europe = measures(g, where=F.col("region") == "EUROPE", filter_attributes=["region"],
                      names=["total_orders", "total_sales"]).first()
    assert europe.total_orders == 1
    full = measures(g, by=["segment"])
    assert set(full.columns) == {"segment", *MEASURE_NAMES}
    late_all = measures(g, names=["on_time_delivery_pct"], order_rule="all", on_time_max_days=0).first()[0]
    late_any = measures(g, names=["on_time_delivery_pct"], order_rule="any", on_time_max_days=0).first()[0]
    assert late_all <= late_any


def _order_only(spark, **kw):
    return bronze_frames(spark, [order_row(1, **kw)])


def test_unmatched_postal_code_fails_then_quarantines(spark, tmp_root):
    bronze = _order_only(spark, postal_code=None)
    with pytest.raises(DataQualityError):
        run_pipeline(spark, bronze, root=tmp_root, date_range=RANGE)
    wh = run_pipeline(spark, bronze_frames(spark, [order_row(1, postal_code=None), order_row(2, order_id="O-2")]),
                      root=tmp_root, date_range=RANGE, on_unmatched="quarantine")
    assert wh.quarantine.count() == 1 and wh.gold.fact_sales.count() == 1
    assert wh.warnings


def test_order_date_outside_range_fails(spark, tmp_root):
    with pytest.raises(DataQualityError):
        run_pipeline(spark, _order_only(spark, order_date=D(1990, 1, 1), ship_date=D(1990, 1, 2)),
                     root=tmp_root, date_range=RANGE)


def test_discount_overflow_fails_the_silver_step(spark, tmp_root):
    wh = run_pipeline(spark, _order_only(spark, discount="9.9960"), root=tmp_root, date_range=RANGE,
                      on_error="continue")
    status = {s.step: s.status for s in wh.steps}
    assert status["silver.orders"] == "failed"
    assert status["gold.fact_sales"] == "skipped" and wh.gold is None


def test_empty_bronze_gives_empty_layers(spark, tmp_root):
    wh = run_pipeline(spark, bronze_frames(spark, [], [], []), root=tmp_root, date_range=RANGE)
    assert wh.silver["orders"].count() == 0
    assert wh.gold.fact_sales.count() == 0 and wh.gold.dim_customer.count() == 0
    assert wh.gold.dim_date.count() == 365
    for view in views.VIEWS.values():
        assert view(wh.gold).count() == 0


def test_date_dimension_bounds(spark):
    assert dim_date(spark, D(2016, 1, 1), D(2020, 12, 31)).count() == 1827
    one = dim_date(spark, D(2020, 1, 5), D(2020, 1, 1)).collect()
    assert len(one) == 1 and one[0].full_date == D(2020, 1, 5)
    flags = dim_date(spark, D(2016, 1, 1), D(2016, 12, 31)).filter("is_weekend + is_business_day != 1").count()
    assert flags == 0


def test_rebuild_is_idempotent(spark, tmp_root):
    bronze = bronze_frames(spark, mixed_orders(), PEOPLE, RETURNS)
    a = run_pipeline(spark, bronze, root=tmp_root, rules=RULES, date_range=RANGE)
    b = run_pipeline(spark, bronze, root=tmp_root, rules=RULES, date_range=RANGE)
    for name, df in a.gold.tables().items():
        cols = [c for c in df.columns if c not in ("fact_key", "dw_load_date")]
        other = b.gold.tables()[name].select(*cols)
        assert df.select(*cols).exceptAll(other).count() == 0 and other.exceptAll(df.select(*cols)).count() == 0, name


def test_collation_makes_keys_case_and_trailing_blank_insensitive(spark, tmp_root):
    rows = [order_row(1, ship_mode="NULL ", order_date=D(1998, 1, 10), ship_date=D(1998, 1, 10)),
            order_row(2, order_id="O-2", customer_id="c-1 ")]
    binary = run_pipeline(spark, bronze_frames(spark, rows), root=tmp_root, date_range=RANGE)
    folded = run_pipeline(spark, bronze_frames(spark, rows), root=tmp_root, date_range=RANGE,
                          collation="UTF8_LCASE_RTRIM")
    assert binary.gold.dim_customer.count() == 2 and folded.gold.dim_customer.count() == 1
    modes = {r.ship_mode for r in folded.silver["orders"].collect()}
    assert "Same Day" in modes                                   # 'NULL ' counts as 'null'
    assert "NULL " in {r.ship_mode for r in binary.silver["orders"].collect()}
    assert folded.gold.fact_sales.count() == 2


def test_publish_and_reopen(spark, tmp_root):
    from tillroll.plans.pipeline import open_published
    first = run_pipeline(spark, bronze_frames(spark, [order_row(1)]), root=tmp_root, date_range=RANGE, publish=True)
    second = run_pipeline(spark, bronze_frames(spark, [order_row(1), order_row(2, order_id="O-2")]),
                          root=tmp_root, date_range=RANGE, publish=True)
    with pytest.raises(DataQualityError):   # a failing run does not replace the published one
        run_pipeline(spark, _order_only(spark, postal_code=None), root=tmp_root, date_range=RANGE, publish=True)
    gold = open_published(spark, tmp_root)
    assert first.root != second.root
    assert gold.fact_sales.count() == 2 and gold.rows["fact_sales"] == 2
    assert views.monthly_trends(gold).count() == 1


def test_year_filter_prunes_fact_partitions(mixed):
    g = mixed.gold
    assert "order_year" in g.fact_sales.columns
    filtered = views.monthly_trends(g).filter("year = 1998 AND month = 3")
    rows = filtered.collect()
    plan = filtered._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 1 and "dynamicpruning" in plan.lower()
    assert measures(g, by=["year"], where="year = 1998", names=["total_orders"]).count() == 1


def test_required_dimension_columns_and_overlong_text(spark, tmp_root):
    with pytest.raises(DataQualityError, match="dim_product"):
        run_pipeline(spark, _order_only(spark, product_name=None), root=tmp_root, date_range=RANGE)
    wh = run_pipeline(spark, bronze_frames(spark, [order_row(1, product_name=None), order_row(2, order_id="O-2")]),
                      root=tmp_root, date_range=RANGE, on_unmatched="quarantine")
    assert wh.gold.dim_product.filter("product_name IS NULL").count() == 0
    assert wh.quarantine.count() == 1 and wh.gold.fact_sales.count() == 1
    long_name = "x" * 101
    warned = run_pipeline(spark, _order_only(spark, customer_name=long_name), root=tmp_root, date_range=RANGE)
    assert any("customer_name > 100: 1" in w for w in warned.warnings)
    with pytest.raises(DataQualityError, match="longer than declared"):
        run_pipeline(spark, _order_only(spark, customer_name=long_name), root=tmp_root, date_range=RANGE,
                     on_overlong="fail")


def test_failed_landing_skips_dependants(spark, tmp_root):
    bad = bronze_frames(spark, [order_row(1)])
    bad["orders"] = bad["orders"].withColumn("quantity", F.expr("cast('x' as int)"))   # ANSI cast error
    wh = run_pipeline(spark, bad, root=tmp_root, date_range=RANGE, on_error="continue")
    status = {s.step: s.status for s in wh.steps}
    assert status["bronze.orders"] == "failed" and status["bronze.people"] == "ok"
    assert status["silver.orders"] == "skipped" and status["gold.dim_customer"] == "skipped"
    assert status["gold.dim_date"] == "ok" and status["gold.fact_sales"] == "skipped"
    assert wh.step_results(spark).count() == len(wh.steps)


def test_layers_and_views_are_registered_by_name(spark, tmp_root):
    # Names are session-wide: each run points them at its own tables.
    wh = run_pipeline(spark, bronze_frames(spark, mixed_orders(), PEOPLE, RETURNS), root=tmp_root,
                      rules=RULES, date_range=RANGE)
    assert spark.table("bronze_orders").count() == len(mixed_orders())
    assert spark.table("silver_orders").count() == len(mixed_orders()) - 1
    assert spark.sql("SELECT count(*) FROM gold_fact_sales").first()[0] == wh.gold.fact_sales.count()
    assert spark.table("gold_vw_monthly_trends").count() == 3


def test_decimal_and_double_forms_agree(mixed):
    import math
    g = mixed.gold
    cases = {name: (lambda n=name: (views.VIEWS[n](g, "decimal"), views.VIEWS[n](g, "double")))
             for name in views.VIEWS if name != "vw_sales_summary"}
    cases["measures"] = lambda: (measures(g, by=["segment"], numeric="decimal"),
                                 measures(g, by=["segment"], numeric="double"))
    for name, make in cases.items():
        exact, approx = make()
        key = [c for c in exact.columns if dict(exact.dtypes)[c] == "string"]
        a = {tuple(r[k] for k in key): r for r in exact.collect()}
        b = {tuple(r[k] for k in key): r for r in approx.collect()}
        assert a.keys() == b.keys(), name
        for k, row in a.items():
            for c in exact.columns:
                x, y = row[c], b[k][c]
                if x is None or y is None:
                    assert x is None and y is None, (name, c)
                elif not isinstance(x, str):
                    assert math.isclose(float(x), float(y), rel_tol=1e-9, abs_tol=1e-6), (name, c, x, y)


def test_missing_order_id_fails_the_fact(spark, tmp_root):
    with pytest.raises(DataQualityError, match="order_id=1"):
        run_pipeline(spark, _order_only(spark, order_id=None), root=tmp_root, date_range=RANGE)


@pytest.mark.parametrize("by", [[], ["segment"], ["customer_id"], ["region", "ship_mode"], ["year", "month"]])
def test_measures_equal_naive_distinct_counts(mixed, by):
    from tillroll.plans.measures import enriched_fact
    g = mixed.gold
    got = {tuple(r[c] for c in by): r for r in measures(g, by=by, numeric="double").collect()}
    f = enriched_fact(g, [*by, "customer_id"], "order")
    naive = f.groupBy(*by).agg(
        F.countDistinct("order_id").alias("orders"),
        F.countDistinct("customer_id").alias("customers"),
        F.countDistinct(F.when(F.col("is_returned") == 1, F.col("order_id"))).alias("returned"),
        F.countDistinct(F.when(F.col("days_to_ship") <= 5, F.col("order_id"))).alias("on_time"),
        F.sum("sales").cast("double").alias("sales"))
    rows = naive.collect()
    assert len(rows) == len(got)
    for r in rows:
        m = got[tuple(r[c] for c in by)]
        assert (m.total_orders, m.total_customers, m.total_returned) == (r.orders, r.customers, r.returned)
        assert m.on_time_delivery_pct == r.on_time / r.orders and m.total_sales == r.sales


def test_summary_plans_only_the_needed_joins(mixed):
    g = mixed.gold
    full = views.sales_summary(g)
    assert full.columns == views.SUMMARY_COLUMNS
    narrow = views.sales_summary(g, ["order_id", "segment", "sales"])
    assert narrow.exceptAll(full.select("order_id", "segment", "sales")).count() == 0
    assert full.select("order_id", "segment", "sales").exceptAll(narrow).count() == 0
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1


def test_date_range_from_data(spark, tmp_root):
    wh = run_pipeline(spark, bronze_frames(spark, mixed_orders(), PEOPLE, RETURNS), root=tmp_root,
                      rules=RULES, date_range="data")
    assert wh.gold.dim_date.count() == 730                       # 1998 and 1999 (a ship date in 1999)
    assert wh.gold.fact_sales.filter("ship_date_key IS NULL").count() == 0
    empty = run_pipeline(spark, bronze_frames(spark, [], [], []), root=tmp_root, date_range="data")
    assert empty.gold.dim_date.count() == 1827                   # no dates: the default range


def test_filters_and_columns_reach_the_fact_scan(spark, mixed):
    g = mixed.gold
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    q = views.sales_summary(g, ["order_id", "sales"]).filter("order_id = 'O-2'")
    assert q.count() == 2
    plan = q._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "order_id" in line][0]
    assert "EqualTo(order_id,O-2)" in scan                         # pushed to Parquet
    assert "ReadSchema: struct<" in scan and "profit" not in scan.split("ReadSchema:")[1]


def test_measures_scan_the_fact_once(spark):
    from tests.conftest import sf_dir
    from tillroll.plans.registry import warehouse_for

    gold = warehouse_for(spark, sf_dir("0.001")).gold

    def final_plan(df):
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]

    def fact_scans(plan):
        return sum("FileScan parquet" in line and "sales#" in line.split("Batched")[0] for line in plan.splitlines())

    for by in ([], ["segment", "year"], ["category", "sub_category"]):
        assert fact_scans(final_plan(measures(gold, by=by))) == 1
    additive = final_plan(measures(gold, by=["region"], names=["total_sales", "average_discount"]))
    assert fact_scans(additive) == 1 and additive.count("Exchange hashpartitioning") == 1


def test_fact_files_are_narrow_in_the_order_date(spark, tmp_root):
    import glob
    import os

    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from tillroll.sources.sinks import fact_layout, write_table

    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        day = F.date_add(F.lit("1998-01-01").cast("date"), (F.col("id") * 7919 % 730).cast("int"))
        fact = spark.range(0, 20_000, 1, 8).select(
            F.col("id").alias("fact_key"), F.date_format(day, "yyyyMMdd").cast("int").alias("order_date_key"),
            F.concat(F.lit("O-"), F.col("id")).alias("order_id"))
        path = os.path.join(tmp_root, "fact")
        write_table(fact_layout(fact), path, partition_by=["order_year"])
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    files = glob.glob(f"{path}/order_year=*/*.parquet")
    assert 16 <= len(files) <= 16 + 1  # one a range, and one more where a range spans the turn of the year
    for f in files:
        stats = pq.ParquetFile(f).metadata.row_group(0).column(1).statistics
        assert (stats.max // 100 % 100) - (stats.min // 100 % 100) <= 2  # months, of twelve
    assert spark.read.parquet(path).select("fact_key").distinct().count() == 20_000
