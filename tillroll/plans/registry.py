"""Named queries over the driver tables, one per inventory item group.

Every query runs on whole tables: the driver tables are mapped to the
landing tables by :mod:`tillroll.sources.adapter`, the pipeline writes each
layer once per (application, input folder) into the shared checkpoint
folder, and each query is a DataFrame over those written layers.

Outputs are passed through :func:`comparable` (DATE as ISO text, DECIMAL as
DOUBLE) so they can be compared value for value with another engine.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import cleaning
from tillroll.operators.keys import dense_key, ranges_for
from tillroll.operators import quality
from tillroll.operators import rules as rule_suite
from tillroll.operators.rules import ForeignKey, InRange, MaxLength, NotNull, Unique
from tillroll.plans import silver as silver_plan
from tillroll.plans import views
from tillroll.plans import lattice as lattice_plan
from tillroll.plans.measures import measures
from tillroll.plans.refresh import refresh
from tillroll.plans.pipeline import Warehouse, default_root, index_fact, publish_names, run_pipeline
from tillroll.plans.gold import dimension
from tillroll.schemas import DIMENSIONS, FACT_COLUMNS, FACT_REQUIRED_KEYS, ORDERS_COLUMNS, TEXT_LENGTHS
from tillroll.sources.layout import read_where
from tillroll.sources.sinks import write_table
from tillroll.sources.profile import describe_checked, profile
from tillroll.sources.readers import read_landing, split_tagged, to_be_split, tolerant_tagged
from tillroll.sources.adapter import FIXTURE_RULES, bronze_tables

_LOCK = threading.Lock()
_CACHE: dict[tuple[str, str], Warehouse] = {}


def comparable(df: DataFrame) -> DataFrame:
    """DATE -> ISO text, DECIMAL -> DOUBLE; other columns unchanged."""
    cols = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        cols.append(c.alias(field.name))
    return df.select(*cols)


def warehouse_for(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Build (once per application and input folder) the full warehouse."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LOCK:
        wh = _CACHE.get(key)
        if wh is None:
            # The date range spans the data's years (1995-2001 for the driver
            # tables, the range the fixture prescribes), so the date dimension
            # too is derived from the given tables.
            # Rows without a location are planted, and set aside.
            wh = run_pipeline(spark, bronze_tables(spark, sf_dir), rules=FIXTURE_RULES, date_range="data",
                              on_unmatched="quarantine", register_views=False)
            _CACHE[key] = wh
        return wh


def _silver_orders(wh: Warehouse) -> DataFrame:
    return wh.silver["orders"].select(*ORDERS_COLUMNS)


def q_bronze_orders(spark, sf_dir):
    """The landed order lines with their declared types."""
    return comparable(warehouse_for(spark, sf_dir).bronze["orders"].select(*ORDERS_COLUMNS))


def q_silver_orders_clean(spark, sf_dir):
    """The cleaned, deduplicated order lines."""
    return comparable(_silver_orders(warehouse_for(spark, sf_dir)))


def q_silver_orders_dedup_exact(spark, sf_dir):
    """Surviving lines of the exact dedup with the number of copies merged; the landed table is stored, so only possible copies move whole."""
    wh = warehouse_for(spark, sf_dir)
    return silver_plan.dedup_orders(wh.bronze["orders"], count_as="n_copies", by_digest=True).select(
        "row_id", "order_id", "n_copies")


def q_silver_orders_dedup_digest(spark, sf_dir):
    """The same, with only the rows moved whole whose digest repeats."""
    wh = warehouse_for(spark, sf_dir)
    return silver_plan.dedup_orders(wh.bronze["orders"], count_as="n_copies", by_digest=True).select(
        "row_id", "order_id", "n_copies")


def q_silver_people_first(spark, sf_dir):
    """One region per person (lowest, NULL first)."""
    return warehouse_for(spark, sf_dir).silver["people"].select("person_name", "region")


def q_silver_returns_first(spark, sf_dir):
    """One return record per order."""
    return warehouse_for(spark, sf_dir).silver["returns_order"].select("returned", "order_id")


def q_ship_mode_repair(spark, sf_dir):
    """Raw ship mode and duration against the repaired ship mode, counted."""
    wh = warehouse_for(spark, sf_dir)
    d = silver_plan.dedup_orders(wh.bronze["orders"], by_digest=True)
    c = F.col
    return d.groupBy(
        c("ship_mode").alias("raw_ship_mode"),
        F.datediff(c("ship_date"), c("order_date")).alias("raw_days_to_ship"),
        cleaning.ship_mode(c("ship_mode"), c("order_date"), c("ship_date"), FIXTURE_RULES).alias("ship_mode"),
    ).agg(F.count(F.lit(1)).alias("n_rows"))


def q_dim_date(spark, sf_dir):
    """The date dimension over the data's years."""
    return comparable(warehouse_for(spark, sf_dir).gold.dim_date)


def _dim_query(name: str):
    def run(spark, sf_dir):
        return getattr(warehouse_for(spark, sf_dir).gold, name)
    run.__name__ = f"q_{name}"
    run.__doc__ = f"A7, A17: {name} with its dense surrogate key."
    return run


def q_dim_product_refreshed(spark, sf_dir):
    """The product dimension, first of the lines of one half of the orders, then brought up to all of them."""
    orders = _silver_orders(warehouse_for(spark, sf_dir))
    spec, path = DIMENSIONS["dim_product"], f"{default_root(spark)}/_dimensions/{uuid.uuid4().hex}"
    refresh(orders.where(F.crc32("order_id") % 2 == 0), spec["columns"], spec["key"], path)
    return refresh(orders, spec["columns"], spec["key"], path).rows


def q_fact_sales(spark, sf_dir):
    """The fact (the unordered fact_key left out)."""
    fact = warehouse_for(spark, sf_dir).gold.fact_sales
    return comparable(fact.select(*[c for c in FACT_COLUMNS if c != "fact_key"]))


def _named_view_query(name: str):
    def run(spark, sf_dir):
        wh = warehouse_for(spark, sf_dir)
        publish_names(spark, wh)
        return comparable(spark.sql(f"SELECT * FROM gold.{name}"))
    run.__name__ = f"q_{name}_by_name"
    run.__doc__ = f"S13, V1-V6: SELECT * FROM gold.{name}, in the warehouse's decimal form."
    return run


def _fact_by_query(key: str):
    def run(spark, sf_dir):
        wh = warehouse_for(spark, sf_dir)
        with _LOCK:
            layouts = index_fact(spark, wh)
        busiest = wh.gold.fact_sales.groupBy(key).count().orderBy(F.col("count").desc(), key).first()
        rows = read_where(spark, layouts, {key: [busiest[key]] if busiest else []})
        return comparable(rows.select(*[c for c in FACT_COLUMNS if c != "fact_key"]))
    run.__name__ = f"q_fact_by_{key}"
    run.__doc__ = f"S17: the fact rows of the member of {key} with the most rows, from the files that can hold it."
    return run


def q_fact_by_month(spark, sf_dir):
    """The fact rows of the last month that has any, from the files that can hold it."""
    wh = warehouse_for(spark, sf_dir)
    with _LOCK:
        layouts = index_fact(spark, wh)
    last = (wh.gold.fact_sales.agg(F.max("order_date_key").alias("k")).first()["k"] or 0) // 100
    rows = read_where(spark, layouts, {"order_date_key": (last * 100, last * 100 + 99)})
    return comparable(rows.select(*[c for c in FACT_COLUMNS if c != "fact_key"]))


def q_fact_quarantine(spark, sf_dir):
    """Q1: the fact rows set aside because a required key is missing."""
    rows = warehouse_for(spark, sf_dir).quarantine
    return comparable(rows.select(*[c for c in FACT_COLUMNS if c != "fact_key"]))


def q_dense_key_payload(spark, sf_dir):
    """Silver lines numbered by some columns with all others kept."""
    order = ["order_id", "row_id", "product_id", "ship_date", "sales", "quantity", "discount"]
    wh = warehouse_for(spark, sf_dir)
    n = next((s.rows for s in wh.steps if s.step == "silver.orders"), None)
    return comparable(dense_key(_silver_orders(wh), order, "line_key", ranges_for(spark, n)))


#: Lines of a landing file, about 200 bytes each.
LINES_PER_FILE = 250_000


def q_landing_csv(spark, sf_dir):
    """Order lines written as CSV, with commas, quotes and line breaks in a column, and landed again."""
    lines = warehouse_for(spark, sf_dir).bronze["orders"].select(*ORDERS_COLUMNS).withColumn(
        "product_name", F.concat("product_name", F.lit(', 8"\nnew')))
    path = f"{default_root(spark)}/_landing_csv/{uuid.uuid4().hex}"
    # A file of quoted line breaks is one task's.
    lines.write.options(header="true", quote='"', escape='"', nullValue="", emptyValue="", maxRecordsPerFile=LINES_PER_FILE).csv(path)
    return comparable(read_landing(spark, "orders", path, multiline=True))


#: Faults planted in a landing file, by order number (row_id div 1000) modulo 50: values that cannot be typed, one of them only too wide.
FAULTS = {1: {"quantity": "many"}, 2: {"ship_date": "1998-13-45"}, 3: {"discount": "12.5"}, 4: {"sales": "1.2.3", "quantity": "2.5x"}}


def _tolerant(spark, sf_dir):
    """The landed order lines written as CSV with planted faults and read tolerantly, once, to a written copy."""
    lines = warehouse_for(spark, sf_dir).bronze["orders"].select(*ORDERS_COLUMNS)

    def text(column: str):
        out = F.col(column).cast("string")
        for k, faults in FAULTS.items():
            if column in faults:
                out = F.when(F.expr("row_id div 1000") % 50 == k, F.lit(faults[column])).otherwise(out)
        return out.alias(column)
    path = f"{default_root(spark)}/_landing_csv/{uuid.uuid4().hex}"
    # Packed, a file is one task's.
    lines.select(*[text(c) for c in ORDERS_COLUMNS]).write.options(
        header="true", quote='"', escape='"', nullValue="", emptyValue="", maxRecordsPerFile=LINES_PER_FILE, compression="gzip").csv(f"{path}/in")
    tagged = to_be_split(tolerant_tagged(spark, "orders", f"{path}/in"), "orders")
    write_table(tagged, f"{path}/tagged", compression="zstd")
    return split_tagged(spark.read.schema(tagged.schema).parquet(f"{path}/tagged"), "orders")


def q_landing_tolerant_good(spark, sf_dir):
    """The rows of a faulty landing file that can be typed."""
    return comparable(_tolerant(spark, sf_dir)[0])


def q_landing_tolerant_rejected(spark, sf_dir):
    """The rows of a faulty landing file that cannot be typed, as text, with the columns that fail."""
    return _tolerant(spark, sf_dir)[1].select("row_id", "order_id", "quantity", "ship_date", "discount", "sales", "failed_columns")


def q_step_results(spark, sf_dir):
    """Each step of the build with its status and rows written."""
    return warehouse_for(spark, sf_dir).step_results(spark).drop("seconds")


def q_monthly_trends_ordered(spark, sf_dir):
    """O2: the monthly report's rows numbered in report order."""
    trends = views.monthly_trends(warehouse_for(spark, sf_dir).gold, "double").select("year", "month", "total_orders")
    return dense_key(trends, ["year", "month"], "row_no")


def _view_query(name: str):
    def run(spark, sf_dir):
        gold = warehouse_for(spark, sf_dir).gold
        if name == "vw_sales_summary":
            return comparable(views.sales_summary(gold))
        return views.VIEWS[name](gold, "double")
    run.__name__ = f"q_{name}"
    run.__doc__ = f"V1-V6: the {name} view over the built warehouse."
    return run


def q_measures_overall(spark, sf_dir):
    """M1-M15 over the whole fact."""
    return measures(warehouse_for(spark, sf_dir).gold, numeric="double")


def q_measures_by_segment_year(spark, sf_dir):
    """M1-M15 by customer segment and order year."""
    return measures(warehouse_for(spark, sf_dir).gold, by=["segment", "year"], numeric="double")


def q_measures_by_ship_month(spark, sf_dir):
    """M1-M15 by ship year and month (J15: the ship-date role)."""
    return measures(warehouse_for(spark, sf_dir).gold, by=["year", "month"], date_role="ship",
                    numeric="double")


def q_measures_by_category(spark, sf_dir):
    """Measures as a product page groups them (product relationship)."""
    return measures(warehouse_for(spark, sf_dir).gold, by=["category", "sub_category"], numeric="double")


def q_measures_by_region_ship_mode(spark, sf_dir):
    """Measures as an operations page groups them (location and ship-mode relationships)."""
    return measures(warehouse_for(spark, sf_dir).gold, by=["region", "ship_mode"], numeric="double")


def q_measures_on_time_all_lines(spark, sf_dir):
    """On-time share where an order counts only when every line shipped in time (M14 option)."""
    return measures(warehouse_for(spark, sf_dir).gold, by=["ship_mode"], order_rule="all",
                    names=["total_orders", "on_time_delivery_pct"], numeric="double")


def q_measures_additive(spark, sf_dir):
    """Additive measures alone: one exchange, no orders."""
    return measures(warehouse_for(spark, sf_dir).gold, by=["region"], names=["total_sales", "total_quantity", "average_discount"],
                    numeric="double")


#: The groupings that are stored, and the eight of one report.
STORED = [["product_id", "product_name", "category", "sub_category"], ["customer_id", "customer_name", "segment", "year"],
          ["region", "state", "city", "sales_person", "ship_mode"],
          ["year", "month", "month_name", "month_year_label", "quarter_name", "season", "ship_mode"]]
REPORT = [[], ["segment", "year"], ["year", "month"], ["category", "sub_category"], ["region", "ship_mode"], ["ship_mode"],
          ["region", "state", "city", "sales_person"], ["season"]]
#: The groupings of the views V2 to V6.
VIEW_GROUPS = {"vw_product_performance": STORED[0], "vw_customer_analysis": STORED[1][:3], "vw_regional_performance": STORED[2][:4],
               "vw_shipping_performance": ["ship_mode"], "vw_monthly_trends": STORED[3][:6]}


def lattice_for(spark, sf_dir):
    """The stored aggregates of a warehouse, built once per run."""
    wh = warehouse_for(spark, sf_dir)
    with _LOCK:
        if wh.lattice is None:
            wh.lattice = lattice_plan.build(wh.gold, STORED, f"{wh.root}/lattice")
    return wh.lattice


def q_measures_lattice(spark, sf_dir):
    """M1-M15 by eight groupings at once, from stored aggregates made in one pass over the fact."""
    return lattice_plan.report(lattice_for(spark, sf_dir), REPORT, numeric="double")


def q_lattice_order_counts(spark, sf_dir):
    """A2: the order counts of V2-V6, exact, from stored sets instead of the fact's lines."""
    found = lattice_for(spark, sf_dir)
    parts = []
    for name, by in VIEW_GROUPS.items():
        texts = [F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in by]
        parts.append(lattice_plan.answer(found, by, ["total_orders"]).select(
            F.lit(name).alias("view_name"), F.concat_ws("|", *texts).alias("group_key"), "total_orders"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def q_dq_unmatched_keys(spark, sf_dir):
    """Q1: fact rows, set-aside ones included, whose required dimension keys are missing."""
    wh = warehouse_for(spark, sf_dir)
    keys = wh.gold.fact_sales.select(*FACT_REQUIRED_KEYS).unionByName(wh.quarantine.select(*FACT_REQUIRED_KEYS))
    return quality.unmatched_keys(keys, FACT_REQUIRED_KEYS)


def q_dq_optional_keys(spark, sf_dir):
    """Fact rows without a ship date, ship mode or sales person (allowed, reported)."""
    return quality.unmatched_keys(warehouse_for(spark, sf_dir).gold.fact_sales,
                                  ["ship_date_key", "ship_mode_key", "sales_person_key"])


def q_dq_duplicate_natural_keys(spark, sf_dir):
    """Q6: dimension members sharing the key the fact joins on."""
    gold = warehouse_for(spark, sf_dir).gold
    return quality.natural_key_report(
        {name: (getattr(gold, name), spec["join_on"]) for name, spec in DIMENSIONS.items()})


def q_row_counts(spark, sf_dir):
    """Rows per table in every layer."""
    wh = warehouse_for(spark, sf_dir)
    tables = {f"bronze_{n}": df for n, df in wh.bronze.items()}
    tables.update({f"silver_{n}": df for n, df in wh.silver.items()})
    tables.update(wh.gold.tables())
    return quality.row_counts(tables)


SUMMARY_ORDER = ["order_id", "product_id", "full_date", "customer_id", "customer_name", "segment",
                 "product_name", "category", "sub_category", "city", "state", "region", "ship_mode",
                 "sales_person", "sales", "quantity", "discount", "profit", "unit_price",
                 "profit_margin", "days_to_ship", "is_returned", "year", "quarter_name", "month_name",
                 "month_year_label", "day_name", "is_weekend", "is_business_day", "season"]


def q_top_n_summary(spark, sf_dir, n: int = 10):
    """O3: first n rows of the summary view under a total order (the limit is the feature)."""
    summary = comparable(views.sales_summary(views.first_orders(warehouse_for(spark, sf_dir).gold, n)))
    return summary.orderBy(*[F.col(c).asc_nulls_first() for c in SUMMARY_ORDER]).limit(n)


def q_dq_key_uniqueness(spark, sf_dir):
    """Q3: per gold table, the number of primary-key values used more than once; and of silver's row_id, which is no key."""
    wh = warehouse_for(spark, sf_dir)
    keys = {"dim_date": "date_key", **{n: s["key"] for n, s in DIMENSIONS.items()}, "silver_orders": "row_id"}
    tables = {**wh.gold.tables(), "silver_orders": wh.silver["orders"]}
    parts = [quality.duplicate_keys(tables[n], [k]).agg(F.count(F.lit(1)).alias("n_duplicate_keys"))
               .select(F.lit(n).alias("table_name"), F.lit(k).alias("key_column"), "n_duplicate_keys")
             for n, k in keys.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def q_dq_text_lengths(spark, sf_dir):
    """Q5: landing values longer than their declared VARCHAR length."""
    return quality.text_length_violations(warehouse_for(spark, sf_dir).bronze["orders"], TEXT_LENGTHS["orders"])


def q_profile_silver_orders(spark, sf_dir):
    """Per column type, NULLs, min and max of the cleaned orders."""
    return profile(_silver_orders(warehouse_for(spark, sf_dir)))


def _dimension_keys() -> list:
    return [ForeignKey((spec["key"],), name, (spec["key"],)) for name, spec in DIMENSIONS.items()]


#: The warehouse's rules: of the landing table, of silver against its side tables, and of the gold layer's keys.
WAREHOUSE_RULES = {
    "bronze_orders": [NotNull("row_id"), NotNull("order_id"), Unique(("row_id",)), InRange("quantity", 1), InRange("discount", 0, 1), InRange("sales", 0),
                      *[MaxLength(c, n) for c, n in TEXT_LENGTHS["orders"].items()]],
    "silver_orders": [NotNull("postal_code"), ForeignKey(("region",), "silver_people", ("region",)), InRange("discount", None, 1)],
    "silver_returns_order": [Unique(("order_id",)), NotNull("returned"), ForeignKey(("order_id",), "silver_orders", ("order_id",))],
    "fact_sales": [*[NotNull(c) for c in FACT_REQUIRED_KEYS], NotNull("ship_mode_key"), Unique(("fact_key",)), *_dimension_keys(),
                   ForeignKey(("order_date_key",), "dim_date", ("date_key",)), ForeignKey(("ship_date_key",), "dim_date", ("date_key",))],
    **{name: [Unique((spec["key"],)), Unique(tuple(spec["join_on"])), *[NotNull(c) for c in spec["required"]]] for name, spec in DIMENSIONS.items()},
}


def _rule_tables(wh: Warehouse) -> tuple[dict, dict]:
    tables = {f"bronze_{n}": df for n, df in wh.bronze.items()}
    tables.update({f"silver_{n}": df for n, df in wh.silver.items()})
    tables.update(wh.gold.tables())
    return tables, wh.gold.rows


def q_dq_rules(spark, sf_dir):
    """Q1-Q6 as one suite: rows that fail, per declared rule."""
    tables, rows = _rule_tables(warehouse_for(spark, sf_dir))
    return rule_suite.check(WAREHOUSE_RULES, tables, rows)


def q_dq_failing_rows(spark, sf_dir):
    """Q1-Q6: the landing rows and the returns that fail a rule, each once per rule."""
    tables, rows = _rule_tables(warehouse_for(spark, sf_dir))
    parts = []
    for name in ("bronze_orders", "silver_returns_order"):
        found = rule_suite.failing_rows(WAREHOUSE_RULES, tables, name, rows)
        row_id = F.col("row_id") if "row_id" in found.columns else F.lit(None).cast("long")
        parts.append(found.select(F.lit(name).alias("table_name"), "rule", "order_id", row_id.alias("row_id")))
    return parts[0].unionByName(parts[1])


def q_profile_sketches(spark, sf_dir):
    """Mean and deviation of the cleaned orders, and whether the sketched quartiles and distinct counts keep their bounds."""
    found = describe_checked(_silver_orders(warehouse_for(spark, sf_dir)))
    return found.withColumn("mean", F.round("mean", 6)).withColumn("stddev", F.round("stddev", 4))


def q_measures_filtered(spark, sf_dir):
    """Measures under a report filter on an attribute not grouped by."""
    return measures(warehouse_for(spark, sf_dir).gold, by=["ship_mode"], where=F.col("region") == "ASIA",
                    filter_attributes=["region"], numeric="double")


def q_dim_customer_first(spark, sf_dir):
    """G4 option: one customer row per customer_id (lowest name, then segment)."""
    return dimension(_silver_orders(warehouse_for(spark, sf_dir)), "dim_customer", dedupe="first")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "bronze_orders": q_bronze_orders,
        "silver_orders_clean": q_silver_orders_clean,
        "silver_orders_dedup_exact": q_silver_orders_dedup_exact,
        "silver_orders_dedup_digest": q_silver_orders_dedup_digest,
        "silver_people_first": q_silver_people_first,
        "silver_returns_first": q_silver_returns_first,
        "ship_mode_repair": q_ship_mode_repair,
        "dim_date": q_dim_date,
        "fact_quarantine": q_fact_quarantine,
        "dense_key_payload": q_dense_key_payload,
        "landing_csv": q_landing_csv,
        "measures_additive": q_measures_additive,
        "landing_tolerant_good": q_landing_tolerant_good,
        "landing_tolerant_rejected": q_landing_tolerant_rejected,
        "step_results": q_step_results,
        "monthly_trends_ordered": q_monthly_trends_ordered,
    }
    for name in ["dim_customer", "dim_product", "dim_location", "dim_ship_mode", "dim_sales_person"]:
        q[name] = _dim_query(name)
    q["dim_product_refreshed"] = q_dim_product_refreshed
    q["fact_sales"] = q_fact_sales
    for name in ("customer", "product", "location", "ship_date"):
        q[f"fact_by_{name}"] = _fact_by_query(f"{name}_key")
    q["fact_by_month"] = q_fact_by_month
    for name in views.VIEWS:
        q["view_" + name[len("vw_"):]] = _view_query(name)
        q[name] = _named_view_query(name)
    q.update({
        "measures_overall": q_measures_overall,
        "measures_by_segment_year": q_measures_by_segment_year,
        "measures_by_ship_month": q_measures_by_ship_month,
        "measures_by_category": q_measures_by_category,
        "measures_by_region_ship_mode": q_measures_by_region_ship_mode,
        "measures_on_time_all_lines": q_measures_on_time_all_lines,
        "measures_lattice": q_measures_lattice,
        "lattice_order_counts": q_lattice_order_counts,
        "dq_unmatched_keys": q_dq_unmatched_keys,
        "dq_optional_keys": q_dq_optional_keys,
        "dq_duplicate_natural_keys": q_dq_duplicate_natural_keys,
        "row_counts": q_row_counts,
        "top_n_summary": q_top_n_summary,
        "dq_key_uniqueness": q_dq_key_uniqueness,
        "dq_text_lengths": q_dq_text_lengths,
        "profile_silver_orders": q_profile_silver_orders,
        "profile_sketches": q_profile_sketches,
        "dq_rules": q_dq_rules,
        "dq_failing_rows": q_dq_failing_rows,
        "measures_filtered": q_measures_filtered,
        "dim_customer_first": q_dim_customer_first,
    })
    return q


def q_view_flagship(spark, sf_dir):
    """The flagship: V6 monthly trends over the whole build, in report order (O2)."""
    return views.monthly_trends(warehouse_for(spark, sf_dir).gold, "double").orderBy("year", "month")
