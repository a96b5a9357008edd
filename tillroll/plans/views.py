"""The six reporting views (V1-V6).

``numeric='decimal'`` gives the warehouse's types: exact decimal sums,
means and ratios as DECIMAL(38,6), integer means truncated.  ``'double'``
casts the exact sums to DOUBLE first and divides there; it is the form used
for side-by-side comparison with other engines.

Plan choices:
* V2 and V3 aggregate the fact by its surrogate key *before* joining the
  dimension.  A dimension built by DISTINCT maps each key to exactly one
  attribute tuple, so grouping by key equals grouping by the attributes, and
  the (possibly large) dimension meets one row per member instead of every
  fact row.
* V4, V5 and V6 group by attributes several keys share, so the distinct
  order count needs the attributes first; their dimensions (locations, ship
  modes, days) are small and are broadcast when their size is proven.
* Every COUNT(DISTINCT order_id) is planned by Spark as an aggregate on
  (group, order_id) first, so a group holding a third of all rows is spread
  over many tasks by its orders.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.arithmetic import RESULT_DECIMAL, int_mean
from tillroll.operators.lookup import fits_broadcast, lookup, order_date_lookup
from tillroll.operators.quality import any_null
from tillroll.plans.gold import Gold


def _sum(name: str, numeric: str) -> Column:
    s = F.sum(name)
    return s.cast("double") if numeric == "double" else s


def _mean(name: str, numeric: str) -> Column:
    if numeric == "double":
        return F.sum(name).cast("double") / F.nullif(F.count(name), F.lit(0))
    return (F.sum(name) / F.nullif(F.count(name), F.lit(0))).cast(RESULT_DECIMAL)


def _ratio(num: Column, den: Column, numeric: str, scale: float = 1.0) -> Column:
    """Num / NULLIF(den, 0) * scale."""
    out = num / F.nullif(den, F.lit(0))
    if scale != 1.0:
        out = out * F.lit(scale) if numeric == "double" else out * F.lit(int(scale))
    return out if numeric == "double" else out.cast(RESULT_DECIMAL)


def _returns() -> Column:
    return F.sum(F.col("is_returned").cast("int")).alias("total_returns")  # A6


SUMMARY_COLUMNS = [
    "full_date", "year", "quarter_name", "month_name", "month_year_label", "day_name",
    "is_weekend", "is_business_day", "season", "customer_id", "customer_name", "segment",
    "product_id", "product_name", "category", "sub_category", "city", "state", "region",
    "ship_mode", "sales_person", "order_id", "sales", "quantity", "discount", "profit",
    "unit_price", "profit_margin", "days_to_ship", "is_returned"]
_DATE_ATTRS = SUMMARY_COLUMNS[:9]
_CUSTOMER_ATTRS = ["customer_id", "customer_name", "segment"]
_PRODUCT_ATTRS = ["product_id", "product_name", "category", "sub_category"]
_LOCATION_ATTRS = ["city", "state", "region"]


def sales_summary(gold: Gold, columns: list[str] | None = None) -> DataFrame:
    """V1: the row-level star join (30 columns, or the ``columns`` asked for).

    Only the dimensions that provide requested columns are joined.  An inner
    join that is left out becomes ``key IS NOT NULL``: the fact's keys come
    from the dimensions' unique keys, so that is the row set the join keeps.
    """
    cols = list(columns or SUMMARY_COLUMNS)
    wanted = set(cols)
    rows = gold.rows
    f = gold.fact_sales
    # Dimensions that grow with the input come first: where they are too large to broadcast, the rows that move are
    # narrow, and the bounded ones add their texts afterwards.
    for key, dim_name, attrs in [("customer_key", "dim_customer", _CUSTOMER_ATTRS),
                                 ("product_key", "dim_product", _PRODUCT_ATTRS),
                                 ("location_key", "dim_location", _LOCATION_ATTRS)]:
        needed = [c for c in attrs if c in wanted]
        if needed:
            dim = getattr(gold, dim_name).select(key, *needed)
            f = lookup(f, dim, [key], "inner", rows.get(dim_name))
        else:
            f = f.filter(F.col(key).isNotNull())
    date_cols = [c for c in _DATE_ATTRS if c in wanted]
    if date_cols:
        f = order_date_lookup(f, gold.dim_date, date_cols, "inner", rows.get("dim_date"))
    else:
        f = f.filter(F.col("order_date_key").isNotNull())
    if "ship_mode" in wanted:
        f = lookup(f, gold.dim_ship_mode, ["ship_mode_key"], "left", rows.get("dim_ship_mode"))
    if "sales_person" in wanted:
        f = lookup(f, gold.dim_sales_person.select("sales_person_key", F.col("person_name").alias("sales_person")),
                   ["sales_person_key"], "left", rows.get("dim_sales_person"))
    return f.select(*cols)


def first_orders(gold: Gold, n: int) -> Gold:
    """``gold`` with the fact's rows that can be among the first ``n`` of the summary under any order that starts with the order id.

    Those are the rows of the orders that hold the n lowest order ids, NULL
    first, among the rows that the summary's joins keep.  Dimensions keep the
    members that these rows have, of which there are at most as many as rows;
    so the joins meet n rows and the lines of their orders, not the fact.
    """
    fact = gold.fact_sales.filter(~any_null(["order_date_key", "customer_key", "product_key", "location_key"]))
    last = fact.select("order_id").orderBy(F.col("order_id").asc_nulls_first()).limit(n).agg(F.max("order_id").alias("last"))
    # No value: the n first ids are all missing, or there are no rows.
    last = last.first()["last"]
    kept = fact.filter(F.col("order_id").isNull() if last is None else F.col("order_id").isNull() | (F.col("order_id") <= F.lit(last)))
    n_kept = kept.count()
    changed, rows = {"fact_sales": kept}, {**gold.rows, "fact_sales": n_kept}
    for key, name in (("customer_key", "dim_customer"), ("product_key", "dim_product")):
        members = kept.select(key).distinct()
        if fits_broadcast(members, n_kept):
            changed[name] = getattr(gold, name).join(F.broadcast(members), key, "left_semi")
            rows[name] = min(n_kept, gold.rows.get(name, n_kept))
    return replace(gold, rows=rows, **changed)


def product_performance(gold: Gold, numeric: str = "decimal") -> DataFrame:
    """V2: per product."""
    per_key = gold.fact_sales.groupBy("product_key").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.sum("sales").alias("_sales"),
        F.sum("profit").alias("_profit"),
        F.sum("quantity").cast("long").alias("total_units"),
        _mean("discount", numeric).alias("avg_discount"),
        _mean("unit_price", numeric).alias("avg_unit_price"),
        _returns(),
    )
    j = lookup(per_key, gold.dim_product, ["product_key"], "inner", gold.rows.get("dim_product"))
    sales = F.col("_sales").cast("double") if numeric == "double" else F.col("_sales")
    profit = F.col("_profit").cast("double") if numeric == "double" else F.col("_profit")
    return j.select(
        "product_id", "product_name", "category", "sub_category", "total_orders",
        sales.alias("total_sales"), profit.alias("total_profit"), "total_units",
        "avg_discount", "avg_unit_price",
        _ratio(profit, sales, numeric, 100.0).alias("profit_margin_pct"),
        "total_returns")


def customer_analysis(gold: Gold, numeric: str = "decimal") -> DataFrame:
    """V3: per customer; avg_order_value is the mean sales per *line*."""
    per_key = gold.fact_sales.groupBy("customer_key").agg(
        F.countDistinct("order_id").alias("total_orders"),
        _sum("sales", numeric).alias("total_spent"),
        _sum("profit", numeric).alias("total_profit"),
        _mean("sales", numeric).alias("avg_order_value"),
        F.sum("quantity").cast("long").alias("total_units"),
        _returns(),
    )
    j = lookup(per_key, gold.dim_customer, ["customer_key"], "inner", gold.rows.get("dim_customer"))
    return j.select("customer_id", "customer_name", "segment", "total_orders", "total_spent",
                    "total_profit", "avg_order_value", "total_units", "total_returns")


def regional_performance(gold: Gold, numeric: str = "decimal") -> DataFrame:
    """V4: per region, state, city and sales person (NULL person is a group)."""
    f = lookup(gold.fact_sales, gold.dim_location.select("location_key", "region", "state", "city"),
               ["location_key"], "inner", gold.rows.get("dim_location"))
    f = lookup(f, gold.dim_sales_person.select("sales_person_key", F.col("person_name").alias("sales_person")),
               ["sales_person_key"], "left", gold.rows.get("dim_sales_person"))
    return f.groupBy("region", "state", "city", "sales_person").agg(
        F.countDistinct("order_id").alias("total_orders"),
        _sum("sales", numeric).alias("total_sales"),
        _sum("profit", numeric).alias("total_profit"),
        F.sum("quantity").cast("long").alias("total_units"),
        int_mean("days_to_ship").cast("long").alias("avg_shipping_days"),
        _returns(),
    )


def shipping_performance(gold: Gold, numeric: str = "decimal") -> DataFrame:
    """V5: per ship mode; rows without a mode form the NULL group."""
    f = lookup(gold.fact_sales, gold.dim_ship_mode, ["ship_mode_key"], "left",
               gold.rows.get("dim_ship_mode"))
    return f.groupBy("ship_mode").agg(
        F.countDistinct("order_id").alias("total_orders"),
        int_mean("days_to_ship").cast("long").alias("avg_days_to_ship"),
        F.min("days_to_ship").alias("min_days"),
        F.max("days_to_ship").alias("max_days"),
        _sum("sales", numeric).alias("total_sales"),
        _returns(),
    )


def monthly_trends(gold: Gold, numeric: str = "decimal") -> DataFrame:
    """V6: per calendar month of the order date."""
    f = order_date_lookup(gold.fact_sales, gold.dim_date,
                          ["year", "month", "month_name", "month_year_label", "quarter_name", "season"],
                          "inner", gold.rows.get("dim_date"))
    g = f.groupBy("year", "month", "month_name", "month_year_label", "quarter_name", "season").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.sum("sales").alias("_sales"),
        _sum("profit", numeric).alias("total_profit"),
        F.sum("quantity").cast("long").alias("total_units"),
        _returns(),
    )
    sales = F.col("_sales").cast("double") if numeric == "double" else F.col("_sales")
    return g.select(
        "year", "month", "month_name", "month_year_label", "quarter_name", "season",
        "total_orders", sales.alias("total_sales"), "total_profit", "total_units", "total_returns",
        _ratio(sales, F.col("total_orders"), numeric).alias("avg_order_value"))


VIEWS = {
    "vw_sales_summary": lambda gold, numeric="decimal": sales_summary(gold),
    "vw_product_performance": product_performance,
    "vw_customer_analysis": customer_analysis,
    "vw_regional_performance": regional_performance,
    "vw_shipping_performance": shipping_performance,
    "vw_monthly_trends": monthly_trends,
}
