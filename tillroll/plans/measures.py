"""The fifteen business measures (M1-M15), groupable by any attribute.

The model's relationships (J16) are declared once in :data:`RELATIONSHIPS`;
:func:`measures` joins only the dimensions that ``by``, ``where`` or the
requested measures reference, so unneeded joins are never planned.  The
date dimension plays two roles (J15): ``date_role='order'`` uses the order
date key, ``'ship'`` the ship date key.  Joins are left joins, so fact rows
without a member fall into a NULL group rather than disappearing.

The fact's values are scanned once per call, whatever the measures; the counts
of orders and of customers scan its keys once more each.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.arithmetic import RESULT_DECIMAL
from tillroll.operators.lookup import fits_broadcast, lookup, order_date_lookup
from tillroll.plans.gold import Gold
from tillroll.rules import ON_TIME_MAX_DAYS

# fact key -> (dimension, {dimension column: exposed attribute name})
RELATIONSHIPS = {
    "customer_key": ("dim_customer", {"customer_id": "customer_id", "customer_name": "customer_name",
                                      "segment": "segment"}),
    "product_key": ("dim_product", {"product_id": "product_id", "product_name": "product_name",
                                    "category": "category", "sub_category": "sub_category"}),
    "location_key": ("dim_location", {"city": "city", "state": "state", "postal_code": "postal_code",
                                      "region": "region"}),
    "ship_mode_key": ("dim_ship_mode", {"ship_mode": "ship_mode"}),
    "sales_person_key": ("dim_sales_person", {"person_name": "sales_person",
                                              "region": "sales_person_region"}),
}
DATE_ATTRIBUTES = ["full_date", "year", "quarter_name", "month", "month_name", "month_short",
                   "month_year_label", "week_of_year", "day_of_month", "day_of_week", "day_name",
                   "day_short", "is_weekend", "is_business_day", "season"]
DATE_ROLES = {"order": "order_date_key", "ship": "ship_date_key"}

MEASURE_NAMES = [
    "total_sales", "total_profit", "profit_margin", "total_orders", "total_customers",
    "total_returned", "clv", "return_rate", "average_order_value", "average_unit_price",
    "average_shipping_days", "total_quantity", "average_discount", "on_time_delivery_pct",
    "total_returned_orders",
]


# Measures that need no distinct count: plain sums and counts of lines.
ADDITIVE = {"total_sales", "total_profit", "profit_margin", "average_unit_price", "average_shipping_days",
            "total_quantity", "average_discount", "total_returned_orders"}
CUSTOMER_MEASURES = {"total_customers", "clv"}
# Measures without a sum of the lines' values.
COUNTS = {"total_orders", "total_customers", "total_returned", "return_rate", "on_time_delivery_pct"}
ORDER_MEASURES = {"total_orders", "total_returned", "return_rate", "average_order_value", "on_time_delivery_pct"}


def partial_sums(on_time_max_days: int) -> list[Column]:
    """Additive sums of lines, which add up again over any finer grouping."""
    on_time = F.coalesce((F.col("days_to_ship") <= on_time_max_days).cast("int"), F.lit(0))
    return [
        F.sum("sales").alias("_sales"),
        F.sum("profit").alias("_profit"),
        F.sum("quantity").alias("_quantity"),
        F.sum("unit_price").alias("_unit_price_sum"), F.count("unit_price").alias("_unit_price_n"),
        F.sum("days_to_ship").alias("_days_sum"), F.count("days_to_ship").alias("_days_n"),
        F.sum("discount").alias("_discount_sum"), F.count("discount").alias("_discount_n"),
        F.sum(F.col("is_returned").cast("int")).alias("_returned_lines"),
        F.max(F.col("is_returned").cast("int")).alias("_returned_any"),
        F.max(on_time).alias("_on_time_any"),
        F.min(on_time).alias("_on_time_all"),
    ]


def combine(numeric: str, horizon: float, total: Callable[[str], Column], orders: Column, customers: Column, returned: Column,
            on_time: Column) -> dict[str, Column]:
    """The fifteen measures from the totals of partial sums (``total`` of a partial's name) and from distinct counts."""
    as_num = (lambda c: c.cast("double")) if numeric == "double" else (lambda c: c)
    sales, profit = as_num(total("_sales")), as_num(total("_profit"))

    def ratio(num: Column, den: Column) -> Column:
        out = num / F.nullif(den, F.lit(0))
        return out if numeric == "double" else out.cast(RESULT_DECIMAL)

    def mean(of: str, n: str) -> Column:
        if numeric == "double":
            return total(of).cast("double") / F.nullif(total(n), F.lit(0))
        return (total(of) / F.nullif(total(n), F.lit(0))).cast(RESULT_DECIMAL)

    if numeric == "double":
        clv = profit / F.nullif(customers, F.lit(0)) * F.lit(float(horizon))
    else:
        clv = (profit / F.nullif(customers, F.lit(0)) * F.lit(Decimal(str(horizon)))).cast(RESULT_DECIMAL)

    return {
        "total_sales": sales,                                                   # M1
        "total_profit": profit,                                                 # M2
        "profit_margin": ratio(profit, sales),                                  # M3
        "total_orders": orders,                                                 # M4
        "total_customers": customers,                                           # M5
        "total_returned": returned,                                             # M6
        "clv": clv,                                                             # M7
        "return_rate": returned / F.nullif(orders, F.lit(0)),                   # M8
        "average_order_value": ratio(sales, orders),                            # M9
        "average_unit_price": mean("_unit_price_sum", "_unit_price_n"),         # M10
        "average_shipping_days": total("_days_sum").cast("double")
                                 / F.nullif(total("_days_n"), F.lit(0)),        # M11
        "total_quantity": total("_quantity").cast("long"),                      # M12
        "average_discount": mean("_discount_sum", "_discount_n"),               # M13
        "on_time_delivery_pct": on_time / F.nullif(orders, F.lit(0)),           # M14
        "total_returned_orders": total("_returned_lines").cast("long"),         # M15
    }


def enriched_fact(gold: Gold, attributes: Sequence[str], date_role: str = "order") -> DataFrame:
    """The fact with the requested dimension attributes joined on (left joins)."""
    f = gold.fact_sales
    wanted = set(attributes)
    for fk, (dim_name, exposed) in RELATIONSHIPS.items():
        needed = {src: dst for src, dst in exposed.items() if dst in wanted}
        if not needed:
            continue
        dim = getattr(gold, dim_name).select(
            F.col(fk), *[F.col(src).alias(dst) for src, dst in needed.items()])
        f = lookup(f, dim, [fk], "left", gold.rows.get(dim_name))
    date_cols = [c for c in DATE_ATTRIBUTES if c in wanted]
    if date_cols and date_role == "order":
        f = order_date_lookup(f, gold.dim_date, date_cols, "left", gold.rows.get("dim_date"))
    elif date_cols:
        key = DATE_ROLES[date_role]
        d = gold.dim_date.select(F.col("date_key").alias(key), *date_cols)
        f = lookup(f, d, [key], "left", gold.rows.get("dim_date"))
    return f


def measures(gold: Gold, by: Sequence[str] = (), where: str | Column | None = None,
             names: Sequence[str] | None = None, date_role: str = "order",
             numeric: str = "decimal", horizon: float = 1.0, order_rule: str = "any",
             on_time_max_days: int = ON_TIME_MAX_DAYS, filter_attributes: Sequence[str] = ()) -> DataFrame:
    """Evaluate measures grouped by ``by`` under an optional filter.

    ``where`` may reference any attribute listed in ``by`` or
    ``filter_attributes``; ``horizon`` is the CLV extrapolation factor
    (unspecified by the source, default 1); ``order_rule`` says whether an
    order is on time when any (default) or all of its lines are.

    Plan: three narrow aggregates, each with a partial aggregate before its
    shuffle, meet in one row per group:

    * the additive sums go straight to ``by``;
    * the order counts go to (by, order), where an order is one row of two
      flags and counts are plain;
    * the customer count goes to (by, customer).

    So no sum moves once per order, and no row is copied per distinct count.
    Attributes of a dimension too large to broadcast are looked up for the
    sums by its key, not for the lines.
    """
    names = list(names or MEASURE_NAMES)
    unknown = [n for n in names if n not in MEASURE_NAMES]
    if unknown:
        raise ValueError(f"unknown measures: {unknown}")
    by = list(by)
    if set(names) <= ADDITIVE:
        f = enriched_fact(gold, by + list(filter_attributes), date_role)
        f = f if where is None else f.filter(where)
        exprs = _direct(numeric)
        aggs = [exprs[n].alias(n) for n in names]
        return f.groupBy(*by).agg(*aggs) if by else f.agg(*aggs)

    # A filter needs its attributes on the lines.
    on_lines = by + list(filter_attributes) if where is not None else []

    def summed(attributes: Sequence[str], own: Sequence[str], sums: Sequence[Column]) -> DataFrame:
        """Rows of ``attributes``, the fact's ``own`` columns and ``sums`` of lines; several rows of a cell where a large dimension was looked up last."""
        late = _large_dimensions(gold, attributes, on_lines)
        held = {a for dim in late.values() for a in dim.columns}
        early = [a for a in attributes if a not in held]
        f = enriched_fact(gold, early + on_lines, date_role)
        f = f if where is None else f.filter(where)
        cells = f.select(*early, *late, *own).distinct() if not sums else f.groupBy(*early, *late, *own).agg(*sums)
        for key, dim in late.items():
            cells = lookup(cells, dim, [key], "left", gold.rows.get(RELATIONSHIPS[key][0]))
        return cells

    def grouped(rows: DataFrame, aggs: Sequence[Column]) -> DataFrame:
        return rows.groupBy(*by).agg(*aggs) if by else rows.agg(*aggs)

    sums = partial_sums(on_time_max_days)
    flags, sums = sums[-3:], sums[:-3]
    parts = []
    if not set(names) <= COUNTS:
        rows = summed(by, [], sums)
        parts.append(grouped(rows, [F.sum(c).alias(c) for c in rows.columns if c.startswith("_")]))
    if ORDER_MEASURES & set(names):
        rows = summed(by, ["order_id"], flags)
        orders = rows.groupBy(*by, "order_id").agg(F.max("_returned_any").alias("_returned_any"), F.max("_on_time_any").alias("_on_time_any"),
                                                   F.min("_on_time_all").alias("_on_time_all"))
        parts.append(grouped(orders, [
            F.count("order_id").alias("_orders"), F.count(F.when(F.col("_returned_any") == 1, F.col("order_id"))).alias("_returned"),
            F.count(F.when(F.col("_on_time_any") == 1, F.col("order_id"))).alias("_on_time"),
            F.count(F.when(F.col("_on_time_all") == 0, F.col("order_id"))).alias("_late")]))
    if CUSTOMER_MEASURES & set(names):
        rows = summed([*by, *({"customer_id"} - set(by))], [], [])
        people = rows.select(*by, F.col("customer_id").alias("_customer_id")).distinct()
        parts.append(grouped(people, [F.count("_customer_id").alias("_customers")]))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part, allowMissingColumns=True)
    # Each part has one row per group, so the greatest value of a column is its value.
    orders = F.max("_orders")
    # All lines on time: the orders less those with a line that is not.
    on_time = orders - F.max("_late") if order_rule == "all" else F.max("_on_time")
    exprs = combine(numeric, horizon, F.max, orders, F.max("_customers"), F.max("_returned"), on_time)
    return grouped(found, [exprs[n].alias(n) for n in names])


def _large_dimensions(gold: Gold, attributes: Sequence[str], on_lines: Sequence[str] = ()) -> dict[str, DataFrame]:
    """By fact key, the asked attributes of each dimension that is too large to broadcast and not needed on the lines."""
    found = {}
    for key, (name, exposed) in RELATIONSHIPS.items():
        held = [F.col(source).alias(a) for source, a in exposed.items() if a in attributes]
        if held and not set(exposed.values()) & set(on_lines):
            dim = getattr(gold, name).select(F.col(key), *held)
            if not fits_broadcast(dim, gold.rows.get(name)):
                found[key] = dim
    return found


def _direct(numeric: str) -> dict[str, Column]:
    """The additive measures over the lines themselves."""
    def total(c: str) -> Column:
        return F.sum(c).cast("double") if numeric == "double" else F.sum(c)

    def ratio(num: Column, den: Column) -> Column:
        out = num / F.nullif(den, F.lit(0))
        return out if numeric == "double" else out.cast(RESULT_DECIMAL)

    return {
        "total_sales": total("sales"),
        "total_profit": total("profit"),
        "profit_margin": ratio(total("profit"), total("sales")),
        "average_unit_price": ratio(total("unit_price"), F.count("unit_price")),
        "average_shipping_days": F.sum("days_to_ship").cast("double") / F.nullif(F.count("days_to_ship"), F.lit(0)),
        "total_quantity": F.sum("quantity").cast("long"),
        "average_discount": ratio(total("discount"), F.count("discount")),
        "total_returned_orders": F.sum(F.col("is_returned").cast("int")).cast("long"),
    }
