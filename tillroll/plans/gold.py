"""Gold layer (R2, R6): date dimension, five dimensions, sales fact.

Dimensions are DISTINCT projections of silver (partial aggregation keeps the
shuffle to one row per value and map task) numbered densely in sort order
by :func:`tillroll.operators.keys.dense_key`.  The fact is silver joined to
the dimensions; each lookup broadcasts its dimension only when the row
count is known and small, else it is a sort-merge join that AQE may still
re-plan and whose skewed partitions AQE splits.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.arithmetic import days_between, profit_margin, unit_price
from tillroll.functions.calendar import calendar_columns
from tillroll.operators.keys import dense_key, unique_key
from tillroll.operators.lookup import lookup, sparse_lookup
from tillroll.operators.quality import any_null
from tillroll.rules import DEFAULT_DATE_RANGE
from tillroll.schemas import DIMENSIONS, FACT_COLUMNS

DIMENSION_NAMES = ["dim_customer", "dim_product", "dim_location", "dim_ship_mode", "dim_sales_person"]


@dataclass
class Gold:
    dim_date: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_location: DataFrame
    dim_ship_mode: DataFrame
    dim_sales_person: DataFrame
    fact_sales: DataFrame
    # Proven row counts (from observed writes or bounds); None = unknown.
    rows: dict = field(default_factory=dict)

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in
                ["dim_date", *DIMENSION_NAMES, "fact_sales"]}

    def dims(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in DIMENSION_NAMES}


def date_range_days(start: dt.date, end: dt.date) -> int:
    """Rows of the date series: both ends included; one row when start > end."""
    return max((end - start).days + 1, 1)


def date_bounds() -> list:
    """The first and last of all order and ship dates, as aggregates to observe while silver is written."""
    return [F.min(F.least("order_date", "ship_date")).alias("first_date"),
            F.max(F.greatest("order_date", "ship_date")).alias("last_date")]


def whole_years(first: dt.date | None, last: dt.date | None) -> tuple[dt.date, dt.date]:
    """The calendar years that the dates span; the default range where there are none."""
    if first is None or last is None:
        return DEFAULT_DATE_RANGE
    return dt.date(first.year, 1, 1), dt.date(last.year, 12, 31)


def dim_date(spark: SparkSession, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """U2 + F3-F16: one row per day from start to end.

    ``spark.range`` spreads the days over tasks; the row count is a bound
    known on the driver from the two dates, so the dimension can always be
    sized for a broadcast.
    """
    start = start or DEFAULT_DATE_RANGE[0]
    end = end or DEFAULT_DATE_RANGE[1]
    n = date_range_days(start, end)
    days = spark.range(n).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    return days.select(*calendar_columns(F.col("d")))


def _first_by(df: DataFrame, keys: list[str], rest: list[str]) -> DataFrame:
    """One row per key, the lowest ``rest`` tuple (NULL first), as an aggregate.

    Distinct rows come first, by hash: the minimum of a struct of texts
    aggregates by sort, which then meets a row per member and not every line.
    They are counted, as the optimizer drops a plain DISTINCT below a minimum.
    """
    df = df.groupBy(*keys, *rest).agg(F.count(F.lit(1)).alias("_n")).where("_n > 0")
    parts = []
    for c in rest:
        parts += [F.col(c).isNotNull().alias(f"{c}__nn"), F.col(c).alias(c)]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*parts)).alias("_first"))
    return picked.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest])


def dimension(silver_orders: DataFrame, name: str, dedupe: str = "distinct",
              num_partitions: int | None = None, drop_missing_required: bool = False) -> DataFrame:
    """A17 + A7: DISTINCT members of one dimension with a dense key.

    ``dedupe='distinct'`` keeps every distinct attribute tuple (the fact may
    then fan out, see Q6); ``'first'`` keeps one row per join key.  The sort
    covers every column so the numbering is a total order.
    """
    spec = DIMENSIONS[name]
    cols = spec["columns"]
    base = silver_orders.select(*cols)
    if name == "dim_ship_mode":
        base = base.filter(F.col("ship_mode").isNotNull())  # P9
    elif drop_missing_required and spec["required"]:
        base = base.filter(~any_null(spec["required"]))
    if dedupe == "first":
        rest = [c for c in cols if c not in spec["join_on"]]
        base = _first_by(base, spec["join_on"], rest) if rest else base.distinct()
    else:
        base = base.distinct()
    return dense_key(base, cols, spec["key"], num_partitions)


def dim_sales_person(silver_people: DataFrame, num_partitions: int | None = None) -> DataFrame:
    base = silver_people.select("person_name", "region")
    return dense_key(base, ["person_name", "region"], "sales_person_key", num_partitions)


def date_slices(silver_orders: DataFrame, n: int) -> list[DataFrame]:
    """The lines in at most ``n`` stretches of order dates of about as many lines each; missing dates are in the first."""
    shares = [i / n for i in range(1, n)]
    cuts = silver_orders.agg(F.percentile_approx("order_date", shares, 1000).alias("at")).first()["at"] if shares else None
    cuts, day = sorted(set(cuts or [])), F.col("order_date")
    if not cuts:
        return [silver_orders]
    between = [(day >= a) & (day < b) for a, b in zip(cuts, cuts[1:])]
    return [silver_orders.where(w) for w in (day.isNull() | (day < cuts[0]), *between, day >= cuts[-1])]


def fact_sales(silver_orders: DataFrame, silver_returns: DataFrame, dim_date_df: DataFrame,
               dims: dict[str, DataFrame], rows: dict | None = None, broadcast_limit: int | None = None,
               arrange: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The fact at the grain of a silver row (times any dimension fan-out).

    Keys that do not match stay NULL here; the required-key check runs on
    the result before it is published.  ``rows`` holds proven row counts
    used to size broadcasts.  ``arrange`` lays out the joined lines and may add
    columns; what is computed from a line alone comes after it, so as not to move.
    """
    rows = rows or {}
    o = silver_orders.select(
        "order_id", "order_date", "ship_date", "ship_mode", "customer_id", "city", "state",
        "postal_code", "region", "product_id", "product_name", "sales", "quantity",
        "discount", "profit")

    def join(left, right, on, name):
        return lookup(left, right, on, "left", rows.get(name), broadcast_limit)

    # Small, bounded dimensions whose key is narrower than their texts: map-side lookups, no shuffle.
    f = join(o, dims["dim_ship_mode"].select("ship_mode_key", "ship_mode"),
             ["ship_mode"], "dim_ship_mode")                                      # J6
    f = join(f, dims["dim_sales_person"].select("sales_person_key", "region"),
             ["region"], "dim_sales_person")                                      # J7
    f = join(f, dims["dim_location"].select("location_key", "city", "state", "postal_code"),
             ["city", "state", "postal_code"], "dim_location")                    # J5
    # Few orders are returned, and the lines that are not need not move.
    f = sparse_lookup(f, silver_returns.select("order_id", F.lit(1).alias("_returned")), "order_id",
                      rows.get("silver_returns_order"), broadcast_limit)         # J8
    # Possibly large dimensions: broadcast only when proven small.  The longer texts leave first.
    f = join(f, dims["dim_product"].select("product_key", "product_id", "product_name"),
             ["product_id", "product_name"], "dim_product")                       # J4
    f = join(f, dims["dim_customer"].select("customer_key", "customer_id"),
             ["customer_id"], "dim_customer")                                     # J3
    # A date is no wider than its key.
    od = dim_date_df.select(F.col("full_date").alias("order_date"), F.col("date_key").alias("order_date_key"))
    sd = dim_date_df.select(F.col("full_date").alias("ship_date"), F.col("date_key").alias("ship_date_key"))
    f = join(f, od, ["order_date"], "dim_date")                                   # J1
    f = join(f, sd, ["ship_date"], "dim_date")                                    # J2

    lines = f.select(
        "order_date_key", "ship_date_key", "customer_key", "product_key", "location_key",
        "ship_mode_key", "sales_person_key", "order_id", "sales", "quantity", "discount", "profit",
        days_between(F.col("order_date"), F.col("ship_date")).alias("days_to_ship"),  # P13
        "_returned")
    laid = arrange(lines) if arrange else lines
    more = [c for c in laid.columns if c not in lines.columns]
    out = laid.select(
        "order_date_key", "ship_date_key", "customer_key", "product_key", "location_key",
        "ship_mode_key", "sales_person_key", "order_id", "sales", "quantity",
        F.col("discount").cast("decimal(5,4)").alias("discount"),
        "profit",
        unit_price(F.col("sales"), F.col("quantity")).alias("unit_price"),          # P11
        profit_margin(F.col("profit"), F.col("sales")).alias("profit_margin"),      # P12
        "days_to_ship",
        F.when(F.col("_returned").isNotNull(), F.lit(1)).otherwise(F.lit(0)).alias("is_returned"),  # P10
        *more,
    )
    return unique_key(out, "fact_key").select(*FACT_COLUMNS, *more)                   # A8
