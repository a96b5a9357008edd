"""Tables and views that any later session can query by name.

Publishing a run switches all names of all layers at once:

* every run's tables are registered under names of their own, in the schemas
  ``bronze_runs``, ``silver_runs`` and ``gold_runs``;
* each layer has two slots, the schemas ``<layer>_a`` and ``<layer>_b``, whose
  views point at the tables of one run each; a publish points the idle slot's
  at the new run, where no reader looks;
* a public name, such as ``gold.fact_sales``, takes the rows of the slot that
  the view ``gold.current_slot`` names; replacing this one view, in a single
  statement, is the switch.

The slot's name is a constant to the planner, which drops the other slot's
branch, so a query pays nothing for it.  A name is never dropped, and within a
query all names follow one slot, so no reader misses a name or sees two runs
mixed.  The six report views are permanent views over the public names.
Nothing here deletes a file.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tillroll.plans.measures import DATE_ATTRIBUTES, RELATIONSHIPS
from tillroll.plans.views import SUMMARY_COLUMNS
from tillroll.schemas import FACT_COLUMNS
from tillroll.sources.sinks import create_schemas

_UNITS = "CAST(sum(quantity) AS BIGINT) AS total_units"
_RETURNS = "sum(CAST(is_returned AS INT)) AS total_returns"
_ORDERS = "count(DISTINCT order_id)"


def _ratio(num: str, den: str, factor: str = "") -> str:
    return f"CAST({num} / nullif({den}, 0){factor} AS DECIMAL(38,6))"


def _mean(column: str) -> str:
    return _ratio(f"sum({column})", f"count({column})")


def _fact_with(schema: str, columns: Sequence[str], required: Sequence[str] = ()) -> str:
    """The fact joined to the dimensions that hold ``columns``; ``required`` keys must match, others may be missing."""
    sql = f"{schema}.fact_sales f"
    for key, (dim, exposed) in RELATIONSHIPS.items():
        if held := [f"{source} AS {name}" for source, name in exposed.items() if name in columns]:
            sql += f" {'' if key in required else 'LEFT '}JOIN (SELECT {key}, {', '.join(held)} FROM {schema}.{dim}) USING ({key})"
    if held := [c for c in DATE_ATTRIBUTES if c in columns]:
        # The year of the key is the fact's partition: a filter on the calendar prunes whole years.
        sql += (f" JOIN (SELECT date_key AS order_date_key, date_key div 10000 AS order_year, {', '.join(held)} "
                f"FROM {schema}.dim_date) USING (order_date_key, order_year)")
    return sql


def _view(schema: str, by: Sequence[str], metrics: Sequence[str], required: Sequence[str] = ()) -> str:
    return f"SELECT {', '.join([*by, *metrics])} FROM {_fact_with(schema, by, required)} GROUP BY {', '.join(by)}"


def view_statements(schema: str = "gold") -> dict[str, str]:
    """V1-V6 as SQL over the tables of ``schema``."""
    money = ["sum(sales) AS total_sales", "sum(profit) AS total_profit"]

    def by_member(key: str, dim: str, attributes: Sequence[str], metrics: Sequence[str]) -> str:
        """Metrics per member: the fact is summed by key first, so the dimension meets one row per member."""
        names = [m.rpartition(" AS ")[2] for m in metrics]
        return (f"SELECT {', '.join([*attributes, *names])} FROM (SELECT {key}, {', '.join(metrics)} FROM {schema}.fact_sales GROUP BY {key}) "
                f"JOIN {schema}.{dim} USING ({key})")
    keys = ["customer_key", "product_key", "location_key"]
    return {
        "vw_sales_summary": f"SELECT {', '.join(SUMMARY_COLUMNS)} FROM {_fact_with(schema, SUMMARY_COLUMNS, keys)}",
        "vw_product_performance": by_member(
            "product_key", "dim_product", ["product_id", "product_name", "category", "sub_category"],
            [f"{_ORDERS} AS total_orders", *money, _UNITS, f"{_mean('discount')} AS avg_discount",
             f"{_mean('unit_price')} AS avg_unit_price", f"{_ratio('sum(profit)', 'sum(sales)', ' * 100')} AS profit_margin_pct",
             _RETURNS]),
        "vw_customer_analysis": by_member(
            "customer_key", "dim_customer", ["customer_id", "customer_name", "segment"],
            [f"{_ORDERS} AS total_orders", "sum(sales) AS total_spent", money[1], f"{_mean('sales')} AS avg_order_value",
             _UNITS, _RETURNS]),
        "vw_regional_performance": _view(
            schema, ["region", "state", "city", "sales_person"],
            [f"{_ORDERS} AS total_orders", *money, _UNITS,
             "sum(days_to_ship) div nullif(count(days_to_ship), 0) AS avg_shipping_days", _RETURNS], ["location_key"]),
        "vw_shipping_performance": _view(
            schema, ["ship_mode"],
            [f"{_ORDERS} AS total_orders", "sum(days_to_ship) div nullif(count(days_to_ship), 0) AS avg_days_to_ship",
             "min(days_to_ship) AS min_days", "max(days_to_ship) AS max_days", money[0], _RETURNS]),
        "vw_monthly_trends": _view(
            schema, ["year", "month", "month_name", "month_year_label", "quarter_name", "season"],
            [f"{_ORDERS} AS total_orders", *money, _UNITS, _RETURNS, f"{_ratio('sum(sales)', _ORDERS)} AS avg_order_value"]),
    }


SLOTS = ("a", "b")
POINTER = "current_slot"


def _drop_table(spark: SparkSession, name: str) -> None:
    """Make room for a view where an earlier version kept a table."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")


def current_slot(spark: SparkSession, schemas: Sequence[str] = ("bronze", "silver", "gold")) -> str | None:
    """The slot that the public names follow; None before the first publish."""
    name = f"{schemas[2]}.{POINTER}"
    return spark.table(name).first()["slot"] if spark.catalog.tableExists(name) else None


def _register_run(spark: SparkSession, run_dir: str, layer: str, schema: str, table: str) -> tuple[str, list[str]]:
    """The run's table under its own name, with the columns that readers see."""
    run = re.sub(r"\W", "_", run_dir.rstrip("/").rpartition("/")[2])
    name, path = f"{schema}_runs.{table}__{run}", f"{run_dir}/{layer}/{table}"
    columns = spark.read.parquet(path).columns
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
        if "order_year" in columns:
            spark.sql(f"MSCK REPAIR TABLE {name}")
    seen = [*FACT_COLUMNS, "order_year"] if "order_year" in columns else columns
    return f"SELECT {', '.join(seen)} FROM {name}{' WHERE NOT _quarantined' if '_quarantined' in columns else ''}", seen


def publish_catalog(spark: SparkSession, run_dir: str, tables: dict[str, Sequence[str]],
                    schemas: tuple[str, str, str] = ("bronze", "silver", "gold")) -> str:
    """Register ``tables`` (layer to table names below ``run_dir``), switch the public names to them, return the slot."""
    create_schemas(spark, [s for schema in schemas for s in (schema, f"{schema}_runs", *(f"{schema}_{x}" for x in SLOTS))])
    now = current_slot(spark, schemas)
    slot = SLOTS[0] if now is None else next(x for x in SLOTS if x != now)
    public = []
    for layer, schema in zip(("bronze", "silver", "gold"), schemas):
        for table in tables.get(layer, ()):
            rows, columns = _register_run(spark, run_dir, layer, schema, table)
            # Both slots at first: the public name refers to both.
            for x in SLOTS if now is None or not spark.catalog.tableExists(f"{schema}_{SLOTS[0]}.{table}") else (slot,):
                spark.sql(f"CREATE OR REPLACE VIEW {schema}_{x}.{table} AS {rows}")
            public.append((schema, table, columns))
    pointer = f"{schemas[2]}.{POINTER}"
    if now is None:
        spark.sql(f"CREATE OR REPLACE VIEW {pointer} AS SELECT '{slot}' AS slot")
    for schema, table, columns in public:
        name = f"{schema}.{table}"
        _drop_table(spark, name)
        if not spark.catalog.tableExists(name) or spark.table(name).columns != columns:
            either = " UNION ALL ".join(f"SELECT {', '.join(columns)} FROM {schema}_{x}.{table} WHERE (SELECT slot FROM {pointer}) = '{x}'" for x in SLOTS)
            spark.sql(f"CREATE OR REPLACE VIEW {name} AS {either}")
    for name, sql in view_statements(schemas[2]).items():
        if not spark.catalog.tableExists(f"{schemas[2]}.{name}"):
            spark.sql(f"CREATE VIEW {schemas[2]}.{name} AS {sql}")
    if now is not None:
        spark.sql(f"CREATE OR REPLACE VIEW {pointer} AS SELECT '{slot}' AS slot")  # the switch
    return slot
