"""Silver layer (R1): cleanse and deduplicate the landing tables.

Exact-duplicate removal runs first, on the raw columns, as an aggregate
(W1): rows equal in all twenty raw columns collapse to the lowest row_id.  In
the build only rows whose digest repeats move whole.
The rules are then applied to the surviving raw values in one ``select``,
so rows that only become equal after cleaning are both kept, and every rule
sees raw inputs (the ship-mode repair uses the uncorrected order date).
Cleaning is a pure function of the raw columns, so applying it after the
dedup gives the same rows as applying it before, for one shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import cleaning
from tillroll.operators.dedup import drop_exact_duplicates, drop_exact_duplicates_by_digest, first_per_key
from tillroll.rules import SilverRules
from tillroll.schemas import ORDERS_DEDUP_COLUMNS


def collated(df: DataFrame, collation: str | None) -> DataFrame:
    """Give every text column a collation (e.g. ``UTF8_LCASE_RTRIM``).

    The original store compared text under its server's collation --
    usually case-insensitive with trailing blanks ignored -- in every
    DISTINCT, PARTITION BY, join and IN test.  With a collation on the
    columns, the same Spark plans compare that way; the collated type is
    kept in the written layers, so gold joins inherit it.
    """
    if not collation:
        return df
    return df.select(*[
        F.collate(F.col(f.name), collation).alias(f.name) if isinstance(f.dataType, T.StringType)
        else F.col(f.name) for f in df.schema.fields])


def dedup_orders(bronze_orders: DataFrame, count_as: str | None = None, by_digest: bool = False) -> DataFrame:
    """One row per distinct 20-column tuple, lowest row_id kept.

    ``by_digest`` moves 8 bytes of every row and only the rows that may have a
    copy whole, at the price of reading the table three times.
    """
    drop = drop_exact_duplicates_by_digest if by_digest else drop_exact_duplicates
    return drop(bronze_orders, ORDERS_DEDUP_COLUMNS, "row_id", count_as=count_as)


def clean_order_columns(rules: SilverRules) -> list:
    """The 21 cleaned columns, each computed from raw columns only."""
    c = F.col
    return [
        c("row_id"),
        c("order_id"),
        cleaning.order_date(c("order_id"), c("order_date"), rules).alias("order_date"),
        c("ship_date"),
        cleaning.ship_mode(c("ship_mode"), c("order_date"), c("ship_date"), rules).alias("ship_mode"),
        c("customer_id"),
        c("customer_name"),
        c("segment"),
        cleaning.country_region(c("country_region"), rules).alias("country_region"),
        c("city"),
        c("state"),
        cleaning.postal_code(c("city"), c("state"), c("postal_code"), rules).alias("postal_code"),
        c("region"),
        c("product_id"),
        c("category"),
        c("sub_category"),
        cleaning.product_name(c("product_id"), c("product_name"), rules).alias("product_name"),
        c("sales"),
        c("quantity"),
        cleaning.narrow_discount(c("discount")).alias("discount"),
        c("profit"),
    ]


def silver_orders(bronze_orders: DataFrame, rules: SilverRules | None = None,
                  load_stamp: bool = True, collation: str | None = None, by_digest: bool = False) -> DataFrame:
    rules = rules or SilverRules()
    cols = clean_order_columns(rules)
    if load_stamp:
        cols.append(F.current_timestamp().alias("dw_load_date"))  # P7
    return dedup_orders(collated(bronze_orders, collation), by_digest=by_digest).select(*cols)


def silver_people(bronze_people: DataFrame, load_stamp: bool = True,
                  collation: str | None = None) -> DataFrame:
    """One row per person, the lowest region (NULL first)."""
    people = collated(bronze_people.select("person_name", "region"), collation)
    out = first_per_key(people, ["person_name"], "region")
    return out.withColumn("dw_load_date", F.current_timestamp()) if load_stamp else out


def silver_returns(bronze_returns: DataFrame, load_stamp: bool = True,
                   collation: str | None = None) -> DataFrame:
    """One row per returned order, the lowest ``returned`` value (NULL first)."""
    returns = collated(bronze_returns.select("returned", "order_id"), collation)
    out = first_per_key(returns, ["order_id"], "returned")
    return out.withColumn("dw_load_date", F.current_timestamp()) if load_stamp else out


def build_silver(bronze: dict[str, DataFrame], rules: SilverRules | None = None,
                 load_stamp: bool = True, collation: str | None = None) -> dict[str, Callable[[], DataFrame]]:
    """What makes each silver table of the stored landing tables; planning the orders runs jobs, as they are compared by digest first."""
    return {
        "orders": lambda: silver_orders(bronze["orders"], rules, load_stamp, collation, by_digest=True),
        "people": lambda: silver_people(bronze["people"], load_stamp, collation),
        "returns_order": lambda: silver_returns(bronze["returns_order"], load_stamp, collation),
    }
