"""Map the TPC-H-style driver tables onto the three landing tables.

The driver tables carry no retail order sheet, so the order lines are
derived: lineitem joined to orders, customer, nation, region and part, with
deliberate dirt planted by fixed modulo rules so every cleansing branch runs
(invalid ship modes, a bad country code, missing postal codes, doubled
spaces, exact duplicate rows, a person listed for two regions, repeated
return records).  The same expressions are written as DuckDB SQL in
:mod:`tillroll.oracle` for the side-by-side check.

Plan shape: ``row_id`` needs each line's position inside its order.  The
lines move once by order, are numbered there by a window and meet the order
and its customer, joined beforehand; an order with more lines than a task's
share is numbered apart, by a global dense rank minus the order's first rank,
and joins by a join whose large partitions the skew rule splits.  The lines
move a second time by part; nation and region come last, so that no line
moves with their texts.  customer, part, nation and
region are joined without hints: the planner broadcasts them while their
files are under the broadcast threshold and uses sort-merge joins beyond it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.operators.keys import ROWS_PER_KEY_PARTITION, dense_key
from tillroll.rules import PRODUCT_NAME_OVERRIDES, SilverRules
from tillroll.session import ensure_checkpoint_dir

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Fixed values of the fixture: rule entries that match the driver tables, so
# the id- and city-specific rules of the silver layer have rows to act on.
FIXTURE_RULES = SilverRules().extended(
    order_date_overrides={"O-100": dt.date(1998, 8, 12)},
    postal_code_fixes={("NATION_7", "ASIA"): "05401"},
    product_name_overrides={"P-7": PRODUCT_NAME_OVERRIDES["OFF-AP-10002684"]},
)

_ROW_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus"]
# Lines alike in these differ in nothing that the landing table shows, so whichever comes first gives the same rows.
_SHOWN_ORDER = _ROW_ORDER[:6]
_SHIP_MODES = ["First Class", "Second Class", "Standard Class", "Same Day"]


def read_driver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet") for name in DRIVER_TABLES}


def _row_order(lineitem: DataFrame) -> list[str]:
    return [c for c in _ROW_ORDER if c in lineitem.columns]


def number_lines(lineitem: DataFrame) -> DataFrame:
    """Add ``_rn`` = row_number() per l_orderkey in ``_ROW_ORDER``, as far as ``lineitem`` has its columns, by a plain per-order window.

    Its largest task is the largest order, so :func:`lines_with_orders` numbers large orders otherwise.
    """
    w = Window.partitionBy("l_orderkey").orderBy(*[F.col(c).asc_nulls_first() for c in _row_order(lineitem)])
    return lineitem.withColumn("_rn", F.row_number().over(w))


#: Fewer lines of an order than these are never many.  Buckets of orders.
LEAST_MANY, BUCKETS = 1000, 1 << 16


def orders_of_many_lines(lineitem: DataFrame) -> DataFrame | None:
    """Keys of the orders with more lines than an even share of a partition, or than a task should sort; None where there are none.

    At most as many as there are partitions, or millions of lines.  Lines are
    counted by buckets of orders first, and by order in too full buckets only.
    """
    share = min(lineitem.count() // int(lineitem.sparkSession.conf.get("spark.sql.shuffle.partitions")), ROWS_PER_KEY_PARTITION)
    many = F.col("_n") > max(share, LEAST_MANY)
    bucketed = lineitem.withColumn("_bucket", F.pmod(F.xxhash64("l_orderkey"), F.lit(BUCKETS)))
    full = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).where(many).select("_bucket").checkpoint()
    if full.isEmpty():
        return None
    counts = bucketed.join(F.broadcast(full), "_bucket", "left_semi").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(many).select("l_orderkey").checkpoint()


def lines_with_orders(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Each line with its order's columns and ``_rn``, its position inside the order.

    The lines move once, by order, and are numbered and joined where they
    land.  An order with a third of all lines spans many tasks throughout: its
    rank is range-partitioned on all ordering columns, the first rank is a partial
    aggregate, and the join of its lines is split where it is skewed.
    """
    columns = [*lineitem.columns, *orders.columns]

    def joined(numbered):
        return numbered.join(orders, numbered.l_orderkey == orders.o_orderkey).select(*columns, "_rn")
    lineitem = lineitem.where(F.col("l_orderkey").isNotNull())
    ensure_checkpoint_dir(lineitem.sparkSession)
    many = orders_of_many_lines(lineitem)
    if many is None:
        return joined(number_lines(lineitem))
    many = F.broadcast(many)
    ranked = dense_key(lineitem.join(many, "l_orderkey", "left_semi"), ["l_orderkey", *_row_order(lineitem)], "_g")
    first = ranked.groupBy("l_orderkey").agg(F.min("_g").alias("_g0"))
    heads = first.join(orders, first.l_orderkey == orders.o_orderkey).drop("l_orderkey").checkpoint()
    large = ranked.join(heads, ranked.l_orderkey == heads.o_orderkey).select(
        *columns, (F.col("_g") - F.col("_g0") + 1).cast("int").alias("_rn"))
    return joined(number_lines(lineitem.join(many, "l_orderkey", "left_anti"))).unionByName(large)


def bronze_orders(t: dict[str, DataFrame]) -> DataFrame:
    customer = t["customer"].select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = t["nation"].select("n_nationkey", "n_name", "n_regionkey")
    region = t["region"].select("r_regionkey", "r_name")
    part = t["part"].select("p_partkey", "p_name", "p_brand", "p_type")
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    lo = lines_with_orders(t["lineitem"].select("l_orderkey", *_SHOWN_ORDER),
                           orders.join(customer, orders.o_custkey == customer.c_custkey))
    # What moves by part: each key once, dates as such.
    lo = lo.select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_suppkey") % 40 == 0).alias("_other_code"), "l_quantity", "l_extendedprice",
                   "l_discount", "o_custkey", F.col("o_orderdate").cast("date").alias("_order_date"), "c_name", "c_nationkey", "c_mktsegment", "_rn")
    j = (lo.join(part, F.col("l_partkey") == part.p_partkey)
           .join(nation, F.col("c_nationkey") == nation.n_nationkey)
           .join(region, F.col("n_regionkey") == region.r_regionkey))

    # Exact duplicates: every line of one order in a hundred appears twice,
    # the copy under row_id + 500.  One pass: each line explodes into its
    # row_id offsets instead of a UNION that would recompute the joins.
    j = j.withColumn("_copy", F.explode(
        F.when(F.col("l_orderkey") % 100 == 0, F.array(F.lit(0), F.lit(500)))
         .otherwise(F.array(F.lit(0)))))
    order_date = F.col("_order_date")
    part_mod = F.col("l_partkey") % 50
    mode_by_order = F.element_at(F.array(*[F.lit(m) for m in _SHIP_MODES]),
                                 (F.col("l_orderkey") % 4 + 1).cast("int"))
    ok, nation_key = F.col("l_orderkey"), F.col("n_nationkey")
    zero = F.lit(0).cast("decimal(10,4)")
    sales = F.when(F.col("l_partkey") % 89 == 7, zero).otherwise(F.col("l_extendedprice").cast("decimal(10,4)"))
    # Three decimals, so that the narrowing to two has something to round.
    half = F.when(F.col("l_linenumber") == 4, F.lit(0.005).cast("decimal(5,4)")).otherwise(F.lit(0).cast("decimal(5,4)"))
    discount = (F.col("l_discount").cast("decimal(5,4)") + half).cast("decimal(5,4)")
    # Lines 1 and 2 of some orders share their row_id; of the copies some have no row_id and some the original's.
    position = F.when((ok % 500 == 7) & (F.col("_rn") == 2), F.lit(1)).otherwise(F.col("_rn"))
    row_id = F.when((F.col("_copy") > 0) & (ok % 300 == 0), F.lit(None)).otherwise(
        ok * 1000 + position + F.when(ok % 300 == 100, F.lit(0)).otherwise(F.col("_copy")))
    spaces = F.when(F.col("p_partkey") % 3 == 0, F.lit("  ")).when(F.col("p_partkey") % 7 == 1, F.lit("   ")).otherwise(F.lit(" "))
    return j.select(
        row_id.cast("long").alias("row_id"),
        F.concat(F.lit("O-"), F.col("l_orderkey").cast("string")).alias("order_id"),
        order_date.alias("order_date"),
        F.date_add(order_date, ((F.col("l_orderkey") + F.col("l_linenumber")) % 9).cast("int")).alias("ship_date"),
        F.when(part_mod == 0, F.lit("null")).when(part_mod == 1, F.lit("0"))
         .when(part_mod == 2, F.lit(None).cast("string")).otherwise(mode_by_order).alias("ship_mode"),
        F.concat(F.lit("C-"), F.col("o_custkey").cast("string")).alias("customer_id"),
        # Longer than declared, for some.
        F.concat(F.col("c_name"), F.when(F.col("o_custkey") % 200 == 9, F.repeat(F.lit("x"), 100)).otherwise("")).alias("customer_name"),
        # Some customers have two segments, so that the fact fans out.
        F.when((F.col("o_custkey") % 50 == 3) & (ok % 2 == 0), F.lit("DUAL")).otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("_other_code"), F.lit("123")).otherwise(F.lit("United States")).alias("country_region"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        # No postal code: in one city a rule adds it, in the other the rows are set aside.
        F.when((nation_key == 7) | ((nation_key == 8) & (ok % 11 == 0)), F.lit(None).cast("string"))
         .otherwise(F.lpad(F.col("n_nationkey").cast("string"), 5, "0")).alias("postal_code"),
        # Two cities lie in two regions each: one of those has two people, the other none.
        F.when(nation_key.isin(5, 6) & (ok % 3 == 0), F.concat(F.lit("ZONE "), nation_key.cast("string")))
         .otherwise(F.col("r_name")).alias("region"),
        F.concat(F.lit("P-"), F.col("p_partkey").cast("string")).alias("product_id"),
        F.col("p_brand").alias("category"),
        F.col("p_type").alias("sub_category"),
        F.replace(F.col("p_name"), F.lit(" "), spaces).alias("product_name"),
        sales.alias("sales"),
        F.when(F.col("l_partkey") % 97 == 5, F.lit(0)).otherwise(F.col("l_quantity").cast("int")).alias("quantity"),
        discount.alias("discount"),
        (sales * (F.lit(0.05).cast("decimal(5,4)") - discount)).cast("decimal(10,4)").alias("profit"),
    )


def bronze_people(t: dict[str, DataFrame]) -> DataFrame:
    """One person per region; two in a further one; two people listed twice, one of them once without a region."""
    region = t["region"]
    people = region.select(F.concat(F.lit("Rep "), F.col("r_name")).alias("person_name"), F.col("r_name").alias("region"))
    extra = region.sparkSession.sql(
        "SELECT * FROM VALUES ('Rep AFRICA', 'ZZZ'), ('Rep NORTH', 'ZONE 5'), ('Rep SOUTH', 'ZONE 5'), "
        "('Rep NOWHERE', CAST(NULL AS STRING)), ('Rep NOWHERE', 'ZONE 9') AS p(person_name, region)")
    return people.unionByName(extra)


def bronze_returns(t: dict[str, DataFrame]) -> DataFrame:
    """A return record per returned line of every tenth order, repeats kept, said in several ways or not at all."""
    lines = t["lineitem"].select("l_orderkey", "l_returnflag", "l_linenumber")
    orders = t["orders"].select("o_orderkey")
    j = lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left_semi")
    said = F.when(F.col("l_linenumber") % 3 == 0, F.lit(None).cast("string")).when(F.col("l_linenumber") % 3 == 1, F.lit("Yes")).otherwise(F.lit("Y"))
    return (j.filter((F.col("l_returnflag") == "R") & (F.col("l_orderkey") % 10 == 0))
             .select(said.alias("returned"), F.concat(F.lit("O-"), F.col("l_orderkey").cast("string")).alias("order_id")))


def bronze_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = read_driver_tables(spark, sf_dir)
    return {
        "orders": bronze_orders(t),
        "people": bronze_people(t),
        "returns_order": bronze_returns(t),
    }
