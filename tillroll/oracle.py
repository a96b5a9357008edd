"""DuckDB SQL for the side-by-side correctness check.

Every registered query has a statement over the raw driver tables.  Of the
library's model only the landing and fact tables' declared columns are shared.
Nothing is taken from the Spark plans or from the cleansing rules: rule values,
text lengths, labels, the dimensions' columns and keys and the attributes that
the relationships expose stand here as literals, so that a wrong value on
either side turns a row red.

Conventions shared with :func:`tillroll.plans.registry.comparable`: dates are
compared as ISO text and decimals as doubles; sums are exact decimals, cast to
double before any division; NULL sorts first.  DuckDB divides decimals in
double, so the fact's two DECIMAL(10,4) quotients are taken on unscaled
integers and rounded half up.
"""

from __future__ import annotations

import re

from tillroll.schemas import BRONZE_ORDERS, DIM_DATE_COLUMNS, FACT_COLUMNS, ORDERS_COLUMNS, ORDERS_DEDUP_COLUMNS

# ---------------------------------------------------------------------------
# Fixed values, stated again independently of the rules under test.
# ---------------------------------------------------------------------------
RULES = {
    "order_date_rule(order_id, fixed_date)": "('CA-2016-153927', DATE '2016-08-12'), ('O-100', DATE '1998-08-12')",
    "country_rule(country_region, fixed_country)": "('123', 'United States')",
    "postal_rule(city, state, fixed_postal)": "('Burlington', 'Vermont', '05401'), ('NATION_7', 'ASIA', '05401')",
    "product_rule(product_id, fixed_name)":
        "('OFF-AP-10002684', 'Acco 7-Outlet Masterpiece Power Center, Wihtout Fax/Phone Line Protection'), "
        "('P-7', 'Acco 7-Outlet Masterpiece Power Center, Wihtout Fax/Phone Line Protection')",
    # A ship mode that says nothing is told from the days between order and shipping.
    "ship_mode_rule(ship_mode, first_day, last_day, fixed_mode)": ", ".join(
        f"('{bad}', {a}, {b}, '{mode}')" for bad in ("null", "0") for a, b, mode in (
            (-100000, 1, "Same Day"), (2, 2, "Unknown"), (3, 7, "Standard Class"), (8, 100000, "Unknown"))),
    "season_rule(month, season)": ", ".join(
        f"({m}, '{s}')" for s, months in (("Winter", (12, 1, 2)), ("Spring", (3, 4, 5)), ("Summer", (6, 7, 8)), ("Fall", (9, 10, 11)))
        for m in months),
}
LENGTHS = {"order_id": 50, "ship_mode": 50, "customer_id": 50, "customer_name": 100, "segment": 50, "country_region": 50,
           "city": 100, "state": 50, "postal_code": 50, "region": 50, "product_id": 50, "category": 50, "sub_category": 50,
           "product_name": 255}
ON_TIME = 5


def _dim(key: str, columns: str, join_on: str) -> dict:
    return {"key": key, "columns": columns.split(), "join_on": join_on.split()}


DIMENSIONS = {
    "dim_customer": _dim("customer_key", "customer_id customer_name segment", "customer_id"),
    "dim_product": _dim("product_key", "product_id product_name category sub_category", "product_id product_name"),
    "dim_location": _dim("location_key", "city state postal_code region", "city state postal_code"),
    "dim_ship_mode": _dim("ship_mode_key", "ship_mode", "ship_mode"),
    "dim_sales_person": _dim("sales_person_key", "person_name region", "region"),
}
#: Fact key to dimension and, per attribute of a report, the dimension's column.
RELATIONSHIPS = {
    "customer_key": ("dim_customer", {"customer_id": "customer_id", "customer_name": "customer_name", "segment": "segment"}),
    "product_key": ("dim_product", {c: c for c in ("product_id", "product_name", "category", "sub_category")}),
    "location_key": ("dim_location", {c: c for c in ("city", "state", "postal_code", "region")}),
    "ship_mode_key": ("dim_ship_mode", {"ship_mode": "ship_mode"}),
    "sales_person_key": ("dim_sales_person", {"person_name": "sales_person", "region": "sales_person_region"}),
}
DATE_ATTRIBUTES = ["full_date", "year", "quarter_name", "month", "month_name", "month_short", "month_year_label", "week_of_year",
                   "day_of_month", "day_of_week", "day_name", "day_short", "is_weekend", "is_business_day", "season"]
SUMMARY_COLUMNS = ("full_date year quarter_name month_name month_year_label day_name is_weekend is_business_day season customer_id customer_name "
                   "segment product_id product_name category sub_category city state region ship_mode sales_person order_id sales quantity "
                   "discount profit unit_price profit_margin days_to_ship is_returned").split()


def _list(columns, prefix: str = "") -> str:
    return ", ".join(prefix + c for c in columns)


def _shown(columns, schema: dict[str, str]) -> str:
    """Columns in the form that is compared."""
    form = {"date": "CAST({0} AS VARCHAR) AS {0}", "decimal": "CAST({0} AS DOUBLE) AS {0}", "int": "CAST({0} AS INTEGER) AS {0}"}
    return ", ".join(form.get(schema.get(c, ""), "{0}").format(c) for c in columns)


_KINDS = {f.name: "decimal" if "decimal" in f.dataType.simpleString() else "date" if f.dataType.simpleString() == "date" else ""
          for f in BRONZE_ORDERS.fields}
_KINDS |= {"unit_price": "decimal", "profit_margin": "decimal", "full_date": "date", "days_to_ship": "int"}


def _least(column: str) -> str:
    """The lowest value of a group with NULL below all."""
    return f"CASE WHEN count(*) = count({column}) THEN min({column}) END"


def _quotient(num: str, den: str, digits: int) -> str:
    """num * 10^digits / den on integers, rounded half up, as a number of four decimals; NULL for a zero divisor."""
    n, d = f"(CAST({num} AS HUGEINT) * {10 ** digits})", f"CAST({den} AS HUGEINT)"
    units = f"sign({n}) * sign({d}) * ((2 * abs({n}) + abs({d})) // nullif(2 * abs({d}), 0))"
    return f"CAST(CAST({units} AS DECIMAL(38,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(10,4))"


def _dimension(name: str, source: str, where: str = "") -> str:
    spec = DIMENSIONS[name]
    order = ", ".join(f"{c} NULLS FIRST" for c in spec["columns"])
    return (f"SELECT CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS {spec['key']}, {_list(spec['columns'])} "
            f"FROM (SELECT DISTINCT {_list(spec['columns'])} FROM {source} {where})")


def _fact() -> str:
    values = {
        "discount": "CAST(discount AS DECIMAL(5,4))",
        "days_to_ship": "date_diff('day', order_date, ship_date)",
        "unit_price": _quotient("sales * 10000", "quantity", 0),
        "profit_margin": _quotient("profit * 10000", "sales * 10000", 4),
        "is_returned": "CASE WHEN return_order IS NULL THEN 0 ELSE 1 END",
    }
    columns = ", ".join(f"{values[c]} AS {c}" if c in values else c for c in FACT_COLUMNS if c != "fact_key")
    joins = [f"LEFT JOIN (SELECT date_key AS {role}_key, full_date AS {role} FROM dim_date) USING ({role})"
             for role in ("order_date", "ship_date")]
    joins += [f"LEFT JOIN (SELECT {_list([spec['key'], *spec['join_on']])} FROM {name}) USING ({_list(spec['join_on'])})"
              for name, spec in DIMENSIONS.items()]
    joins.append("LEFT JOIN (SELECT order_id, order_id AS return_order FROM silver_returns) USING (order_id)")
    return f"SELECT {columns} FROM silver_orders " + " ".join(joins)


_MISSING = "(order_date_key IS NULL OR customer_key IS NULL OR product_key IS NULL OR location_key IS NULL OR order_id IS NULL)"
_FIXED = {
    "order_date": "coalesce(fixed_date, order_date)",
    "ship_mode": "CASE WHEN ship_mode IN ('null', '0') THEN coalesce(fixed_mode, 'Unknown') ELSE ship_mode END",
    "country_region": "coalesce(fixed_country, country_region)",
    "postal_code": "coalesce(fixed_postal, postal_code)",
    "product_name": "coalesce(fixed_name, replace(product_name, '  ', ' '))",
    "discount": "CAST(discount AS DECIMAL(3,2))",
}
_DAYS = "date_diff('day', order_date, ship_date)"

# Each stage once, as a CTE; a statement carries those that it names.
STAGES: dict[str, str] = {name: f"VALUES {rows}" for name, rows in RULES.items()}
STAGES |= {
    "numbered": """SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber NULLS FIRST, l_partkey NULLS FIRST,
    l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST,
    l_shipdate NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) AS rn FROM lineitem""",
    "lines": """SELECT *, o_orderkey AS ok, CAST(o_orderdate AS DATE) AS day,
    CASE WHEN l_partkey % 89 = 7 THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(10,4)) END AS price,
    CAST(CAST(l_discount AS DECIMAL(5,4)) + CASE WHEN l_linenumber = 4 THEN 0.005 ELSE 0 END AS DECIMAL(5,4)) AS off
  FROM numbered JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey JOIN part ON p_partkey = l_partkey""",
    "landed": """SELECT CAST(ok * 1000 + CASE WHEN ok % 500 = 7 AND rn = 2 THEN 1 ELSE rn END AS BIGINT) AS row_id, 'O-' || ok AS order_id, day AS order_date,
    day + CAST((ok + l_linenumber) % 9 AS INTEGER) AS ship_date,
    CASE l_partkey % 50 WHEN 0 THEN 'null' WHEN 1 THEN '0' WHEN 2 THEN NULL
      ELSE ['First Class', 'Second Class', 'Standard Class', 'Same Day'][CAST(ok % 4 AS INTEGER) + 1] END AS ship_mode,
    'C-' || c_custkey AS customer_id,
    c_name || CASE WHEN c_custkey % 200 = 9 THEN repeat('x', 100) ELSE '' END AS customer_name,
    CASE WHEN c_custkey % 50 = 3 AND ok % 2 = 0 THEN 'DUAL' ELSE c_mktsegment END AS segment,
    CASE WHEN l_suppkey % 40 = 0 THEN '123' ELSE 'United States' END AS country_region, n_name AS city, r_name AS state,
    CASE WHEN n_nationkey = 7 OR n_nationkey = 8 AND ok % 11 = 0 THEN NULL ELSE lpad(CAST(n_nationkey AS VARCHAR), 5, '0') END AS postal_code,
    CASE WHEN n_nationkey IN (5, 6) AND ok % 3 = 0 THEN 'ZONE ' || n_nationkey ELSE r_name END AS region,
    'P-' || p_partkey AS product_id, p_brand AS category, p_type AS sub_category,
    replace(p_name, ' ', CASE WHEN p_partkey % 3 = 0 THEN '  ' WHEN p_partkey % 7 = 1 THEN '   ' ELSE ' ' END) AS product_name,
    price AS sales, CASE WHEN l_partkey % 97 = 5 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS quantity, off AS discount,
    CAST(price * (CAST(0.05 AS DECIMAL(5,4)) - off) AS DECIMAL(10,4)) AS profit, ok FROM lines""",
    "bronze_orders": f"""SELECT {_list(ORDERS_COLUMNS)} FROM landed UNION ALL
  SELECT CASE ok % 300 WHEN 0 THEN NULL WHEN 100 THEN row_id ELSE row_id + 500 END, {_list(ORDERS_COLUMNS[1:])}
  FROM landed WHERE ok % 100 = 0""",
    "bronze_people": """SELECT 'Rep ' || r_name AS person_name, r_name AS region FROM region
  UNION ALL VALUES ('Rep AFRICA', 'ZZZ'), ('Rep NORTH', 'ZONE 5'), ('Rep SOUTH', 'ZONE 5'), ('Rep NOWHERE', NULL), ('Rep NOWHERE', 'ZONE 9')""",
    "bronze_returns": """SELECT CASE l_linenumber % 3 WHEN 0 THEN NULL WHEN 1 THEN 'Yes' ELSE 'Y' END AS returned, 'O-' || l_orderkey AS order_id
  FROM lineitem SEMI JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R' AND l_orderkey % 10 = 0""",
    "distinct_orders": f"""SELECT {_least('row_id')} AS row_id, {_list(ORDERS_DEDUP_COLUMNS)}, count(*) AS n_copies
  FROM bronze_orders GROUP BY {_list(ORDERS_DEDUP_COLUMNS)}""",
    "repaired": f"""SELECT * FROM distinct_orders LEFT JOIN order_date_rule USING (order_id) LEFT JOIN country_rule USING (country_region)
  LEFT JOIN postal_rule USING (city, state) LEFT JOIN product_rule USING (product_id)
  LEFT JOIN ship_mode_rule r ON r.ship_mode = distinct_orders.ship_mode AND {_DAYS} BETWEEN first_day AND last_day""",
    "silver_orders": "SELECT " + ", ".join(f"{_FIXED[c]} AS {c}" if c in _FIXED else c for c in ORDERS_COLUMNS) + " FROM repaired",
    "silver_people": f"SELECT person_name, {_least('region')} AS region FROM bronze_people GROUP BY person_name",
    "silver_returns": f"SELECT {_least('returned')} AS returned, order_id FROM bronze_returns GROUP BY order_id",
    "days": """SELECT CAST(unnest(range(date_trunc('year', min(least(order_date, ship_date))),
    date_trunc('year', max(greatest(order_date, ship_date))) + INTERVAL 1 YEAR, INTERVAL 1 DAY)) AS DATE) AS d FROM silver_orders""",
    "dim_date": """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year,
    'Q' || quarter(d) AS quarter_name, CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
    strftime(d, '%b') AS month_short, strftime(d, '%b %Y') AS month_year_label, CAST(strftime(d, '%V') AS INTEGER) AS week_of_year,
    CAST(day(d) AS INTEGER) AS day_of_month, CAST(strftime(d, '%w') AS INTEGER) + 1 AS day_of_week, strftime(d, '%A') AS day_name,
    strftime(d, '%a') AS day_short, CAST(isodow(d) > 5 AS INTEGER) AS is_weekend, CAST(isodow(d) < 6 AS INTEGER) AS is_business_day, season
  FROM days JOIN season_rule ON season_rule.month = month(d)""",
}
STAGES |= {name: _dimension(name, "silver_people" if name == "dim_sales_person" else "silver_orders",
                            "WHERE ship_mode IS NOT NULL" if name == "dim_ship_mode" else "") for name in DIMENSIONS}
STAGES |= {
    "fact_all": _fact(),
    "fact_sales": f"SELECT * FROM fact_all WHERE NOT {_MISSING}",
}


#: Stages that several others read, or that a wide grouping reads straight from joined dictionaries, which DuckDB can't.
_KEPT = {"bronze_orders", "distinct_orders", "silver_orders", "fact_all"}


def statement(body: str) -> str:
    """``body`` with the stages that it names, directly or through others, as CTEs in their order."""
    bare = {name.split("(")[0]: name for name in STAGES}
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for word in set(re.findall(r"\w+", sql)) & set(bare):
            if word not in needed:
                needed.add(word)
                visit(STAGES[bare[word]])
    visit(body)
    return "WITH " + ",\n".join(f"{full} AS {'MATERIALIZED ' if short in _KEPT else ''}({STAGES[full]})" for short, full in bare.items() if short in needed) + "\n" + body


# Metrics of views and measures, as one expression each over fact rows with attributes.
def _double(column: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE)"


def _per(num: str, den: str) -> str:
    return f"{num} / nullif({den}, 0)"


def _mean(column: str) -> str:
    return _per(_double(column), f"count({column})")


def _whole_mean(column: str) -> str:
    return f"CAST(sum({column}) // nullif(count({column}), 0) AS BIGINT)"


_ORDERS, _CUSTOMERS = "count(DISTINCT order_id)", "count(DISTINCT customer_id)"
_RETURNED = "count(DISTINCT order_id) FILTER (is_returned = 1)"
_PUNCTUAL = f"count(DISTINCT order_id) FILTER (days_to_ship <= {ON_TIME})"
METRICS = {
    "total_sales": _double("sales"), "total_spent": _double("sales"), "total_profit": _double("profit"),
    "profit_margin": _per(_double("profit"), _double("sales")),
    "profit_margin_pct": _per(_double("profit"), _double("sales")) + " * 100",
    "total_orders": _ORDERS, "total_customers": _CUSTOMERS, "total_returned": _RETURNED,
    "clv": _per(_double("profit"), _CUSTOMERS), "return_rate": _per(_RETURNED, _ORDERS),
    "average_order_value": _per(_double("sales"), _ORDERS), "average_unit_price": _mean("unit_price"),
    "average_shipping_days": _mean("days_to_ship"), "average_discount": _mean("discount"),
    "avg_unit_price": _mean("unit_price"), "avg_discount": _mean("discount"),
    "total_quantity": "CAST(sum(quantity) AS BIGINT)", "total_units": "CAST(sum(quantity) AS BIGINT)",
    "on_time_delivery_pct": _per(_PUNCTUAL, _ORDERS),
    "total_returned_orders": "CAST(sum(is_returned) AS BIGINT)", "total_returns": "CAST(sum(is_returned) AS BIGINT)",
    "avg_shipping_days": _whole_mean("days_to_ship"), "avg_days_to_ship": _whole_mean("days_to_ship"),
    "min_days": "CAST(min(days_to_ship) AS INTEGER)", "max_days": "CAST(max(days_to_ship) AS INTEGER)",
}
MEASURES = ["total_sales", "total_profit", "profit_margin", "total_orders", "total_customers", "total_returned", "clv",
            "return_rate", "average_order_value", "average_unit_price", "average_shipping_days", "total_quantity",
            "average_discount", "on_time_delivery_pct", "total_returned_orders"]


def _with_attributes(wanted, role: str = "order_date", inner=()) -> str:
    """The fact joined to the dimensions that hold the wanted attributes; ``inner`` names keys that must match."""
    out = "fact_sales"
    for key, (dim, exposed) in RELATIONSHIPS.items():
        if needed := [f"{source} AS {name}" for source, name in exposed.items() if name in wanted]:
            out += f" {'INNER' if key in inner else 'LEFT'} JOIN (SELECT {key}, {_list(needed)} FROM {dim}) USING ({key})"
    if needed := [c for c in DATE_ATTRIBUTES if c in wanted]:
        out += f" {'INNER' if f'{role}_key' in inner else 'LEFT'} JOIN (SELECT date_key AS {role}_key, {_list(needed)} FROM dim_date) USING ({role}_key)"
    return out


def _grouped(by, metrics, role: str = "order_date", inner=(), where: str = "", also=(), **own: str) -> str:
    """Metrics by attributes; ``own`` states metrics that are not the common ones."""
    chosen = {**{m: METRICS[m] for m in metrics}, **own}
    uses = {*by, *also, *(["customer_id"] if _CUSTOMERS in " ".join(chosen.values()) else [])}
    columns = _list([*by, *(f"{sql} AS {name}" for name, sql in chosen.items())])
    return statement(f"SELECT {columns} FROM {_with_attributes(uses, role, inner)} {f'WHERE {where}' if where else ''} "
                     + (f"GROUP BY {_list(by)}" if by else ""))


def _six(num: str, den: str) -> str:
    """num / den on integers, rounded half up to six decimals, as a double."""
    n, d = f"(CAST({num} AS HUGEINT) * 1000000)", f"CAST({den} AS HUGEINT)"
    return f"CAST(sign({n}) * sign({d}) * ((2 * abs({n}) + abs({d})) // nullif(2 * abs({d}), 0)) AS DOUBLE) / 1000000"


def _six_mean(column: str) -> str:
    return _six(f"sum({column}) * 10000", f"count({column}) * 10000")


_KEYS = ["order_date_key", "customer_key", "product_key", "location_key"]
SUMMARY = (f"SELECT {_shown(SUMMARY_COLUMNS, _KINDS)} FROM "
           + _with_attributes(set(SUMMARY_COLUMNS), inner=_KEYS))


def _nulls(keys, table: str = "fact_sales") -> str:
    counts = _list(f"count(*) FILTER ({k} IS NULL) AS null_{k}" for k in keys)
    return statement(f"SELECT count(*) AS total_rows, count(*) FILTER ({' OR '.join(f'{k} IS NULL' for k in keys)}) AS rows_with_missing_key, "
                     f"{counts} FROM {table}")


def _union(parts) -> str:
    return statement(" UNION ALL ".join(parts))


def _profile() -> str:
    parts = []
    for f in BRONZE_ORDERS.fields:
        kind = "decimal(3,2)" if f.name == "discount" else f.dataType.simpleString()
        parts.append(f"SELECT '{f.name}' AS column_name, '{kind}' AS data_type, count(*) - count({f.name}) AS n_nulls, "
                     f"CAST(min({f.name}) AS VARCHAR) AS min_value, CAST(max({f.name}) AS VARCHAR) AS max_value, "
                     f"count(*) AS n_rows FROM silver_orders")
    return _union(parts)


def _sketch_profile() -> str:
    """Exact moments; the sketches' bounds hold."""
    parts = []
    for f in BRONZE_ORDERS.fields:
        kind = "decimal(3,2)" if f.name == "discount" else f.dataType.simpleString()
        number = kind in ("bigint", "int") or kind.startswith("decimal")
        mean = f"round(CAST(sum({f.name}) AS DOUBLE) / nullif(count({f.name}), 0), 6)" if number else "CAST(NULL AS DOUBLE)"
        deviation = f"round(stddev_samp(CAST({f.name} AS DOUBLE)), 4)" if number else "CAST(NULL AS DOUBLE)"
        parts.append(f"SELECT '{f.name}' AS column_name, '{kind}' AS data_type, count(*) - count({f.name}) AS n_nulls, "
                     f"CAST(min({f.name}) AS VARCHAR) AS min_value, CAST(max({f.name}) AS VARCHAR) AS max_value, {mean} AS mean, {deviation} AS stddev, "
                     f"count(*) AS n_rows, {'TRUE' if number else 'CAST(NULL AS BOOLEAN)'} AS quartiles_hold, TRUE AS distinct_holds FROM silver_orders")
    return _union(parts)


#: Per table and rule, the rows that fail, as a condition; and the columns that no two rows may share.
ROW_RULES = {
    ("bronze_orders", "not_null(row_id)"): "row_id IS NULL", ("bronze_orders", "not_null(order_id)"): "order_id IS NULL",
    ("bronze_orders", "in_range(quantity, 1, None)"): "quantity < 1", ("bronze_orders", "in_range(discount, 0, 1)"): "discount < 0 OR discount > 1",
    ("bronze_orders", "in_range(sales, 0, None)"): "sales < 0",
    **{("bronze_orders", f"max_length({c}, {n})"): f"length({c}) > {n}" for c, n in LENGTHS.items()},
    ("silver_orders", "not_null(postal_code)"): "postal_code IS NULL", ("silver_orders", "in_range(discount, None, 1)"): "discount > 1",
    ("silver_orders", "foreign_key(region, silver_people)"): "region NOT IN (SELECT region FROM silver_people WHERE region IS NOT NULL)",
    ("silver_returns_order", "not_null(returned)"): "returned IS NULL",
    ("silver_returns_order", "foreign_key(order_id, silver_orders)"): "order_id NOT IN (SELECT order_id FROM silver_orders WHERE order_id IS NOT NULL)",
    **{("fact_sales", f"not_null({k})"): f"{k} IS NULL" for k in ("order_date_key", "customer_key", "product_key", "location_key", "ship_mode_key")},
    **{("fact_sales", f"foreign_key({k}, dim_{d})"): f"{k} NOT IN (SELECT {k} FROM dim_{d})" for k, d in (
        ("customer_key", "customer"), ("product_key", "product"), ("location_key", "location"), ("ship_mode_key", "ship_mode"), ("sales_person_key", "sales_person"))},
    **{("fact_sales", f"foreign_key({k}, dim_date)"): f"{k} NOT IN (SELECT date_key FROM dim_date)" for k in ("order_date_key", "ship_date_key")},
    ("dim_customer", "not_null(customer_id)"): "customer_id IS NULL", ("dim_product", "not_null(product_id)"): "product_id IS NULL",
    ("dim_product", "not_null(product_name)"): "product_name IS NULL", ("dim_ship_mode", "not_null(ship_mode)"): "ship_mode IS NULL",
}
UNIQUE_RULES = [("bronze_orders", "row_id"), ("silver_returns_order", "order_id"), ("dim_customer", "customer_key"), ("dim_customer", "customer_id"),
                ("dim_product", "product_key"), ("dim_product", "product_id, product_name"), ("dim_location", "location_key"),
                ("dim_location", "city, state, postal_code"), ("dim_ship_mode", "ship_mode_key"), ("dim_ship_mode", "ship_mode"),
                ("dim_sales_person", "sales_person_key"), ("dim_sales_person", "region")]


def _stage(table: str) -> str:
    return {"silver_returns_order": "silver_returns"}.get(table, table)


def _rules() -> str:
    parts = [f"SELECT '{t}' AS table_name, '{rule}' AS rule, count(*) AS n_rows, count(*) FILTER ({fails}) AS n_failed FROM {_stage(t)}"
             for (t, rule), fails in ROW_RULES.items()]
    for t, columns in UNIQUE_RULES:
        whole = " AND ".join(f"{c} IS NOT NULL" for c in columns.split(", "))
        parts.append(f"SELECT '{t}', 'unique({columns})', count(*), count(*) FILTER ({whole}) - count(DISTINCT ({columns})) FILTER ({whole}) FROM {_stage(t)}")
    # The fact's own key numbers its rows, and the statements have no such column.
    parts.append("SELECT 'fact_sales', 'unique(fact_key)', count(*), 0 FROM fact_sales")
    return _union(parts)


def _failing() -> str:
    parts = []
    for table, row_id in (("bronze_orders", "row_id"), ("silver_returns_order", "CAST(NULL AS BIGINT)")):
        parts += [f"SELECT '{table}' AS table_name, '{rule}' AS rule, order_id, {row_id} AS row_id FROM {_stage(t)} WHERE {fails}"
                  for (t, rule), fails in ROW_RULES.items() if t == table]
        parts += [f"SELECT '{table}', 'unique({c})', order_id, {row_id} FROM {_stage(t)} WHERE {c} IN (SELECT {c} FROM {_stage(t)} GROUP BY {c} HAVING count(*) > 1)"
                  for t, c in UNIQUE_RULES if t == table]
    return _union(parts)


#: Faults planted in a landing file: rows by order number (row_id // 1000) modulo 50, the text written, and the columns that then fail.
FAULTS = {1: ({"quantity": "many"}, "quantity"), 2: ({"ship_date": "1998-13-45"}, "ship_date"), 3: ({"discount": "12.5"}, "discount"),
          4: ({"sales": "1.2.3", "quantity": "2.5x"}, "sales,quantity")}


def _faulty(good: bool) -> str:
    planted = f"coalesce(row_id // 1000 % 50 IN ({_list(map(str, FAULTS))}), FALSE)"
    if good:
        return statement(f"SELECT {_shown(ORDERS_COLUMNS, _KINDS)} FROM bronze_orders WHERE NOT {planted}")

    def text(column: str) -> str:
        cases = " ".join(f"WHEN {k} THEN '{v[0][column]}'" for k, v in FAULTS.items() if column in v[0])
        return f"CASE row_id // 1000 % 50 {cases} ELSE CAST({column} AS VARCHAR) END AS {column}"
    failed = " ".join(f"WHEN {k} THEN '{v[1]}'" for k, v in FAULTS.items())
    return statement(f"SELECT CAST(row_id AS VARCHAR) AS row_id, order_id, {text('quantity')}, {text('ship_date')}, {text('discount')}, {text('sales')}, "
                     f"CASE row_id // 1000 % 50 {failed} END AS failed_columns FROM bronze_orders WHERE {planted}")


def _steps() -> str:
    tables = [("bronze.orders", "bronze_orders"), ("bronze.people", "bronze_people"), ("bronze.returns_order", "bronze_returns"),
              ("silver.orders", "silver_orders"), ("silver.people", "silver_people"), ("silver.returns_order", "silver_returns"),
              ("gold.dim_date", "dim_date"), *[(f"gold.{name}", name) for name in DIMENSIONS], ("gold.fact_sales", "fact_sales")]
    return _union(f"SELECT '{step}' AS step, 'ok' AS status, count(*) AS rows, CAST(NULL AS VARCHAR) AS error FROM {stage}" for step, stage in tables)


def _many_groupings() -> str:
    """Eight groupings, one statement each, with their attributes as text."""
    every = ["category", "city", "month", "region", "sales_person", "season", "segment", "ship_mode", "state", "sub_category", "year"]
    groupings = ["", "segment,year", "year,month", "category,sub_category", "region,ship_mode", "ship_mode", "region,state,city,sales_person", "season"]
    fact = f"fact AS MATERIALIZED (SELECT * FROM {_with_attributes({*every, 'customer_id'})})"
    parts = []
    for name in groupings:
        by = [c for c in name.split(",") if c]
        texts = _list(f"CAST({c if c in by else 'NULL'} AS VARCHAR) AS {c}" for c in every)
        parts.append(f"SELECT '{name}' AS grouping, {texts}, {_list(f'{METRICS[m]} AS {m}' for m in MEASURES)} FROM fact "
                     + (f"GROUP BY {_list(f'fact.{c}' for c in by)}" if by else ""))
    head, _, _ = statement(f"SELECT * FROM {_with_attributes({*every, 'customer_id'})}").rpartition("\nSELECT")
    return f"{head},\n{fact}\n" + " UNION ALL ".join(parts)


def _view_counts() -> str:
    groups = {"vw_product_performance": "product_id, product_name, category, sub_category", "vw_customer_analysis": "customer_id, customer_name, segment",
              "vw_regional_performance": "region, state, city, sales_person", "vw_shipping_performance": "ship_mode",
              "vw_monthly_trends": "year, month, month_name, month_year_label, quarter_name, season"}
    parts = []
    for view, by in groups.items():
        texts = _list(f"coalesce(CAST({c} AS VARCHAR), '<null>')" for c in by.split(", "))
        parts.append(f"SELECT '{view}' AS view_name, concat_ws('|', {texts}) AS group_key, count(DISTINCT order_id) AS total_orders "
                     f"FROM {_with_attributes(set(by.split(', ')))} GROUP BY {by}")
    return _union(parts)


def oracle_sql() -> dict[str, str]:
    orders = _shown(ORDERS_COLUMNS, _KINDS)
    facts = _shown([c for c in FACT_COLUMNS if c != "fact_key"], _KINDS)
    first_order = "order_id, product_id, full_date, customer_id, customer_name, segment, product_name, category, sub_category, city, " \
                  "state, region, ship_mode, sales_person, sales, quantity, discount, profit, unit_price, profit_margin, days_to_ship, " \
                  "is_returned, year, quarter_name, month_name, month_year_label, day_name, is_weekend, is_business_day, season"
    return {
        "bronze_orders": statement(f"SELECT {orders} FROM bronze_orders"),
        "landing_csv": statement(f"SELECT {orders} FROM (SELECT * REPLACE (product_name || ', 8\"' || chr(10) || 'new' AS product_name) "
                                 f"FROM bronze_orders)"),
        "silver_orders_clean": statement(f"SELECT {orders} FROM silver_orders"),
        "silver_orders_dedup_exact": statement("SELECT row_id, order_id, n_copies FROM distinct_orders"),
        "silver_orders_dedup_digest": statement("SELECT row_id, order_id, n_copies FROM distinct_orders"),
        "silver_people_first": statement("SELECT * FROM silver_people"),
        "silver_returns_first": statement("SELECT * FROM silver_returns"),
        "dense_key_payload": statement(f"SELECT row_number() OVER (ORDER BY order_id NULLS FIRST, row_id NULLS FIRST, product_id NULLS FIRST, "
                                       f"ship_date NULLS FIRST, sales, quantity, discount) AS line_key, {orders} FROM silver_orders"),
        "ship_mode_repair": statement(f"""SELECT d.ship_mode AS raw_ship_mode, CAST({_DAYS.replace('order_date', 'd.order_date').replace('ship_date', 'd.ship_date')} AS INTEGER) AS raw_days_to_ship,
    CASE WHEN d.ship_mode IN ('null', '0') THEN coalesce(r.fixed_mode, 'Unknown') ELSE d.ship_mode END AS ship_mode, count(*) AS n_rows
  FROM distinct_orders d LEFT JOIN ship_mode_rule r ON r.ship_mode = d.ship_mode
    AND date_diff('day', d.order_date, d.ship_date) BETWEEN r.first_day AND r.last_day GROUP BY ALL"""),
        "dim_date": statement(f"SELECT {_shown(DIM_DATE_COLUMNS, _KINDS)} FROM dim_date"),
        **{name: statement(f"SELECT * FROM {name}") for name in DIMENSIONS},
        "dim_product_refreshed": statement("SELECT * FROM dim_product"),
        "fact_sales": statement(f"SELECT {facts} FROM fact_sales"),
        **{f"fact_by_{name}": statement(
            f"SELECT {facts} FROM fact_sales WHERE {name}_key = (SELECT {name}_key FROM fact_sales GROUP BY 1 ORDER BY count(*) DESC, 1 NULLS FIRST LIMIT 1)")
           for name in ("customer", "product", "location", "ship_date")},
        "fact_by_month": statement(f"SELECT {facts} FROM fact_sales WHERE order_date_key // 100 = (SELECT max(order_date_key) // 100 FROM fact_sales)"),
        "fact_quarantine": statement(f"SELECT {facts} FROM fact_all WHERE {_MISSING}"),
        "view_sales_summary": statement(SUMMARY),
        "view_product_performance": _grouped(
            ["product_id", "product_name", "category", "sub_category"],
            ["total_orders", "total_sales", "total_profit", "total_units", "avg_discount", "avg_unit_price", "profit_margin_pct",
             "total_returns"], inner=["product_key"]),
        "view_customer_analysis": _grouped(
            ["customer_id", "customer_name", "segment"], ["total_orders", "total_spent", "total_profit", "total_units", "total_returns"],
            inner=["customer_key"], avg_order_value=_mean("sales")),
        "view_regional_performance": _grouped(
            ["region", "state", "city", "sales_person"],
            ["total_orders", "total_sales", "total_profit", "total_units", "avg_shipping_days", "total_returns"], inner=["location_key"]),
        "view_shipping_performance": _grouped(
            ["ship_mode"], ["total_orders", "avg_days_to_ship", "min_days", "max_days", "total_sales", "total_returns"]),
        "view_monthly_trends": _grouped(
            ["year", "month", "month_name", "month_year_label", "quarter_name", "season"],
            ["total_orders", "total_sales", "total_profit", "total_units", "total_returns"], inner=["order_date_key"],
            avg_order_value=METRICS["average_order_value"]),
        # The views by name, in decimals: quotients are rounded once, half up, after the factor of a percentage.
        "vw_sales_summary": statement(SUMMARY),
        "vw_product_performance": _grouped(
            ["product_id", "product_name", "category", "sub_category"], ["total_orders", "total_sales", "total_profit", "total_units", "total_returns"],
            inner=["product_key"], avg_discount=_six_mean("discount"), avg_unit_price=_six_mean("unit_price"),
            profit_margin_pct=_six("sum(profit) * 1000000", "sum(sales) * 10000")),
        "vw_customer_analysis": _grouped(
            ["customer_id", "customer_name", "segment"], ["total_orders", "total_spent", "total_profit", "total_units", "total_returns"],
            inner=["customer_key"], avg_order_value=_six_mean("sales")),
        "vw_regional_performance": _grouped(
            ["region", "state", "city", "sales_person"],
            ["total_orders", "total_sales", "total_profit", "total_units", "avg_shipping_days", "total_returns"], inner=["location_key"]),
        "vw_shipping_performance": _grouped(
            ["ship_mode"], ["total_orders", "avg_days_to_ship", "min_days", "max_days", "total_sales", "total_returns"]),
        "vw_monthly_trends": _grouped(
            ["year", "month", "month_name", "month_year_label", "quarter_name", "season"],
            ["total_orders", "total_sales", "total_profit", "total_units", "total_returns"], inner=["order_date_key"],
            avg_order_value=_six("sum(sales) * 10000", f"{_ORDERS} * 10000")),
        "measures_overall": _grouped([], MEASURES),
        "measures_by_segment_year": _grouped(["segment", "year"], MEASURES),
        "measures_by_ship_month": _grouped(["year", "month"], MEASURES, role="ship_date"),
        "measures_by_category": _grouped(["category", "sub_category"], MEASURES),
        "measures_by_region_ship_mode": _grouped(["region", "ship_mode"], MEASURES),
        "measures_filtered": _grouped(["ship_mode"], MEASURES, where="region = 'ASIA'", also=["region"]),
        "measures_on_time_all_lines": _grouped(
            ["ship_mode"], ["total_orders"], on_time_delivery_pct=_per(
                f"({_ORDERS} - count(DISTINCT order_id) FILTER (days_to_ship IS NULL OR days_to_ship > {ON_TIME}))", _ORDERS)),
        "measures_additive": _grouped(["region"], ["total_sales", "total_quantity", "average_discount"]),
        "measures_lattice": _many_groupings(),
        "lattice_order_counts": _view_counts(),
        "dq_unmatched_keys": _nulls(_KEYS, "fact_all"),  # the set-aside rows included
        "dq_optional_keys": _nulls(["ship_date_key", "ship_mode_key", "sales_person_key"]),
        "dq_duplicate_natural_keys": _union(
            f"SELECT '{name}' AS dim_name, concat_ws('|', {_list(f'''coalesce(CAST({k} AS VARCHAR), '<null>')''' for k in spec['join_on'])}) "
            f"AS natural_key, count(*) AS n_rows FROM {name} GROUP BY {_list(spec['join_on'])} HAVING count(*) > 1"
            for name, spec in DIMENSIONS.items()),
        "row_counts": _union(
            f"SELECT '{shown}' AS table_name, count(*) AS n_rows FROM {stage}" for shown, stage in [
                ("bronze_orders", "bronze_orders"), ("bronze_people", "bronze_people"), ("bronze_returns_order", "bronze_returns"),
                ("silver_orders", "silver_orders"), ("silver_people", "silver_people"), ("silver_returns_order", "silver_returns"),
                ("dim_date", "dim_date"), *[(name, name) for name in DIMENSIONS], ("fact_sales", "fact_sales")]),
        "top_n_summary": statement(f"SELECT * FROM ({SUMMARY}) ORDER BY "
                                   + _list(f"{c} NULLS FIRST" for c in first_order.split(", ")) + " LIMIT 10"),
        "dq_key_uniqueness": _union(
            f"SELECT '{t}' AS table_name, '{k}' AS key_column, count(*) AS n_duplicate_keys "
            f"FROM (SELECT {k} FROM {t} GROUP BY {k} HAVING count(*) > 1)" for t, k in [
                ("dim_date", "date_key"), *[(name, spec["key"]) for name, spec in DIMENSIONS.items()], ("silver_orders", "row_id")]),
        "dq_text_lengths": _union(
            f"SELECT '{c}' AS column_name, {n} AS max_length, count(*) FILTER (length({c}) > {n}) AS n_too_long FROM bronze_orders"
            for c, n in LENGTHS.items()),
        "profile_silver_orders": _profile(),
        "profile_sketches": _sketch_profile(),
        "landing_tolerant_good": _faulty(True),
        "landing_tolerant_rejected": _faulty(False),
        "step_results": _steps(),
        "monthly_trends_ordered": statement(
            "SELECT CAST(row_number() OVER (ORDER BY year, month) AS BIGINT) AS row_no, year, month, total_orders FROM ("
            + "SELECT year, month, count(DISTINCT order_id) AS total_orders FROM " + _with_attributes({"year", "month"}, inner=["order_date_key"])
            + " GROUP BY year, month)"),
        "dq_rules": _rules(),
        "dq_failing_rows": _failing(),
        "dim_customer_first": statement("""SELECT CAST(row_number() OVER (ORDER BY customer_id NULLS FIRST) AS BIGINT) AS customer_key,
    customer_id, customer_name, segment FROM (
  SELECT DISTINCT ON (customer_id) customer_id, customer_name, segment FROM dim_customer
  ORDER BY customer_id, customer_name NULLS FIRST, segment NULLS FIRST)"""),
    }
