"""Silver cleansing rules as column expressions.

Every rule reads the *raw* column values: the ship-mode repair uses the
uncorrected order date although that date is corrected in the same step.
The rules therefore take raw columns and are applied in one ``select``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.rules import SilverRules


def _lookup(value: Column, mapping: dict, otherwise: Column) -> Column:
    """CASE value WHEN k1 THEN v1 ... ELSE otherwise (small literal tables)."""
    expr = None
    for key, replacement in mapping.items():
        cond = value == F.lit(key)
        expr = F.when(cond, F.lit(replacement)) if expr is None else expr.when(cond, F.lit(replacement))
    return otherwise if expr is None else expr.otherwise(otherwise)


def order_date(order_id: Column, raw_order_date: Column, rules: SilverRules) -> Column:
    """Override listed orders' dates."""
    return _lookup(order_id, rules.order_date_overrides, raw_order_date)


def derived_ship_mode(raw_order_date: Column, raw_ship_date: Column, rules: SilverRules) -> Column:
    """The ship mode implied by the shipping duration (raw dates)."""
    days = F.datediff(raw_ship_date, raw_order_date)
    low, high = rules.standard_class_days
    return (
        F.when(days <= rules.same_day_max_days, F.lit(rules.same_day_label))
        .when(days.between(low, high), F.lit(rules.standard_class_label))
        .otherwise(F.lit(rules.unknown_label))
    )


def ship_mode(raw_ship_mode: Column, raw_order_date: Column, raw_ship_date: Column,
              rules: SilverRules) -> Column:
    """Replace invalid ship modes by the one the duration implies."""
    invalid = raw_ship_mode.isin(*rules.invalid_ship_modes)
    if rules.treat_null_as_invalid:
        invalid = invalid | raw_ship_mode.isNull()
    return F.when(invalid, derived_ship_mode(raw_order_date, raw_ship_date, rules)).otherwise(raw_ship_mode)


def country_region(raw: Column, rules: SilverRules) -> Column:
    """Replace invalid country codes."""
    return _lookup(raw, rules.country_fixes, raw)


def postal_code(city: Column, state: Column, raw: Column, rules: SilverRules) -> Column:
    """Set the postal code of listed city/state pairs (missing or not)."""
    expr = None
    for (c, s), code in rules.postal_code_fixes.items():
        cond = (city == F.lit(c)) & (state == F.lit(s))
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return raw if expr is None else expr.otherwise(raw)


def product_name(product_id: Column, raw: Column, rules: SilverRules) -> Column:
    """P5 / F1: override listed product names, else one replace pass."""
    cleaned = F.replace(raw, F.lit(rules.product_name_search), F.lit(rules.product_name_replacement))
    return _lookup(product_id, rules.product_name_overrides, cleaned)


def narrow_discount(raw: Column) -> Column:
    """DECIMAL(3,2), rounding half up; values of 10 or more raise (ANSI)."""
    return raw.cast("decimal(3,2)")
