"""Safe division and the numeric result conventions of the warehouse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scale of decimal means and ratios (the original store caps them at 6).
RESULT_DECIMAL = "decimal(38,6)"


def nullif_zero(x: Column) -> Column:
    """NULL instead of zero, so a division yields NULL rather than an error."""
    return F.nullif(x, F.lit(0))


def safe_div(num: Column, den: Column) -> Column:
    return num / nullif_zero(den)


def unit_price(sales: Column, quantity: Column) -> Column:
    """Sales / quantity as DECIMAL(10,4); NULL when quantity is 0."""
    return safe_div(sales, quantity).cast("decimal(10,4)")


def profit_margin(profit: Column, sales: Column) -> Column:
    """Profit / sales as DECIMAL(10,4); NULL when sales is 0."""
    return safe_div(profit, sales).cast("decimal(10,4)")


def days_between(start: Column, end: Column) -> Column:
    """Whole days from start to end."""
    return F.datediff(end, start)


def int_mean(name: str) -> Column:
    """A4: mean of an integer column truncated toward zero (integer AVG)."""
    return F.expr(f"sum(`{name}`) div nullif(count(`{name}`), 0)")
