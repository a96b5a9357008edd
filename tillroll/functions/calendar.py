"""Calendar attributes as built-in column expressions (all codegen-able)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.rules import SEASONS


def date_key(d: Column) -> Column:
    """YYYYMMDD as int, computed arithmetically (no string round trip)."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def quarter_name(d: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"))


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def month_short(d: Column) -> Column:
    return F.substring(F.date_format(d, "MMMM"), 1, 3)


def month_year_label(d: Column) -> Column:
    return F.concat(month_short(d), F.lit(" "), F.year(d).cast("string"))


def iso_week(d: Column) -> Column:
    return F.weekofyear(d)


def day_of_week(d: Column) -> Column:
    """Sunday = 1 ... Saturday = 7."""
    return F.dayofweek(d)


def day_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def day_short(d: Column) -> Column:
    return F.substring(F.date_format(d, "EEEE"), 1, 3)


def is_weekend(d: Column) -> Column:
    return F.when(F.dayofweek(d).isin(1, 7), F.lit(1)).otherwise(F.lit(0))


def is_business_day(d: Column) -> Column:
    return F.when(F.dayofweek(d).isin(1, 7), F.lit(0)).otherwise(F.lit(1))


def season(month: Column) -> Column:
    expr = None
    for name, months in SEASONS.items():
        cond = month.isin(*months)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def calendar_columns(d: Column) -> list[Column]:
    """The sixteen date-dimension columns, in declared order."""
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        quarter_name(d).alias("quarter_name"),
        F.month(d).alias("month"),
        month_name(d).alias("month_name"),
        month_short(d).alias("month_short"),
        month_year_label(d).alias("month_year_label"),
        iso_week(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        day_of_week(d).alias("day_of_week"),
        day_name(d).alias("day_name"),
        day_short(d).alias("day_short"),
        is_weekend(d).alias("is_weekend"),
        is_business_day(d).alias("is_business_day"),
        season(F.month(d)).alias("season"),
    ]
