"""Dimension lookups (J1-J16) with a size-checked broadcast.

A dimension is broadcast only when its row count is known -- from the
observed count of its write, or from a bound such as the number of days in
the date range -- and ``rows x estimated row width`` is below the limit.
Otherwise the plain join is left to the planner: sort-merge, re-planned by
AQE from runtime sizes, with skewed partitions split by AQE's skew join.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.dedup import marked_by
from tillroll.schemas import TEXT_LENGTHS

# Widths per type, in bytes.  Text takes its declared length, at two bytes a
# character on average, where the model declares one, else 255 characters.
_TYPE_BYTES = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4,
    T.LongType: 8, T.FloatType: 4, T.DoubleType: 8, T.DateType: 4,
    T.TimestampType: 8, T.TimestampNTZType: 8,
}
_LENGTHS = {c: n for table in TEXT_LENGTHS.values() for c, n in table.items()}
_DEFAULT_LENGTH, _CHAR_BYTES = 255, 2
_ROW_OVERHEAD = 16
DEFAULT_BROADCAST_LIMIT = 10 * 1024 * 1024


def estimated_row_bytes(schema: T.StructType) -> int:
    total = _ROW_OVERHEAD
    for field in schema.fields:
        dtype = field.dataType
        if isinstance(dtype, T.DecimalType):
            total += 8 if dtype.precision <= 18 else 16
        elif isinstance(dtype, T.StringType):
            total += _CHAR_BYTES * _LENGTHS.get(field.name, _DEFAULT_LENGTH)
        else:
            total += _TYPE_BYTES.get(type(dtype), 64)
    return total


_UNITS = {"": 1, "b": 1, "k": 1024, "kb": 1024, "m": 1024 ** 2, "mb": 1024 ** 2,
          "g": 1024 ** 3, "gb": 1024 ** 3, "t": 1024 ** 4, "tb": 1024 ** 4}


def size_in_bytes(text: str) -> int:
    """Spark size text ('10485760b', '64MB', '1g', '-1') as bytes."""
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", str(text))
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"not a size: {text!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def broadcast_limit(df: DataFrame, limit: int | None = None) -> int:
    """Bytes a proven dimension may take to be broadcast.

    The session's ``spark.sql.autoBroadcastJoinThreshold``; -1 switches
    broadcasts off here too.
    """
    if limit is not None:
        return limit
    try:
        return size_in_bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB"))
    except ValueError:
        return DEFAULT_BROADCAST_LIMIT


def fits_broadcast(df: DataFrame, rows: int | None, limit: int | None = None) -> bool:
    """True when a proven row count times the estimated width is under the limit."""
    if rows is None:
        return False
    most = broadcast_limit(df, limit)
    return most > 0 and rows * estimated_row_bytes(df.schema) <= most


def lookup(left: DataFrame, right: DataFrame, on: Sequence[str] | Column,
           how: str = "left", right_rows: int | None = None,
           limit: int | None = None) -> DataFrame:
    """Join ``right`` (a dimension) to ``left``; broadcast it only when proven small."""
    if fits_broadcast(right, right_rows, limit):
        right = F.broadcast(right)
    return left.join(right, on=list(on) if not isinstance(on, Column) else on, how=how)


def sparse_lookup(left: DataFrame, right: DataFrame, on: str, right_rows: int | None = None,
                  limit: int | None = None) -> DataFrame:
    """Left join of a table that matches few rows of ``left``: where it is not broadcast, only rows that can match move.

    ``left`` is read twice.  Keys with a collation take the plain way, as they hash by their bytes.
    """
    if right_rows is None or fits_broadcast(right, right_rows, limit) or any(
            isinstance(df.schema[on].dataType, T.StringType) and df.schema[on].dataType != T.StringType() for df in (left, right)):
        return lookup(left, right, [on], "left", right_rows, limit)
    marked = marked_by(left, F.xxhash64(on), right.select(F.xxhash64(on).alias("_d1")), right_rows)
    met = marked.where("_suspected").drop("_suspected").join(right, [on], "left")
    added = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields if f.name != on]
    return marked.where("NOT _suspected").select(*left.columns, *added).unionByName(met)


def order_date_lookup(fact: DataFrame, dim_date: DataFrame, columns: Sequence[str],
                      how: str = "inner", rows: int | None = None, limit: int | None = None) -> DataFrame:
    """Join date attributes on the order date key.

    When the fact is the published one, partitioned by ``order_year``, the
    year is added as a second, redundant join key (``date_key div 10000``):
    a filter on the date dimension then prunes whole fact partitions through
    dynamic partition pruning instead of scanning every year.
    """
    d = dim_date.select(F.col("date_key").alias("order_date_key"), *columns)
    keys = ["order_date_key"]
    if "order_year" in fact.columns:
        d = d.withColumn("order_year", F.expr("order_date_key div 10000").cast("int"))
        keys.append("order_year")
    return lookup(fact, d, keys, how, rows, limit)
