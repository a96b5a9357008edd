"""Data-quality checks.

Every check is one aggregate over the table; none collects rows.  The
pipeline evaluates the fact check on the staged fact through an
``Observation`` so it costs no extra pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DataQualityError(RuntimeError):
    """Raised when a check configured to fail finds offending rows."""


def null_count_columns(columns: Sequence[str], prefix: str = "null_") -> list[Column]:
    """count_if(c IS NULL) per column, as aggregate expressions."""
    return [F.count_if(F.col(c).isNull()).alias(f"{prefix}{c}") for c in columns]


def any_null(columns: Sequence[str]) -> Column:
    """A IS NULL OR b IS NULL ..."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns], F.lit(False))


def unmatched_keys(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q1/Q2: one row -- total rows, rows with any missing key, and NULLs per key."""
    return fact.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(any_null(keys)).alias("rows_with_missing_key"),
        *null_count_columns(keys),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q3/Q6: key values that occur more than once, with their row count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))


def text_length_violations(df: DataFrame, lengths: Mapping[str, int]) -> DataFrame:
    """Q5: per column, the number of values longer than the declared length."""
    present = [(c, n) for c, n in lengths.items() if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "column_name string, max_length int, n_too_long bigint")
    counts = df.agg(*[F.count_if(F.length(c) > n).alias(c) for c, n in present])
    stack = ", ".join(f"'{c}', {n}, `{c}`" for c, n in present)
    return counts.selectExpr(
        f"stack({len(present)}, {stack}) as (column_name, max_length, n_too_long)")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count (UNION ALL of counts)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"))
               .select(F.lit(name).alias("table_name"), F.col("n_rows").cast("long"))
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def natural_key_report(dims: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Q6: dimension rows sharing the natural key the fact joins on.

    Output: dim_name, natural_key (values joined by '|', NULL shown as
    '<null>'), n_rows.  A non-empty report means fact rows fan out.
    """
    parts = []
    for name, (df, keys) in dims.items():
        key_text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("<null>")) for k in keys])
        parts.append(duplicate_keys(df, keys).select(
            F.lit(name).alias("dim_name"), key_text.alias("natural_key"), F.col("n_rows")))
    return reduce(DataFrame.unionByName, parts)
