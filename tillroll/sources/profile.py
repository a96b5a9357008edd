"""Table profile (S18): shape, types, NULLs, ranges, moments, quartiles and distinct counts in one aggregate.

Quartiles come from KLL sketches and distinct counts from HLL sketches.  Both
merge, so every task passes on a few KB per column, whatever its rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Sketch sizes, and errors that they keep in all but rare cases: of a quartile's rank, of a distinct count's share.
KLL_K, RANK_ERROR = 400, 0.02
HLL_LOG_K, DISTINCT_ERROR = 14, 0.03
QUARTILES = (0.25, 0.5, 0.75)


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, NULLs, min and max (as text).

    A single ``agg`` over the table (partial aggregation, one small
    shuffle), turned into rows with ``stack``; nothing is collected.
    """
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggs += [F.count_if(c.isNull()).alias(f"n{i}"),
                 F.min(c).cast("string").alias(f"lo{i}"),
                 F.max(c).cast("string").alias(f"hi{i}")]
    stats = df.agg(*aggs)
    entries = ", ".join(
        f"'{f.name}', '{f.dataType.simpleString()}', n{i}, lo{i}, hi{i}" for i, f in enumerate(fields))
    return stats.selectExpr(
        f"stack({len(fields)}, {entries}) as (column_name, data_type, n_nulls, min_value, max_value)",
        "_rows as n_rows")


def describe(df: DataFrame) -> DataFrame:
    """One row per column: what :func:`profile` tells, and mean, deviation, quartiles and the number of distinct values.

    ``mean``, ``stddev`` (of a sample) and the quartiles are null for columns
    that are not numbers and for columns without values.  Quartiles are values
    of the column whose rank is within RANK_ERROR of a quartile's, distinct
    counts are within DISTINCT_ERROR; all else is exact.  One ``agg``, one
    small shuffle.
    """
    aggs, entries = [F.count(F.lit(1)).alias("_rows")], []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        number = isinstance(f.dataType, T.NumericType)
        # The sketch of distinct values takes numbers, texts and binaries.
        key = c if isinstance(f.dataType, (T.StringType, T.BinaryType, T.IntegerType, T.LongType)) else c.cast("string")
        aggs += [F.count(c).alias(f"n{i}"), F.min(c).cast("string").alias(f"lo{i}"), F.max(c).cast("string").alias(f"hi{i}"),
                 F.hll_sketch_estimate(F.hll_sketch_agg(key, HLL_LOG_K)).alias(f"d{i}")]
        if number:
            aggs += [F.sum(c).cast("double").alias(f"sum{i}"), F.stddev_samp(c.cast("double")).alias(f"dev{i}"),
                     F.kll_sketch_agg_double(c.cast("double"), KLL_K).alias(f"kll{i}")]
            quartiles = ", ".join(f"CASE WHEN n{i} > 0 THEN kll_sketch_get_quantile_double(kll{i}, {q}D) END" for q in QUARTILES)
            moments = f"sum{i} / nullif(n{i}, 0), dev{i}, {quartiles}"
        else:
            moments = ", ".join(["CAST(NULL AS DOUBLE)"] * (2 + len(QUARTILES)))
        entries.append(f"'{f.name}', '{f.dataType.simpleString()}', _rows - n{i}, lo{i}, hi{i}, {moments}, d{i}")
    return df.agg(*aggs).selectExpr(
        f"stack({len(entries)}, {', '.join(entries)}) as (column_name, data_type, n_nulls, min_value, max_value, mean, stddev, p25, p50, p75, "
        "approx_distinct)", "_rows as n_rows")


def describe_checked(df: DataFrame) -> DataFrame:
    """:func:`describe` without its estimates, and whether these keep their bounds against exact ranks and counts.

    A second pass, for tests of the sketches: ``quartiles_hold`` (null where
    there are none) and ``distinct_holds`` per column.  Ranks are one aggregate;
    distinct values are counted column by column, each over a scan of its
    column alone, so no row is copied once per column.
    """
    found = describe(df)
    rows = found.collect()  # a row per column
    aggs, entries, counts = [F.count(F.lit(1)).alias("_rows")], [], []
    for r in rows:
        c = F.col(f"`{r['column_name']}`")
        counts.append(df.where(c.isNotNull()).select(c.alias("v")).distinct().agg(F.count(F.lit(1)).alias("_distinct")).select(
            F.lit(r["column_name"]).alias("column_name"), "_distinct"))
        holds = []
        for q, value in zip(QUARTILES, (r["p25"], r["p50"], r["p75"])):
            if value is not None:
                x, at = c.cast("double"), len(aggs)
                aggs += [F.count_if(x < value).alias(f"b{at}"), F.count_if(x <= value).alias(f"u{at}")]
                n = r["n_rows"] - r["n_nulls"]
                holds.append(f"b{at} <= {(q + RANK_ERROR) * n}D AND u{at} >= {(q - RANK_ERROR) * n}D")
        entries.append(f"'{r['column_name']}', {' AND '.join(holds) or 'CAST(NULL AS BOOLEAN)'}")
    ranks = df.agg(*aggs).selectExpr(f"stack({len(entries)}, {', '.join(entries)}) as (column_name, quartiles_hold)")
    distinct = reduce(DataFrame.unionByName, counts)
    once = df.sparkSession.createDataFrame(rows, found.schema)
    joined = once.join(F.broadcast(ranks), "column_name").join(F.broadcast(distinct), "column_name")
    within = F.abs(F.col("approx_distinct").cast("double") - F.col("_distinct")) <= F.greatest(F.lit(1.0), F.lit(DISTINCT_ERROR) * F.col("_distinct"))
    return joined.withColumn("distinct_holds", within).drop("p25", "p50", "p75", "approx_distinct", "_distinct")


def head(df: DataFrame, n: int = 5) -> DataFrame:
    """The first n rows, as a look at the data (the limit is the feature)."""
    return df.limit(n)
