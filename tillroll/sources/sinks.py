"""Writers (S7-S13, S17, Q4).

Every write is a full overwrite of its own path and returns the number of
rows written, observed while the write runs (no second pass).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.session import shuffles_dropped


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                extra_metrics: list | None = None, fmt: str = "parquet", compression: str | None = None,
                mode: str = "overwrite") -> dict:
    """Overwrite ``path`` with ``df`` (or append to it); return observed metrics (``rows`` and extras).

    The shuffle files of the write go with its end.
    """
    obs = Observation()
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), *(extra_metrics or []))
    writer = observed.write.mode(mode).format(fmt)
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_dropped(df.sparkSession):
        writer.save(path)
    return dict(obs.get)


#: Rows whose shuffles a pass may hold on disk, and the most passes, as each reads its input again.
ROWS_PER_PASS, MOST_PASSES = 50_000_000, 4


def passes_for(rows: int | None) -> int:
    """Passes for a table made of ``rows`` rows."""
    return max(1, min(MOST_PASSES, -(-(rows or 0) // ROWS_PER_PASS)))


def shares(df: DataFrame, columns: Sequence[str], n: int) -> list[DataFrame]:
    """``df`` in ``n`` parts by the hash of ``columns``; rows alike in these, missing values included, share a part."""
    place = F.pmod(F.xxhash64(*columns), F.lit(n))
    return [df.where(place == i) for i in range(n)] if n > 1 else [df]


def write_passes(parts: Sequence[DataFrame], path: str, **kw) -> dict:
    """:func:`write_table` of the rows of all ``parts``, one after the other, so that the shuffle files of one are gone before the next.

    Returns the sums of the observed metrics, which must be counts.
    """
    found: Counter[str] = Counter()
    for i, part in enumerate(parts):
        found.update(write_table(part, path, mode="append" if i else "overwrite", **kw))
    return dict(found)


def fact_layout(fact: DataFrame) -> DataFrame:
    """Order-year folders holding files that are narrow in the order date.

    Replaces the fact's key indexes: the partition column prunes whole years,
    and within a year a file holds a few consecutive days, so per-file min/max
    statistics skip files for a month or a day.  One shuffle of the fact by
    range, paid once and read many times; the order id splits a hot day, and
    AQE merges small ranges, so the number of files follows the data's size
    and not tasks times years.  The unique key is numbered last, after the
    shuffle; it is unique in the written table, and another write may number
    the rows otherwise.
    """
    ranged = fact.repartitionByRange("order_date_key", "order_id").withColumn(
        "order_year", F.expr("order_date_key div 10000").cast("int")).sortWithinPartitions("order_year", "order_date_key")
    if "fact_key" in fact.columns:
        ranged = ranged.withColumn("fact_key", F.monotonically_increasing_id() + 1)
    return ranged


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty DataFrame with the declared schema."""
    return spark.createDataFrame([], schema)


def create_schemas(spark: SparkSession, names=("bronze", "silver", "gold"), reset: bool = False) -> None:
    """Layer schemas in the session catalog; ``reset`` drops them first."""
    for name in names:
        if reset:
            spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def register_view(df: DataFrame, name: str) -> None:
    """A named view for SQL users."""
    df.createOrReplaceTempView(name)
