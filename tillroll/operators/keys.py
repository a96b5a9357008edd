"""Surrogate keys (A7, A8) without a single-partition window.

A dense key in sort order (``IDENTITY`` filled by ``INSERT ... ORDER BY``) is
the global rank of a row.  ``row_number()`` over an unpartitioned window
would pull the whole table into one task.  Instead:

1. range-partition on the sort columns and sort inside each partition, so
   partition p holds a contiguous slice of the global order;
2. ``monotonically_increasing_id()`` then encodes (partition, position);
3. a count per partition -- one row per partition, a proven bound -- gives
   each partition's offset by a running sum;
4. key = offset + position + 1, joined through a broadcast of the offsets.

Positions and counts must describe the same partitioning.  Where the sort
list names every column, both branches read one range exchange, which Spark
executes once and reuses.  With further columns the optimizer would prune them
from the counting branch, and each branch would sample range bounds of its
own; the sorted rows are then written with their positions, compressed, to the
shared folder, and the counts read that one column.  The result is
independent of where the range bounds fall, as long as the sort columns give
a total order -- callers append tie-breaking columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.session import ensure_checkpoint_dir

_POS_BITS = 33  # monotonically_increasing_id: partition id << 33 | row index
_POS_MASK = (1 << _POS_BITS) - 1


# Rows per range partition when numbering: a partition is sorted in one task,
# and ~1M dimension rows (~200 bytes each) keep that sort near 200 MB.
ROWS_PER_KEY_PARTITION = 1_000_000


def partitions_for(df: DataFrame, upper_bound_rows: int | None) -> int | None:
    """Range partitions for numbering at most ``upper_bound_rows`` rows.

    Between 1 and ``spark.sql.shuffle.partitions``; None when no bound is known.
    """
    if upper_bound_rows is None:
        return None
    cap = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(cap, -(-upper_bound_rows // ROWS_PER_KEY_PARTITION)))


def ranges_for(spark: SparkSession, rows: int | None) -> int | None:
    """Ranges for sorting ``rows`` rows: at least ``spark.sql.shuffle.partitions``, more where a range would hold too many rows; None when unknown."""
    if rows is None:
        return None
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_KEY_PARTITION))


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def dense_key(df: DataFrame, order_by: Sequence[str | Column], key_col: str,
              num_partitions: int | None = None) -> DataFrame:
    """Add ``key_col`` = 1..N in the order of ``order_by`` (ascending, NULLs first).

    The key column is placed first.
    """
    n = _partitions(df, num_partitions)
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    ranged = df.repartitionByRange(n, *order)
    named = {c for c in order_by if isinstance(c, str)}
    reuse = str(df.sparkSession.conf.get("spark.sql.exchange.reuse", "true")).lower() == "true"
    tagged = ranged.sortWithinPartitions(*order).withColumn("_tr_id", F.monotonically_increasing_id())
    part = F.shiftrightunsigned(F.col("_tr_id"), _POS_BITS)
    # Counting needs no sort: the partition id of the same exchange suffices.
    counted, by_part = ranged, F.spark_partition_id()
    if not reuse or not set(df.columns) <= named:
        # The two branches would each run (and sample) a range exchange of
        # their own; pin one partitioning in the shared folder instead.
        path = f"{ensure_checkpoint_dir(df.sparkSession)}/tillroll/_ranked/{uuid.uuid4().hex}"
        # By place, as names may differ in case alone.
        names = [f"c{i}" for i in range(len(df.columns))]
        placed = tagged.toDF(*names, "_tr_id")
        placed.write.parquet(path)
        counted = df.sparkSession.read.schema(placed.schema).parquet(path)
        tagged, by_part = counted.toDF(*df.columns, "_tr_id"), part
    counts = counted.groupBy(by_part.alias("_tr_part")).agg(F.count(F.lit(1)).alias("_tr_n"))
    before = Window.orderBy("_tr_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_tr_part", F.coalesce(F.sum("_tr_n").over(before), F.lit(0)).alias("_tr_offset"))
    keyed = tagged.join(F.broadcast(offsets), part == F.col("_tr_part"))
    key = (F.col("_tr_offset") + F.col("_tr_id").bitwiseAND(F.lit(_POS_MASK)) + 1).cast("long")
    return keyed.select(key.alias(key_col), *[F.col(c) for c in df.columns])


def unique_key(df: DataFrame, key_col: str) -> DataFrame:
    """A unique (not dense) 64-bit key in no particular order, free of shuffles."""
    return df.select((F.monotonically_increasing_id() + 1).alias(key_col), *df.columns)
