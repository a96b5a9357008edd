"""Helpers the operators share: the shared folder, written stages, prefix sums."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.session import ensure_checkpoint_dir

#: White space of the word contracts: space and \t \n \v \f \r.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark)}/tillroll-llm/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation,
    and partition-dependent values are fixed once.
    """
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(column: str | Column) -> Column:
    """A text with null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def own_columns(df: DataFrame, prefix: str = "_op_") -> None:
    """Refuse columns that begin with the prefix the operators keep for themselves."""
    clash = [c for c in df.columns if c.lower().startswith(prefix)]
    if clash:
        raise ValueError(f"columns beginning with {prefix} are reserved: {clash}")


def running_total(df: DataFrame, order: Sequence[Column], value: str, out: str, by: str | None = None,
                  row_id: str | None = None, partitions: int | None = None) -> DataFrame:
    """Add ``out``: the sum of ``value`` (a long) over the rows before this one.

    The order is ascending ``order``; with ``by`` (a long, the leading sort
    column, no nulls) the sum restarts for each of its values.  No window over
    the whole table: rows are range-partitioned, summed within each partition,
    written once, and shifted by the totals of the partitions before, of which
    there are one per partition and ``by`` value that partition holds.  A hot
    ``by`` value spreads over many partitions, as the range uses all of
    ``order``.  ``row_id`` names an optional unique long per row.
    """
    spark = df.sparkSession
    n = partitions or shuffle_partitions(spark)
    names = df.columns
    fields = [*df.schema.fields, T.StructField("_op_pid", T.LongType()), T.StructField("_op_sum", T.LongType()),
              T.StructField("_op_row", T.LongType())]
    schema = T.StructType(fields)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        last, carry, row = None, 0, pid << 33
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            v = batch.column(names.index(value)).to_numpy(zero_copy_only=False).astype(np.int64)
            total = np.cumsum(v) - v
            if by:
                keys = batch.column(names.index(by)).to_numpy(zero_copy_only=False)
                first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                base = np.repeat(total[first], np.diff(np.r_[first, m]))
                total = total - base
                if keys[0] == last:
                    total[: first[1] if len(first) > 1 else m] += carry
                last = keys[-1]
            else:
                total = total + carry
            carry = int(total[-1] + v[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(m, pid, np.int64)), pa.array(total),
                 pa.array(np.arange(row, row + m, dtype=np.int64))],
                names=[*names, "_op_pid", "_op_sum", "_op_row"])
            row += m

    parts = written(df.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(add, schema), "running")
    keys = [by] if by else []
    totals = parts.groupBy("_op_pid", *keys).agg(F.sum(value).alias("_op_total"))
    # A by value has a row per partition that holds it, so a window's group is at most n rows.
    group = Window.partitionBy(*keys)
    before = group.orderBy("_op_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("_op_pid").alias("_op_p4"), *[F.col(k).alias("_op_k4") for k in keys],
                            F.sum("_op_total").over(before).alias("_op_offset")).where("_op_offset IS NOT NULL")
    # Only a partition's first by value can have an offset: at most one row per range partition is broadcast.
    on = F.col("_op_pid") == F.col("_op_p4")
    if by:
        on = on & (F.col(by) == F.col("_op_k4"))
    joined = parts.join(F.broadcast(offsets), on, "left")
    extra = [F.col("_op_row").alias(row_id)] if row_id else []
    return joined.select(*names, (F.col("_op_sum") + F.coalesce("_op_offset", F.lit(0))).alias(out), *extra)


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """The words of a batch of lower-cased (A-Z) texts: (text number, word code, words by code).

    Split, flattened and coded in Arrow, without a Python step per word.
    """
    import pyarrow.compute as pc

    split = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), SPACE)
    coded = pc.list_flatten(split).dictionary_encode()
    at = pc.list_parent_indices(split).to_numpy()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    if "" in words:  # from white space at an end
        full = codes != words.index("")
        at, codes = at[full], codes[full]
    return at, codes, words


def pieces_of(batch: pa.RecordBatch, column: int, chars: int = 8_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch that hold about ``chars`` bytes of text each, at least one row."""
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(size) - size) // chars if len(size) else size
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(size) else []
    yield from zip(first, np.r_[first[1:], len(size)] if len(size) else [])
