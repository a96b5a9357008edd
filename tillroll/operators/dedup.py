"""Deduplication operators (W1-W3), written as aggregations.

``ROW_NUMBER() OVER (PARTITION BY k ORDER BY o) = 1`` sends every row of a
key to one task.  When the kept row is fully determined by the key plus the
minimum of one column -- true for all three dedups of the silver layer -- the
same result is an aggregate with a partial (map-side) step, so a key holding
a third of all rows is collapsed to one row per map task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.session import ensure_checkpoint_dir, shuffles_dropped


def _collated(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType) and field.dataType != T.StringType()


def drop_exact_duplicates(df: DataFrame, columns: Sequence[str], keep_min: str,
                          count_as: str | None = None) -> DataFrame:
    """One row per distinct ``columns`` tuple, keeping the lowest ``keep_min``, NULL first.

    NULLs compare equal, as in PARTITION BY.  Output keeps the input column
    order.  ``count_as`` adds the number of copies that were merged.  Columns
    with a collation group by it, and the row that stays keeps its own
    spelling throughout: that of the lowest ``keep_min``, then of the lowest
    text byte by byte.  Without one, equal copies are spelt alike and a plain
    minimum, which aggregates by hash, suffices.
    """
    extra = [F.count(F.lit(1)).alias(count_as)] if count_as else []
    ordered = [c for c in df.columns if c == keep_min or c in columns]
    if any(_collated(df.schema[c]) for c in columns):
        spelt = [F.collate(c, "UTF8_BINARY").alias(c) if isinstance(df.schema[c].dataType, T.StringType) else F.col(c)
                 for c in columns]
        first = F.min(F.struct(F.col(keep_min).isNotNull().alias("nn"), F.col(keep_min), *spelt)).alias("_first")
        out = df.groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(columns)]).agg(first, *extra)
        back = [F.col(f"_first.{c}").cast(df.schema[c].dataType).alias(c) for c in ordered]
        return out.select(*back, *([count_as] if count_as else []))
    # max(IS NULL) then min: NULL counts as the lowest value, as in an ascending sort.
    lowest = F.when(~F.max(F.col(keep_min).isNull()), F.min(keep_min)).alias(keep_min)
    out = df.groupBy(*columns).agg(lowest, *extra)
    return out.select(*ordered, *([count_as] if count_as else []))


#: Bits of the filter per repeated digest, and the most that is broadcast (in stretches of 32,768 bits, 4 KB each).
FILTER_BITS, MOST_STRETCHES = 64, 1 << 14


def digests(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a row; equal rows have equal ones, and others may."""
    return [F.xxhash64(F.lit(seed), *columns) for seed in (1, 2)]


def _stretch(digest: Column, stretches: int) -> tuple[Column, Column]:
    """The stretch of the filter and the place in it, as the bitmap functions number them."""
    place = F.pmod(digest, F.lit(stretches * 32768))
    return F.bitmap_bucket_number(place + 1), F.bitmap_bit_position(place + 1)


def _bit(bits: Column, position: Column) -> Column:
    """Whether a bit of a stretch is set; a missing stretch has none."""
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), position % 8).cast("int")) > 0, F.lit(False))


def marked_by(df: DataFrame, digest: Column, sought: DataFrame, n: int) -> DataFrame:
    """``df`` with ``_suspected``: false only for rows whose ``digest`` is none of the ``n`` in the column ``_d1`` of ``sought``.

    Those set a bit in a filter that every task gets.  Its size follows their
    number up to a fixed bound, beyond which more rows are suspected for nothing.
    """
    stretches = min(max(n * FILTER_BITS // 32768 + 1, 1), MOST_STRETCHES)
    stretch, position = _stretch(F.col("_d1"), stretches)
    bits = sought.groupBy(stretch.alias("_stretch")).agg(F.bitmap_construct_agg(position).alias("_bits"))
    stretch, position = _stretch(digest, stretches)
    placed = df.withColumn("_stretch", stretch).withColumn("_position", position)
    # At most MOST_STRETCHES rows of 4 KB.
    marked = placed.join(F.broadcast(bits), "_stretch", "left").withColumn("_suspected", _bit(F.col("_bits"), F.col("_position")))
    return marked.select(*df.columns, "_suspected")


def suspected(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with ``_suspected``: false only for rows whose like occurs once.

    One digest of all rows is shuffled, 8 bytes each, and those that occur
    more than once mark the rows; a clash only suspects two rows more.
    """
    ensure_checkpoint_dir(df.sparkSession)
    one = digests(columns)[0]
    counted = df.select(one.alias("_d1")).groupBy("_d1").agg(F.count(F.lit(1)).alias("_n"))
    with shuffles_dropped(df.sparkSession):
        repeated = counted.where("_n > 1").select("_d1").checkpoint()
        n = repeated.count()
    return marked_by(df, one, repeated, n)


def drop_exact_duplicates_by_digest(df: DataFrame, columns: Sequence[str], keep_min: str, count_as: str | None = None) -> DataFrame:
    """W1 as :func:`drop_exact_duplicates`, without moving rows that have no like.

    Only suspected rows go through the exact comparison, on all columns, so
    digests that clash merge nothing.  Worth it where copies are few and ``df``
    is a stored table, as it is read three times.  Columns with a collation
    hash by their bytes, so these take the plain way.
    """
    if any(_collated(df.schema[c]) for c in columns):
        return drop_exact_duplicates(df, columns, keep_min, count_as)
    marked = suspected(df, columns)
    exact = drop_exact_duplicates(marked.where("_suspected").drop("_suspected"), columns, keep_min, count_as)
    ordered = [c for c in df.columns if c == keep_min or c in columns]
    alone = marked.where("NOT _suspected").select(*ordered, *([F.lit(1).cast("long").alias(count_as)] if count_as else []))
    return alone.unionByName(exact)


def first_per_key(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Per key, the lowest ``order_col`` with NULL sorting first.

    Equals ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order_col) = 1``
    when the table holds only ``keys`` and ``order_col`` (ties are identical
    rows).  ``min`` over a struct (is_not_null, value) puts NULL first.
    """
    picked = F.min(F.struct(F.col(order_col).isNotNull().alias("nn"), F.col(order_col).alias("v")))
    out = df.groupBy(*keys).agg(picked.alias("_first"))
    return out.select(*[F.col("_first.v").alias(c) if c == order_col else F.col(c)
                        for c in df.columns if c in keys or c == order_col])
