"""Layouts of the fact that let a filter on one key leave most files unread.

The published fact is ranged by order date.  :func:`write_by_key` adds a copy
of its rows along a space-filling curve: the ranks of location, customer,
product and order date are interleaved bit by bit and the rows ranged by the
result, so that a file holds a narrow band of every key.  The date, which the
first layout serves, joins the curve after three bits of each other key.
Parquet Bloom filters on the keys let a reader pass over row groups within a
file's band that don't have the member.

:func:`file_statistics` keeps each file's least and greatest keys in a small
table, one row per file.  :func:`read_where` asks the tables of all layouts
which files a filter can touch, and reads the layout with the fewest rows in them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.session import shuffles_dropped

#: Keys along the curve, the leading ones first, with the bits that each leaves to the others before it takes part.
CURVE = {"location_key": 0, "customer_key": 0, "product_key": 0, "order_date_key": 3}
#: Bits of a key's rank.
BITS = 10
KEYS = [*CURVE, "ship_date_key"]
#: Rows of a range along the curve: at most as many as a task sorts in memory, and not so few that files are tiny.
ROWS_PER_RANGE, FEW_ROWS = 1_000_000, 100_000


@dataclass
class Layout:
    """A stored copy of the fact: its folder, its table of files and the schema of its rows."""
    path: str
    files: str
    schema: T.StructType


def _rank(key: str, least: int, most: int) -> Column:
    """A key's place among 2^BITS equal bands from its least to its greatest value; missing keys come first."""
    return F.coalesce(F.expr(f"CAST(({key} - {least}) * {1 << BITS} div {most - least + 1} AS bigint)"), F.lit(0).cast("long"))


def curve(bounds: Mapping[str, tuple[int, int]], offsets: Mapping[str, int] = CURVE) -> Column:
    """The interleaved bits of all keys' ranks as one number."""
    slots = sorted((depth + offsets[key], i, key, BITS - 1 - depth) for i, key in enumerate(bounds) for depth in range(BITS))
    out = F.lit(0).cast("long")
    for place, (_, _, key, bit) in enumerate(slots):
        out = out.bitwiseOR(F.shiftleft(F.shiftright(F.col(f"_rank_{key}"), bit).bitwiseAND(F.lit(1)), len(slots) - 1 - place))
    return out


def curve_ranges(spark: SparkSession, rows: int) -> int:
    """Ranges of ``rows`` rows: few enough rows to sort in memory, and no more ranges than small data needs."""
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(most, -(-rows // FEW_ROWS)), -(-rows // ROWS_PER_RANGE))


def along_curve(fact: DataFrame, offsets: Mapping[str, int] = CURVE, rows: int | None = None) -> DataFrame:
    """The fact's rows ranged and sorted along the curve; a hot member's rows are split by order.

    One aggregate of the key columns gives the bands; surrogate keys are dense,
    so equal bands need no quantiles.  With the fact's number of ``rows`` the
    ranges follow it; without, they are merged by their compressed size, which
    for repetitive rows is far below what a sort holds.
    """
    ends = fact.agg(*[f(F.col(k)).alias(f"{n}_{k}") for k in offsets for n, f in (("least", F.min), ("most", F.max))]).first()
    bounds = {k: (ends[f"least_{k}"], ends[f"most_{k}"]) for k in offsets if ends[f"least_{k}"] is not None}
    ranked = fact.select("*", *[_rank(k, *b).alias(f"_rank_{k}") for k, b in bounds.items()])
    placed = ranked.withColumn("_curve", curve(bounds, offsets))
    number = [curve_ranges(fact.sparkSession, rows)] if rows is not None else []
    ranged = placed.repartitionByRange(*number, "_curve", "order_id").sortWithinPartitions("_curve")
    return ranged.select(*fact.columns)


def write_by_key(fact: DataFrame, path: str, rows: int | None = None) -> Layout:
    """Write the copy of ``fact`` along the curve, with Bloom filters on its keys, and its table of files."""
    with shuffles_dropped(fact.sparkSession):
        # Sized by the members that a row group turns out to hold, not by the largest size allowed.
        writer = along_curve(fact, rows=rows).write.mode("overwrite").option("parquet.bloom.filter.adaptive.enabled", "true")
        for key in CURVE:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        writer.parquet(path)
        return file_statistics(fact.sparkSession, path, fact.schema)


def file_statistics(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str] = KEYS, to: str | None = None) -> Layout:
    """Write, to ``to`` or else ``<path>_files``, per file its size, rows and the least and greatest value of each key.

    ``to`` must not lie within a partitioned table's folder.  Only the key columns are read, and combined per file before the shuffle.
    """
    rows = spark.read.schema(schema).parquet(path)
    found = rows.groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(
        F.count(F.lit(1)).alias("rows"), *[f(k).alias(f"{n}_{k}") for k in keys for n, f in (("least", F.min), ("most", F.max))])
    to = to or f"{path}_files"
    found.coalesce(1).write.mode("overwrite").parquet(to)
    return Layout(path, to, schema)


def _can_hold(where: Mapping[str, object]) -> Column:
    """Whether a file's bands can hold a row of the filter; a file without a value of the key cannot."""
    out = F.lit(True)
    for key, asked in where.items():
        least, most = F.col(f"least_{key}"), F.col(f"most_{key}")
        if isinstance(asked, tuple):
            hit = (most >= asked[0]) & (least <= asked[1])
        else:
            hit = F.exists(F.array(*[F.lit(v) for v in asked]), lambda v: (least <= v) & (v <= most)) if asked else F.lit(False)
        out = out & F.coalesce(hit, F.lit(False))
    return out


def _holds(where: Mapping[str, object]) -> Column:
    out = F.lit(True)
    for key, asked in where.items():
        out = out & (F.col(key).between(*asked) if isinstance(asked, tuple) else F.col(key).isin(list(asked)))
    return out


def touched(spark: SparkSession, layout: Layout, where: Mapping[str, object]) -> tuple[DataFrame, int, int]:
    """The files that a filter can touch, their rows, and the number of all files."""
    files = spark.read.parquet(layout.files)
    hit = files.where(_can_hold(where))
    total = files.select(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.when(_can_hold(where), F.col("rows"))), F.lit(0)).alias("rows")).first()
    return hit, total["rows"], total["n"]


def read_where(spark: SparkSession, layouts: Sequence[Layout], where: Mapping[str, object]) -> DataFrame:
    """The fact's rows under a filter, from the files that can hold them.

    ``where`` maps keys to a list of values or to a (first, last) range; all
    must hold, and a missing key never does.  The names of the touched files
    are gathered on the driver, which a plain scan does for all files.
    """
    unknown = set(where) - set(KEYS)
    if unknown:
        raise ValueError(f"no file statistics for {sorted(unknown)}")
    best = min(((*touched(spark, layout, where), i) for i, layout in enumerate(layouts)), key=lambda x: (x[1], x[3]))
    layout = layouts[best[3]]
    paths = [unquote(r["file"]) for r in best[0].select("file").collect()]
    reader = spark.read.schema(layout.schema)
    if not paths:
        return spark.createDataFrame([], layout.schema)
    return reader.option("basePath", layout.path).parquet(*paths).where(_holds(where))
