"""A dimension kept between runs, of which only changed parts are written.

Members are cut into ranges of the dimension's sort order, by bounds taken at
the first build.  Each range stores its members with their place within it;
a member's key is that place plus the number of members in the ranges before,
so the dense keys are those of a full rebuild although a new member in one
range rewrites no other.

A range is rewritten only where its count or digest differs.  Its files go to
a folder of the refresh's version and are never changed afterwards; the state,
one row per range with its version, is written last, so a refresh that dies
leaves the earlier state in force and readers of it undisturbed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.session import ensure_checkpoint_dir

STATE = "range int, version int, n long, one long, two long"


@dataclass
class Refreshed:
    """The dimension with its keys, and what the refresh wrote."""
    rows: DataFrame
    version: int
    ranges: int
    written: list[int]


def _order(columns: Sequence[str]) -> Column:
    """A row's place in the sort order, missing values first, as one comparable value."""
    return F.struct(*[x for i, c in enumerate(columns) for x in (F.col(c).isNotNull().alias(f"h{i}"), F.col(c).alias(f"v{i}"))])


def _digest(columns: Sequence[str], seed: int) -> Column:
    """Order-free digest of distinct rows; a missing value is hashed as such."""
    return F.bit_xor(F.xxhash64(F.lit(seed), *[x for c in columns for x in (F.col(c).isNull(), F.col(c))]))


def _folder(spark: SparkSession, path: str) -> list[int]:
    """The numbered folders below ``path`` that were written to the end."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(folder)
                  if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))


def _bounds(members: DataFrame, columns: Sequence[str], ranges: int, path: str) -> DataFrame:
    """The first member of each range but the first, taken once and stored."""
    spark = members.sparkSession
    schema = members.select(_order(columns).alias("first")).schema
    if not _folder(spark, f"{path}/bounds"):
        ranged = members.repartitionByRange(ranges, *[F.col(c).asc_nulls_first() for c in columns])
        firsts = ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.min(_order(columns)).alias("first"))
        firsts.where("p > 0").select("first").coalesce(1).write.parquet(f"{path}/bounds/0")
    return spark.read.schema(schema).parquet(f"{path}/bounds/0")


def refresh(members: DataFrame, columns: Sequence[str], key: str, path: str, ranges: int = 64) -> Refreshed:
    """Bring the dimension stored at ``path`` up to the distinct rows of ``members`` and return it with its dense key.

    ``ranges`` holds at the first build; ranges that outgrow memory call for a
    new store.  Missing values sort first and are values like others; no
    members give an empty dimension.
    """
    spark, columns = members.sparkSession, list(columns)
    ensure_checkpoint_dir(spark)
    # Bounds, digests and rows all read the members: found once among the lines, then kept, a row per member.
    members = members.select(*columns).distinct().checkpoint()
    bounds = _bounds(members, columns, ranges, path)
    # At most ``ranges`` bounds, in every row's plan as one array.
    firsts = bounds.agg(F.collect_list("first").alias("firsts"))
    placed = members.join(F.broadcast(firsts)).select(
        *columns, F.size(F.filter("firsts", lambda b: b <= _order(columns))).alias("range"))
    versions = _folder(spark, f"{path}/state")
    before = {r["range"]: r for r in spark.read.schema(STATE).parquet(f"{path}/state/{versions[-1]}").collect()} if versions else {}
    found = {r["range"]: r for r in placed.groupBy("range").agg(
        F.count(F.lit(1)).alias("n"), _digest(columns, 1).alias("one"), _digest(columns, 2).alias("two")).collect()}  # a row per range
    version = versions[-1] + 1 if versions else 0
    changed = sorted(k for k, r in found.items() if k not in before or any(before[k][c] != r[c] for c in ("n", "one", "two")))
    if changed:
        within = Window.partitionBy("range").orderBy(*[F.col(c).asc_nulls_first() for c in columns])
        new = placed.where(F.col("range").isin(changed)).withColumn("_place", F.row_number().over(within))
        new.write.mode("overwrite").partitionBy("range").parquet(f"{path}/members/{version}")
    if changed or set(before) != set(found) or not versions:
        state = [(k, version if k in changed else before[k]["version"], r["n"], r["one"], r["two"]) for k, r in sorted(found.items())]
        spark.createDataFrame(state, STATE).coalesce(1).write.mode("overwrite").parquet(f"{path}/state/{version}")
    return Refreshed(read(spark, members.schema, key, path), version, len(found), changed)


def read(spark: SparkSession, schema: T.StructType, key: str, path: str, version: int | None = None) -> DataFrame:
    """The dimension as the newest state, or an earlier one, has it."""
    versions = _folder(spark, f"{path}/state")
    state = spark.read.schema(STATE).parquet(f"{path}/state/{versions[-1] if version is None else version}")
    rows = state.orderBy("range").collect()  # a row per range
    stored = T.StructType([*schema.fields, T.StructField("_place", T.IntegerType()), T.StructField("range", T.IntegerType())])
    parts, offsets, total = [], [], 0
    for v in sorted({r["version"] for r in rows}):
        own = [f"{path}/members/{v}/range={r['range']}" for r in rows if r["version"] == v]
        parts.append(spark.read.schema(stored).option("basePath", f"{path}/members/{v}").parquet(*own))
    for r in rows:
        offsets.append((r["range"], total))
        total += r["n"]
    if not parts:
        return spark.createDataFrame([], T.StructType([T.StructField(key, T.LongType()), *schema.fields]))
    members = parts[0]
    for part in parts[1:]:
        members = members.unionByName(part)
    joined = members.join(F.broadcast(spark.createDataFrame(offsets, "range int, _offset long")), "range")
    return joined.select((F.col("_offset") + F.col("_place")).cast("long").alias(key), *[f.name for f in schema.fields])
