"""Q1-Q6 as a suite: declared rules compiled to aggregates.

Rules on single rows become flags in one aggregate over one scan of the checked
table.  Uniqueness and foreign keys each count the table by key, reading the
key columns alone; a foreign key joins these counts, a row per key, with the
parent's distinct keys, broadcast only when the parent is proven small.  Rows
that fail are set aside by :func:`failing_rows`, one row per failed rule.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.lookup import lookup


@dataclass(frozen=True)
class NotNull:
    """The column has a value."""
    column: str

    def name(self) -> str:
        return f"not_null({self.column})"

    def fails(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class MaxLength:
    """A text is at most so many characters long; a missing one passes."""
    column: str
    length: int

    def name(self) -> str:
        return f"max_length({self.column}, {self.length})"

    def fails(self) -> Column:
        return F.coalesce(F.length(self.column) > self.length, F.lit(False))


@dataclass(frozen=True)
class InRange:
    """A value lies within the bounds, either of which may be None; a missing one passes."""
    column: str
    least: object = None
    most: object = None

    def name(self) -> str:
        return f"in_range({self.column}, {self.least}, {self.most})"

    def fails(self) -> Column:
        low = F.col(self.column) < F.lit(self.least) if self.least is not None else F.lit(False)
        high = F.col(self.column) > F.lit(self.most) if self.most is not None else F.lit(False)
        return F.coalesce(low | high, F.lit(False))


@dataclass(frozen=True)
class ForeignKey:
    """The columns' values are those of a parent's row; a missing value passes, as in SQL."""
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]

    def name(self) -> str:
        return f"foreign_key({', '.join(self.columns)}, {self.parent})"


@dataclass(frozen=True)
class Unique:
    """No two rows have the columns' values; rows with a missing value pass, as in SQL.  Fails count the rows too many."""
    columns: tuple[str, ...]

    def name(self) -> str:
        return f"unique({', '.join(self.columns)})"

    def whole(self) -> Column:
        return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in self.columns])


Rules = Mapping[str, Sequence[object]]


def _flagged(name: str, rules: Rules, tables: Mapping[str, DataFrame], rows: Mapping[str, int]) -> tuple[DataFrame, dict[str, Column]]:
    """The checked table joined to its parents' keys, and per rule on rows whether a row fails it."""
    df, flags = tables[name], {}
    for i, rule in enumerate(rules[name]):
        if isinstance(rule, ForeignKey):
            mark = f"_parent_{i}"
            keys = tables[rule.parent].select(*[F.col(p).alias(c) for p, c in zip(rule.parent_columns, rule.columns)]).distinct()
            df = lookup(df, keys.withColumn(mark, F.lit(True)), list(rule.columns), "left", rows.get(rule.parent))
            whole = Unique(rule.columns).whole()
            flags[rule.name()] = whole & F.col(mark).isNull()
        elif not isinstance(rule, Unique):
            flags[rule.name()] = rule.fails()
    return df, flags


def _keys_failed(rule: ForeignKey | Unique, tables: Mapping[str, DataFrame], name: str, rows: Mapping[str, int]) -> DataFrame:
    """``n_rows, n_failed`` of one rule on keys: the table is counted by key first, so that a join or a sum meets a row per key."""
    counted = tables[name].groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("_n"))
    whole, n = Unique(rule.columns).whole(), F.col("_n")
    if isinstance(rule, ForeignKey):
        keys = tables[rule.parent].select(*[F.col(p).alias(c) for p, c in zip(rule.parent_columns, rule.columns)]).distinct()
        counted = lookup(counted, keys.withColumn("_parent", F.lit(True)), list(rule.columns), "left", rows.get(rule.parent))
        failed = F.when(whole & F.col("_parent").isNull(), n)
    else:
        failed = F.when(whole, n - 1)
    return counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(a) for a, c in (("n_rows", n), ("n_failed", failed))])


def check(rules: Rules, tables: Mapping[str, DataFrame], rows: Mapping[str, int] | None = None) -> DataFrame:
    """One row per rule: ``table_name, rule, n_rows, n_failed``.

    ``rows`` are proven row counts of parents, for the choice of join.  A table
    without rows passes every rule.
    """
    parts = []
    for name, declared in rules.items():
        on_rows = [r for r in declared if not isinstance(r, ForeignKey | Unique)]
        if on_rows:
            aggs = [F.count(F.lit(1)).alias("_rows"), *[F.count_if(r.fails()).alias(f"f{i}") for i, r in enumerate(on_rows)]]
            entries = ", ".join(f"'{r.name()}', f{i}" for i, r in enumerate(on_rows))
            parts.append(tables[name].agg(*aggs).selectExpr(f"'{name}' AS table_name", f"stack({len(on_rows)}, {entries}) AS (rule, n_failed)", "_rows AS n_rows"))
        parts += [_keys_failed(r, tables, name, rows or {}).select(F.lit(name).alias("table_name"), F.lit(r.name()).alias("rule"), "n_rows", "n_failed")
                  for r in declared if isinstance(r, ForeignKey | Unique)]
    return reduce(DataFrame.unionByName, parts).select("table_name", "rule", "n_rows", "n_failed")


def failing_rows(rules: Rules, tables: Mapping[str, DataFrame], name: str, rows: Mapping[str, int] | None = None) -> DataFrame:
    """The rows of table ``name`` that fail, each once per failed rule, with the column ``rule``; of rows that share a unique key, all.

    Keys that repeat are found by an aggregate; only rows with such keys meet in a join.
    """
    df, flags = _flagged(name, rules, tables, rows or {})
    columns = tables[name].columns
    failed = F.array_compact(F.array(*[F.when(flag, F.lit(rule)) for rule, flag in flags.items()])) if flags else F.array().cast("array<string>")
    out = df.select(*columns, F.explode(failed).alias("rule"))
    for rule in rules[name]:
        if isinstance(rule, Unique):
            again = tables[name].where(rule.whole()).groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
            out = out.unionByName(tables[name].join(again, list(rule.columns), "left_semi").withColumn("rule", F.lit(rule.name())))
    return out
