"""Mixing sources to target weights by weighted fair queueing.

Each source is a flow.  Its documents, in a keyed random order and once per
epoch, queue behind each other; a document's virtual finish time is the words
its source has sent by its end, divided by the source's target weight.  The
items are range-sorted by virtual finish time and cut at the total budget.
Weights are the targets themselves, so that every source reaches its target
at the same virtual time; a document in service at that time is cut there.

Targets: sources by code point (null last) weigh ``weights``, repeating, and
share ``share`` times all sizes; none exceeds ``epochs`` times its source's
size, the excess going to the others by weight.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import WORD, own_columns, running_total, text_of, written

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
EPOCHS = 2
SEED = "mix-1"


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share_percent: int = SHARE_PERCENT,
            epochs: int = EPOCHS) -> DataFrame:
    """``(source, source_size)`` to the same with ``_op_src`` (rank), ``weight`` and ``target``.

    One row per source, sorted and summed without a one-task window, as there
    may be very many sources.  Water-filling: by ascending size per weight, a
    source is full when its cap is at most what the sources from it on would
    get by weight.  Sizes of zero give targets of zero.
    """
    one = sizes.withColumn("_op_one", F.lit(1).cast("long"))
    ranked = running_total(one, [F.col("source").asc_nulls_last()], "_op_one", "_op_src").drop("_op_one")
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]),
                          (F.col("_op_src") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("_op_cap", F.col("source_size") * epochs)
    order = [F.col("_op_cap") / F.col("weight"), F.col("_op_src")]
    filled = running_total(running_total(ranked, order, "_op_cap", "_op_caps"), order, "weight", "_op_weights")
    filled = written(filled, "fill")
    total = filled.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("_op_all"),
                       F.coalesce(F.sum("weight"), F.lit(0)).alias("_op_wall"))
    budget = F.col("_op_all") * share_percent / F.lit(100.0)
    both = filled.crossJoin(F.broadcast(total)).withColumn(
        "_op_full", F.col("_op_cap") * (F.col("_op_wall") - F.col("_op_weights"))
        <= F.col("weight") * (budget - F.col("_op_caps")))
    level = both.agg(
        F.coalesce(F.sum(F.when(F.col("_op_full"), F.col("_op_cap"))), F.lit(0)).alias("_op_fcap"),
        F.coalesce(F.sum(F.when(F.col("_op_full"), F.col("weight"))), F.lit(0)).alias("_op_fw"))
    level_at = (budget - F.col("_op_fcap")) / (F.col("_op_wall") - F.col("_op_fw"))
    out = both.crossJoin(F.broadcast(level)).withColumn(
        "target", F.when(F.col("_op_full"), F.col("_op_cap").cast("double")).otherwise(level_at * F.col("weight")))
    return written(out.select("source", "source_size", "_op_src", "weight", "target"), "targets")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share_percent: int = SHARE_PERCENT, epochs: int = EPOCHS,
        seed: str = SEED, keep_unused: bool = False) -> DataFrame:
    """The mixture: an item per document and epoch with words in it, to be read in order of ``finish``.

    Columns: ``doc_id, source, size, source_size, target, epoch, finish`` (virtual
    finish time), ``taken`` (words the mixture takes of it), ``mix_start`` (words
    before it) and ``row`` (unique per input row).  ``keep_unused`` also returns
    the items that nothing is taken of.

    Null and empty texts have size 0 and nothing taken; null is a source of its
    own; repeated rows are separate documents; equal order keys fall back to the
    id and the size.  An empty table gives no items.  Other columns are ignored.
    Reruns agree: the order comes from a keyed hash of the id.
    """
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                        F.regexp_count(text_of("text"), F.lit(WORD)).cast("long").alias("size"))
    sized = written(sized, "sizes")
    by_source = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share_percent, epochs)
    t = by_source.withColumnRenamed("source", "_op_source")
    # The planner broadcasts the sources only if their measured size allows; a hot source splits as a skewed join.
    joined = sized.join(t, F.col("source").eqNullSafe(F.col("_op_source"))).drop("_op_source", "weight")
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    order = [F.col("_op_src"), F.col("_op_key"), F.col("doc_id"), F.col("size")]
    queued = running_total(joined.withColumn("_op_key", key), order, "size", "_op_start", by="_op_src", row_id="row")
    items = queued.withColumn("epoch", F.explode(F.array(*[F.lit(e) for e in range(epochs)])))
    start = F.col("_op_start") + F.col("epoch") * F.col("source_size")
    end = start + F.col("size")
    wanted = F.greatest(F.lit(0).cast("long"), F.least(end, F.floor("target")) - start)
    items = items.select("doc_id", "source", "size", "source_size", "target", "_op_src", "row", "epoch",
                         F.when(F.col("target") > 0, end / F.col("target")).otherwise(F.lit(0.0)).alias("finish"),
                         wanted.alias("_op_wanted"))
    if not keep_unused:
        items = items.where("_op_wanted > 0")
    # The global order and the words before each item in it; what would pass the budget is cut.
    mixed = running_total(items, [F.col("finish"), F.col("_op_src"), F.col("row"), F.col("epoch")], "_op_wanted", "mix_start")
    budget = by_source.agg(F.floor(F.coalesce(F.sum("source_size"), F.lit(0)) * share_percent / F.lit(100.0)).alias("_op_budget"))
    left = F.greatest(F.lit(0).cast("long"), F.col("_op_budget") - F.col("mix_start"))
    mixed = mixed.crossJoin(F.broadcast(budget)).withColumn("taken", F.least(F.col("_op_wanted"), left))
    if not keep_unused:
        mixed = mixed.where("taken > 0")
    return mixed.select("doc_id", "source", "size", "source_size", "target", "epoch", "finish", "taken", "mix_start", "row")


def mix_digest(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, size, source_size, target, taken``, summed over the mixture's items."""
    items = mix(docs, keep_unused=True)
    return items.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("size").alias("size"), F.first("source_size").alias("source_size"),
        F.first("target").alias("target"), F.sum("taken").alias("taken")).drop("row")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mixture, with the columns of ``docs``: once for each epoch that takes any of its words.

    A document cut at the budget keeps its first ``taken`` words and the white
    space before each.  Rows with the same id share what their ids were given:
    the most taken in each epoch.  The rows come unordered; their order in the
    mixture is that of ``finish`` in :func:`mix`.  Null, empty and blank texts
    have no words and so no place in the mixture; a null id or source is a value
    of its own; very long texts are counted and cut like others; an empty table
    gives no rows; other columns come along, columns beginning with ``_op_`` are
    refused.
    """
    own_columns(docs)
    items = mix(docs).groupBy("doc_id", "source", "size", "epoch").agg(F.max("taken").alias("_op_taken"))
    items = items.select(F.col("doc_id").alias("_op_id"), F.col("source").alias("_op_src"), F.col("size").alias("_op_size"), "_op_taken")
    size = F.regexp_count(text_of("text"), F.lit(WORD)).cast("long")
    on = (F.col("_op_n") == F.col("_op_size")) & F.col("doc_id").cast("long").eqNullSafe(F.col("_op_id")) \
        & F.col("source").cast("string").eqNullSafe(F.col("_op_src"))
    joined = docs.withColumn("_op_n", size).join(items, on)
    # The text is gaps and words by turns; the first words stay with the white space before each.
    some = F.col("_op_taken").cast("int")
    words = F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), some)
    gaps = F.slice(F.split(F.col("text"), WORD, -1), F.lit(1), some)
    cut = F.when(F.col("_op_taken") < F.col("_op_n"), F.array_join(F.zip_with(gaps, words, lambda g, w: F.concat(g, w)), "")).otherwise(F.col("text"))
    columns = [cut.alias("text") if c == "text" else
               F.when(F.col("_op_taken") < F.col("_op_n"), F.length(cut)).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c)
               if c == "n_chars" else F.col(c) for c in docs.columns]
    return joined.select(*columns)


#: DuckDB, over the table documents.  The recursion-free water-filling is exact, as in targets().
ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size
  FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS weight,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS src FROM src),
filled AS (
  SELECT *, 2 * source_size AS cap,
    coalesce(sum(2 * source_size) OVER w, 0) AS caps, coalesce(sum(weight) OVER w, 0) AS weights,
    sum(source_size) OVER () AS all_size, sum(weight) OVER () AS all_weight
  FROM ranked
  WINDOW w AS (ORDER BY 2 * source_size / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
  SELECT *, CAST(cap AS DOUBLE) * (all_weight - weights) <= weight * (all_size * 150 / 100.0::DOUBLE - caps) AS full_up FROM filled),
target AS (
  SELECT source, source_size, src,
    CASE WHEN full_up THEN CAST(cap AS DOUBLE) ELSE
      (all_size * 150 / 100.0::DOUBLE - coalesce(sum(cap) FILTER (full_up) OVER (), 0))
      / (all_weight - coalesce(sum(weight) FILTER (full_up) OVER (), 0)) * weight END AS target
  FROM levels),
queued AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
    CAST(coalesce(sum(s.size) OVER (PARTITION BY t.src ORDER BY md5('{SEED}:' || coalesce(CAST(s.doc_id AS VARCHAR), '')), s.doc_id, s.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sized s JOIN target t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(greatest(0, least(start + size, floor(target)) - start)
     + greatest(0, least(start + source_size + size, floor(target)) - start - source_size) AS BIGINT) AS taken
FROM queued
"""
