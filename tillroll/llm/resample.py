"""Target-distribution importance resampling over hashed n-grams.

Features of a text are its runs of one to three consecutive words.  Documents
are scored by how much likelier their features' buckets are in a target corpus
than among all documents, Gumbel noise that is keyed by document is added, and
the highest scores are drawn: a sample without replacement by importance.

Each batch of texts interns its n-grams in an open-addressed NumPy table, with
xxhash64 keys and verified bytes.  A slot holds its n-gram's bucket and count,
so a bucket is computed once per different n-gram; the slot of each occurrence
then gathers the bucket's gain.

Two scans of the documents: counts per bucket, of which every task passes on
one row per bucket, and the scores.  The gains, one number per bucket, go to
the tasks.  Ranks come from a range partitioning of scores, not from one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import own_columns, pieces_of, running_total, text_of, written
from tillroll.llm.ngrams import Words, byte_class, crc32, intern, runs, words, xxhash64

BUCKETS = 10_000
#: Words of the longest feature.
MOST = 3
SEED = 42
PERCENT, MIN_WORDS = 5, 20
#: Bytes of text whose n-grams are interned together.
BATCH = 2_000_000


def _slots(found: Words, most: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk of words: each occurrence's text and slot, and each slot's bucket and count."""
    for first, last in runs(found, most):
        start, end = found.start[first], found.end[last]
        slot, owner = intern(found.data, start, end, xxhash64(found.data, start, end))
        bucket = np.zeros(len(owner), np.int64)
        taken = np.flatnonzero(owner >= 0)
        bucket[taken] = crc32(found, first[owner[taken]], last[owner[taken]]) % buckets
        yield found.text[first], slot, bucket, np.bincount(slot, minlength=len(owner))


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, most: int = MOST) -> np.ndarray:
    """Occurrences of all texts' features per bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, letters = np.zeros(buckets, np.int64), byte_class(digits=True)
        for batch in batches:
            for a, b in pieces_of(batch, 0, BATCH):
                for _, _, bucket, n in _slots(words(batch.column(0).slice(a, b - a), letters), most, buckets):
                    # Floats are exact here: a chunk of words has few occurrences.
                    table += np.bincount(bucket, n, buckets).astype(np.int64)
        some = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(table[some])], names=["bucket", "n"])

    counted = docs.select(text_of("text").alias("text")).mapInArrow(count, "bucket long, n long")
    table = np.zeros(buckets, np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row per bucket at most
        table[r["bucket"]] = r["n"]
    return table


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, the log of its smoothed share in the target over that in the source, in thousandths, rounded down."""
    k, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + k) / ((s + 1) * (t_all + k))))
                     for s, t in zip(source.astype(float).tolist(), target.astype(float).tolist())], np.int64)


def _weighed(docs: DataFrame, text: str, gain: np.ndarray, most: int) -> DataFrame:
    """``docs`` with ``_op_words``, ``_op_features`` and ``_op_weight``, its sum of gains, and a number per row; without the column ``text``."""
    names = [c for c in docs.columns if c != text]
    at = docs.columns.index(text)
    new = ["_op_words", "_op_features", "_op_weight", "_op_number"]
    schema = T.StructType([f for f in docs.schema.fields if f.name != text] + [T.StructField(c, T.LongType()) for c in new])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        letters, row = byte_class(digits=True), TaskContext.get().partitionId() << 33
        for batch in batches:
            for a, b in pieces_of(batch, at, BATCH):
                n = b - a
                found = words(batch.column(at).slice(a, n), letters)
                features, weight = np.zeros(n, np.int64), np.zeros(n, np.int64)
                for of, slot, bucket, _ in _slots(found, most, len(gain)):
                    features += np.bincount(of, minlength=n)
                    weight += np.bincount(of, gain[bucket][slot], n).astype(np.int64)
                own = [c for i, c in enumerate(batch.columns) if i != at]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(a, n) for c in own), pa.array(np.bincount(found.text, minlength=n)), pa.array(features),
                     pa.array(weight), pa.array(np.arange(row, row + n))], names=[*names, *new])
                row += n

    return docs.mapInArrow(weigh, schema)


def _score(seed: int) -> Column:
    """The weight plus Gumbel noise keyed by the document's id, in thousandths."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_op_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    uniform = (h.cast("long").cast("double") + 0.5) / 4294967296.0
    return (F.col("_op_weight") + F.floor(-1000 * F.ln(-F.ln(uniform)))).cast("long")


def _ranked(weighed: DataFrame, percent: int, min_words: int, seed: int) -> DataFrame:
    """Adds ``_op_score`` and ``_op_rank`` (null: not drawn)."""
    scored = weighed.withColumn("_op_score", _score(seed)).withColumn("_op_out", (F.col("_op_words") < min_words).cast("int")).withColumn("_op_one", F.lit(1).cast("long"))
    order = [F.col("_op_out"), F.col("_op_score").desc(), F.col("_op_id").asc_nulls_last(), F.col("_op_number")]
    placed = running_total(scored, order, "_op_one", "_op_before")
    drawn = percent * placed.where("_op_out = 0").count() // 100
    return placed.withColumn("_op_rank", F.when((F.col("_op_out") == 0) & (F.col("_op_before") < drawn), F.col("_op_before") + 1))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
             buckets: int = BUCKETS, most: int = MOST) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_features, weight, score, rank``; ``rank`` counts the drawn rows and is null for others.

    Null, empty and blank texts have no features and the weight 0; they are
    drawn only if ``min_words`` is 0.  A null id hashes as an empty one and
    comes last among equal scores; repeated rows are drawn each for itself, in
    any order, as they are equal.  Texts are read whole: a very long one is
    interned in chunks of a million words, whose sums add up.  Empty tables
    give no rows, an empty target leaves the smoothing alone.  Other columns
    are ignored, whatever their names.
    """
    gain = gains(bucket_counts(docs, buckets, most), bucket_counts(target, buckets, most))
    given = docs.select(F.col("doc_id").cast("long").alias("_op_id"), text_of("text").alias("_op_text"))
    # Written first, as a range partitioning reads its input twice.
    out = _ranked(written(_weighed(given, "_op_text", gain, most), "weighed"), percent, min_words, seed)
    return out.select(F.col("_op_id").alias("doc_id"), F.col("_op_features").alias("n_features"), F.col("_op_weight").alias("weight"),
                      F.col("_op_score").alias("score"), F.col("_op_rank").alias("rank"))


def drawn(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
          buckets: int = BUCKETS, most: int = MOST) -> DataFrame:
    """The rows of ``docs`` that :func:`resample` draws, columns unchanged.

    Only rows that reach the lowest drawn score are moved, not all texts.
    """
    own_columns(docs)
    gain = gains(bucket_counts(docs, buckets, most), bucket_counts(target, buckets, most))
    narrow = docs.select(F.col("doc_id").cast("long").alias("_op_id"), text_of("text").alias("_op_text"))
    ranks = _ranked(written(_weighed(narrow, "_op_text", gain, most), "weighed"), percent, min_words, seed)
    last = ranks.agg(F.min(F.when(F.col("_op_rank").isNotNull(), F.col("_op_score"))).alias("s"), F.count("_op_rank").alias("n")).first()
    wide = docs.select("*", F.col("doc_id").cast("long").alias("_op_id"), text_of("text").alias("_op_text"))
    able = _weighed(wide, "_op_text", gain, most).where(F.col("_op_words") >= min_words).withColumn("_op_score", _score(seed))
    able = written(able.where(F.col("_op_score") >= (last["s"] if last["n"] else 0)).withColumn("_op_one", F.lit(1).cast("long")), "drawn")
    order = [F.col("_op_score").desc(), F.col("_op_id").asc_nulls_last(), F.col("_op_number")]
    return running_total(able, order, "_op_one", "_op_before").where(F.col("_op_before") < last["n"]).select(*docs.columns)
