"""Interpolated modified Kneser-Ney n-gram model, counted in Spark, scored from memory-mapped arrays.

Words are hashed to 64 bits and numbered by their place among the sorted
hashes.  N-grams are keys packed from the numbers of their context and their
word.  Every level is stored in the shared folder as arrays sorted by key, a
shard per partition; the tasks that score map them into memory and search them
there, so that nothing of the model is copied into a worker.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from typing import Any
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import pieces_of, shared_path, shuffle_partitions, text_of, words_of, written

#: Bits of a word's number within a packed key; bounds the vocabulary, which is checked.
WORD_BITS = 31
#: The end of a text and the context before its first word; 0 is never a word's number.
END, START, UNKNOWN = 1, 2, 3
FIRST = 4


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: crc32 of the id as text leaves 1 modulo 5 (null id: of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def hashes(words: list[str]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(w.encode()) >> 1 for w in words), np.int64, len(words))


def local_folder(spark: SparkSession, label: str) -> str:
    """A folder that every executor can map files from: the shared folder must be a mounted file system."""
    at = urlparse(shared_path(spark, label))
    if at.scheme not in ("", "file"):
        raise ValueError("memory-mapped arrays need spark.checkpoint.dir on a file system mounted on every node, "
                         f"not {at.scheme}://")
    os.makedirs(at.path, exist_ok=True)
    return at.path


def _store(rows: DataFrame, folder: str, name: str, key: str, values: dict[str, str]) -> list[tuple[int, int, str, int]]:
    """Write ``rows`` range-partitioned and sorted by ``key`` as one array file a column and shard.

    Returns (first key, last key, path, rows) of each shard in key order: one
    entry per partition.  A file is renamed into place when whole, so that a
    repeated task replaces it with the same bytes.
    """
    columns = [key, *values]
    kinds = [np.dtype("<i8"), *map(np.dtype, values.values())]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        base = f"{folder}/{name}-{task.partitionId():06d}"
        part = [f"{base}.{c}.{task.taskAttemptId()}" for c in columns]
        n, first, last, files = 0, 0, 0, []
        for batch in batches:
            if not batch.num_rows:
                continue
            files = files or [open(p, "wb") for p in part]
            arrays = [batch.column(i).to_numpy(zero_copy_only=False).astype(t) for i, t in enumerate(kinds)]
            for f, a in zip(files, arrays):
                a.tofile(f)
            first = first if n else int(arrays[0][0])
            last, n = int(arrays[0][-1]), n + len(arrays[0])
        for f, c, p in zip(files, columns, part):
            f.close()
            os.replace(p, f"{base}.{c}")
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (first, last, base, n)], names=["first", "last", "path", "n"])

    parts = rows.select(*columns).repartitionByRange(shuffle_partitions(rows.sparkSession), key).sortWithinPartitions(key)
    shards = parts.mapInArrow(write, "first long, last long, path string, n long").collect()
    return sorted(map(tuple, shards))


class Arrays:
    """Shards of one level, mapped into memory as they are needed."""

    def __init__(self, shards: list[tuple[int, int, str, int]], key: str, values: dict[str, str]):
        self.shards, self.key, self.values = shards, key, values
        self.first = np.array([s[0] for s in shards], np.int64)
        self.base = np.r_[0, np.cumsum([s[3] for s in shards])].astype(np.int64)
        self.maps: dict[int, list[np.ndarray]] = {}

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Each key's place in the level (-1: not there), and the values at it (0)."""
        place = np.full(len(keys), -1, np.int64)
        out = [np.zeros(len(keys), np.dtype(t)) for t in self.values.values()]
        if not len(keys) or not len(self.shards):
            return place, out
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        bounds = np.r_[np.searchsorted(ranked, self.first), len(ranked)]
        for s in np.flatnonzero(np.diff(bounds)):
            if s not in self.maps:
                path = self.shards[s][2]
                self.maps[s] = [np.memmap(f"{path}.{c}", t, "r") for c, t in
                                ((self.key, "<i8"), *self.values.items())]
            stored, *columns = self.maps[s]
            mine = order[bounds[s]:bounds[s + 1]]
            wanted = ranked[bounds[s]:bounds[s + 1]]
            at = np.searchsorted(stored, wanted)
            hit = at < len(stored)
            hit[hit] = stored[at[hit]] == wanted[hit]
            place[mine[hit]] = self.base[s] + at[hit]
            for o, c in zip(out, columns):
                o[mine[hit]] = c[at[hit]]
        return place, out


def _numbers(vocabulary: Arrays, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number and word number of every token of a batch, an end after each text; and the words' own counts."""
    at, codes, words = words_of(texts)
    place, (counts,) = vocabulary.find(hashes(words))
    number = np.where(place >= 0, place + FIRST, UNKNOWN)
    k = len(texts)
    length = np.bincount(at, minlength=k)
    ends = np.cumsum(length + 1) - 1
    tokens = np.empty(len(at) + k, np.int64)
    known = np.zeros(len(at) + k, np.int64)
    inside = np.ones(len(tokens), bool)
    inside[ends] = False
    tokens[ends] = END
    tokens[inside], known[inside] = number[codes], counts[codes]
    return np.repeat(np.arange(k), length + 1), tokens, known


def _contexts(doc: np.ndarray, tokens: np.ndarray, n: int) -> np.ndarray:
    """The packed numbers of the n tokens before each token of its text, START where the text begins."""
    out = np.zeros(len(tokens), np.int64)
    for back in range(n, 0, -1):
        before = np.full(len(tokens), START, np.int64)
        before[back:] = np.where(doc[back:] == doc[:-back], tokens[:-back], START)
        out = (out << WORD_BITS) | before
    return out


class Model:
    """What scoring needs beside the arrays: numbers per level, of bounded size."""

    def __init__(self, order: int, train_tokens: int, distinct: int, ends: int):
        self.order, self.train_tokens, self.distinct, self.ends = order, train_tokens, distinct, ends
        self.vocabulary: Arrays
        self.grams: dict[int, Arrays] = {}
        self.contexts: dict[int, Arrays] = {}
        self.discounts: dict[int, tuple[float, float, float]] = {}
        self.unigrams: tuple[int, int, int, int] = (0, 0, 0, 0)


def _discounts(counts: dict[int, int]) -> tuple[float, float, float]:
    """D1, D2 and D3+ from the numbers of n-grams seen one to four times; where one is missing, the usual fallbacks."""
    n1, n2, n3, n4 = (counts.get(i, 0) for i in (1, 2, 3, 4))
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.01), k - 0.01) for k, d in enumerate(raw, 1))  # type: ignore[return-value]


def fit(docs: DataFrame, order: int = 2) -> Model:
    """Count all texts of ``docs`` and store the model; ``order`` is 2 (bigrams) or 3.

    Counts are summed within each batch and partition before they are
    shuffled; nothing is pruned.  Keys hold ``order - 1`` word numbers, and an
    n-gram is the pair of its context's key and its word.
    """
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    spark = docs.sparkSession
    folder = local_folder(spark, "kneser")
    texts = docs.select(text_of("text").alias("text"))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces_of(batch, 0, 12_000_000):
                _, codes, words = words_of(batch.column(0).slice(a, b - a))
                keys = np.r_[hashes(words), -1]  # -1: the texts, each of which has an end
                n = np.r_[np.bincount(codes, minlength=len(words)), b - a]
                yield pa.RecordBatch.from_arrays([pa.array(keys[n > 0]), pa.array(n[n > 0].astype(np.int64))], names=["key", "n"])

    words = written(texts.mapInArrow(count_words, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "kneser-words")
    total = words.agg(F.sum("n"), F.count(F.lit(1)), F.max(F.when(F.col("key") == -1, F.col("n")))).first()
    model = Model(order, total[0] or 0, total[1], total[2] or 0)
    if total[1] + FIRST >= 1 << WORD_BITS:
        raise ValueError(f"{total[1]} distinct words exceed the packed keys' {WORD_BITS} bits")
    model.vocabulary = Arrays(_store(words.where("key <> -1"), folder, "words", "key", {"n": "<i8"}), "key", {"n": "<i8"})
    vocabulary = model.vocabulary

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces_of(batch, 0, 12_000_000):
                doc, tokens, _ = _numbers(vocabulary, batch.column(0).slice(a, b - a))
                context = _contexts(doc, tokens, order - 1)
                if order == 2:
                    keys, n = np.unique((context << WORD_BITS) | tokens, return_counts=True)
                    context, word = keys >> WORD_BITS, keys & ((1 << WORD_BITS) - 1)
                else:
                    rank = np.lexsort((tokens, context))
                    context, word = context[rank], tokens[rank]
                    first = np.flatnonzero(np.r_[True, (context[1:] != context[:-1]) | (word[1:] != word[:-1])])
                    n = np.diff(np.r_[first, len(word)])
                    context, word = context[first], word[first]
                yield pa.RecordBatch.from_arrays([pa.array(context), pa.array(word.astype(np.int32)), pa.array(n.astype(np.int64))],
                                                 names=["context", "word", "n"])

    grams = texts.mapInArrow(count_grams, "context long, word int, n long").groupBy("context", "word").agg(F.sum("n").alias("n"))
    mask = (1 << WORD_BITS) - 1
    for level in range(order, 1, -1):
        counted = written(grams, f"kneser-{level}")
        model.discounts[level] = _discounts(_of_counts(counted))
        d = model.discounts[level]
        by_context = counted.groupBy("context").agg(
            F.sum("n").alias("total"), *[F.count(F.when(F.col("n") == i, 1)).alias(f"n{i}") for i in (1, 2)],
            F.count(F.when(F.col("n") > 2, 1)).alias("n3"))
        back = F.col("n1") * F.lit(d[0]) + F.col("n2") * F.lit(d[1]) + F.col("n3") * F.lit(d[2])
        kinds = {"total": "<i8", "back": "<f8"}
        model.contexts[level] = Arrays(_store(by_context.withColumn("back", back), folder, f"context{level}", "context", kinds),
                                       "context", kinds)
        # At order 3 a key of two contexts and a word has no room in 64 bits: it is hashed.
        key = F.shiftleft("context", WORD_BITS).bitwiseOR(F.col("word").cast("long")) if level == 2 else \
            F.xxhash64("context", F.col("word").cast("long"))
        model.grams[level] = Arrays(_store(counted.withColumn("key", key), folder, f"gram{level}", "key", {"n": "<i8"}),
                                    "key", {"n": "<i8"})
        # The level below counts in how many contexts each of its n-grams was found.
        below = F.col("context").bitwiseAND(F.lit(mask)) if level == 3 else F.lit(0).cast("long")
        grams = counted.groupBy(below.alias("context"), "word").agg(F.count(F.lit(1)).alias("n"))
    ones = written(grams, "kneser-1")
    model.discounts[1] = _discounts(_of_counts(ones))
    t = ones.agg(F.sum("n"), *[F.count(F.when(F.col("n") == i, 1)) for i in (1, 2)], F.count(F.when(F.col("n") > 2, 1))).first()
    model.unigrams = (t[0] or 0, t[1], t[2], t[3])
    model.grams[1] = Arrays(_store(ones.withColumn("key", F.col("word").cast("long")), folder, "gram1", "key", {"n": "<i8"}),
                            "key", {"n": "<i8"})
    return model


def _of_counts(counted: DataFrame) -> dict[int, int]:
    return {r[0]: r[1] for r in counted.where("n <= 4").groupBy("n").count().collect()}


def _less(count: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.maximum(count - np.array([0.0, *d])[np.minimum(count, 3)], 0.0)


def probabilities(model: Model, doc: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """P(token | the tokens before it), interpolated from the uniform share up to the model's order."""
    total, *by_count = model.unigrams
    _, (n,) = model.grams[1].find(tokens)
    d = model.discounts[1]
    uniform = 1.0 / (model.distinct + 1)
    if not total:
        return np.full(len(tokens), uniform)
    p = _less(n, d) / total + sum(x * y for x, y in zip(by_count, d)) / total * uniform
    for level in range(2, model.order + 1):
        context = _contexts(doc, tokens, level - 1)
        if level == 2:
            keys = (context << WORD_BITS) | tokens
        else:
            keys = xxhash64_of_longs(context, tokens)
        distinct, at = np.unique(keys, return_inverse=True)
        n = model.grams[level].find(distinct)[1][0][at]
        distinct, at = np.unique(context, return_inverse=True)
        place, (total, back) = model.contexts[level].find(distinct)
        seen, total, back = (place >= 0)[at], np.maximum(total, 1)[at], back[at]
        p = np.where(seen, _less(n, model.discounts[level]) / total + back / total * p, p)
    return p


def xxhash64_of_longs(*columns: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 (seed 42) over long columns, vectorised."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda x, r: (x << np.uint64(r)) | (x >> np.uint64(64 - r))
    seed = np.full(len(columns[0]), 42, np.uint64)
    with np.errstate(over="ignore"):
        for c in columns:
            h = (seed + p5 + np.uint64(8)) ^ (turn(c.astype(np.int64).view(np.uint64) * p2, 31) * p1)
            h = turn(h, 27) * p1 + p4
            h = (h ^ (h >> np.uint64(33))) * p2
            h = (h ^ (h >> np.uint64(29))) * p3
            seed = h ^ (h >> np.uint64(32))
    return seed.view(np.int64)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # paths and bounds: a few entries per shard
    schema = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
              "score double, perplexity double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Any = sent.value
        for batch in batches:
            for a, b in pieces_of(batch, 2):
                k = b - a
                doc, tokens, counts = _numbers(m.vocabulary, batch.column(2).slice(a, k))
                counts[tokens == END] = m.ends
                base = np.log10((counts + 0.5) / (m.train_tokens + 0.5 * (m.distinct + 1)))
                logs = np.log10(probabilities(m, doc, tokens))
                n = np.bincount(doc, minlength=k)
                total = np.bincount(doc, logs, minlength=k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, k), batch.column(1).slice(a, k), pa.array(n.astype(np.int64)),
                     pa.array(np.bincount(doc, counts > 0, minlength=k).astype(np.int64)),
                     pa.array(np.full(k, m.train_tokens, np.int64)), pa.array(np.bincount(doc, base, minlength=k)),
                     pa.array(total), pa.array(10.0 ** np.minimum(-total / n, 300.0))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                       text_of("text").alias("text")).mapInArrow(run, schema)


def perplexities(docs: DataFrame, order: int = 2) -> DataFrame:
    """Learn from the rows that are not held out and score every row's whole text.

    A null or empty text is its end alone.  Repeated rows and null ids are
    learnt from and scored each for itself.  With nothing to learn from every
    token has the same share.  An empty table gives no rows; other columns are
    ignored, whatever their names.
    """
    given = docs.select("doc_id", "text")
    return score(given, fit(given.where(~held_out(F.col("doc_id"))), order))
