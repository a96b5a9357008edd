"""Language identification by words first, backing off to shorter and shorter character n-grams.

A known word scores by its log frequency in each language.  An unseen word is
scored by its longest character n-grams that training knows, falling back to
shorter ones where none of a length is known.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import pieces_of, text_of, words_of

#: The classifier is fitted on at most so many documents of each language, chosen by a hash of the id.
SAMPLE_PER_LANGUAGE = 1500
#: Words and n-grams kept for each language, most frequent first: the bound of the model that is sent to the tasks.
MODEL_WORDS, MODEL_GRAMS = 20_000, 20_000
MAX_LANGUAGES = 400
GRAMS = (4, 3, 2, 1)
UNKNOWN = "und"
#: Unseen words remembered within a task.
REMEMBERED = 300_000


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: crc32 of the id as text leaves 2 modulo 4 (null id: of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def letters(word: str) -> str:
    """The word without what is not a letter at its ends, lower-cased; empty if it has no letter."""
    if word.isalpha():
        return word.lower()
    a, b = 0, len(word)
    while a < b and not word[a].isalpha():
        a += 1
    while b > a and not word[b - 1].isalpha():
        b -= 1
    return word[a:b].lower()


def grams(word: str, n: int) -> list[str]:
    padded = f"^{word}$" if n > 1 else word
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


class Model:
    """Log frequencies by language: of words, and of n-grams for each length."""

    def __init__(self, languages: list[str], word_counts: dict[str, Counter], gram_counts: dict[str, Counter], prior: list[float]):
        self.languages, self.prior = languages, np.log(np.array(prior))
        self.words, self.word_table = self._table([word_counts[x] for x in languages])
        self.grams, self.gram_table = {}, {}
        for n in GRAMS:
            self.grams[n], self.gram_table[n] = self._table(
                [Counter({g: c for g, c in gram_counts[x].items() if len(g) == n}) for x in languages])

    @staticmethod
    def _table(counts: list[Counter]) -> tuple[dict[str, int], np.ndarray]:
        keys = {k: i for i, k in enumerate(sorted(set().union(*counts)))}
        table = np.full((len(keys), len(counts)), 0.5)
        for j, c in enumerate(counts):
            for k, n in c.items():
                table[keys[k], j] += n
        return keys, np.log(table / (table.sum(axis=0, keepdims=True) + 0.5))

    def unseen(self, word: str) -> np.ndarray:
        """Mean log frequency of the known n-grams of the longest length that has any."""
        for n in GRAMS:
            rows = [i for g in grams(word, n) if (i := self.grams[n].get(g)) is not None]
            if rows:
                return self.gram_table[n][rows].mean(axis=0)
        return np.zeros(len(self.languages))


def _counts(docs: DataFrame, sample: int) -> tuple[dict[str, Counter], dict[str, Counter], dict[str, int]]:
    """Words and n-grams of a bounded sample of labelled documents, counted in Spark, the most frequent collected."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], int] = defaultdict(int)
        for batch in batches:
            for a, b in pieces_of(batch, 1):
                coded = batch.column(0).slice(a, b - a).dictionary_encode()
                langs = coded.dictionary.to_pylist()
                at, codes, words = words_of(batch.column(1).slice(a, b - a))
                clean = [letters(w) for w in words]
                pairs = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[at] * len(words) + codes
                for pair, n in zip(*(x.tolist() for x in np.unique(pairs, return_counts=True))):
                    if word := clean[pair % len(words)]:
                        found[langs[pair // len(words)], word] += n
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found]), pa.array([k[1] for k in found]),
                                              pa.array(list(found.values()), pa.int64())], names=["lang", "word", "n"])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str, str], int] = defaultdict(int)
            for lang, word, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for size in GRAMS:
                    for g in grams(word, size):
                        found[lang, g] += n
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found]), pa.array([k[1] for k in found]),
                                                  pa.array(list(found.values()), pa.int64())], names=["lang", "word", "n"])

    from pyspark.sql import Window

    labelled = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    size = labelled.groupBy("lang").count().collect()  # a row per language
    if len(size) > MAX_LANGUAGES:
        raise ValueError(f"{len(size)} languages; the model is bounded by MAX_LANGUAGES = {MAX_LANGUAGES}")
    if not size:
        return {}, {}, {}
    # Twice the sample's share by hash, so that all but never the sample is whole, then at most the sample.
    part = F.create_map(*[x for r in size for x in (F.lit(r["lang"]), F.lit(min(1.0, 2 * sample / r["count"])))])
    order = F.xxhash64(F.lit("langid"), F.col("doc_id"))
    chosen = labelled.withColumn("_op_h", order).where(F.pmod("_op_h", F.lit(1_000_003)) < F.element_at(part, F.col("lang")) * 1_000_003)
    ids = chosen.select("lang", "_op_h").groupBy("lang", "_op_h").count()
    before = F.sum("count").over(Window.partitionBy("lang").orderBy("_op_h").rowsBetween(Window.unboundedPreceding, -1))
    kept = ids.withColumn("_op_b", F.coalesce(before, F.lit(0))).where(F.col("_op_b") < sample)
    limit = kept.groupBy("lang").agg(F.max("_op_h").alias("_op_max")).collect()
    last = F.create_map(*[x for r in limit for x in (F.lit(r["lang"]), F.lit(r["_op_max"]))])
    sampled = chosen.where(F.col("_op_h") <= F.element_at(last, F.col("lang"))).select("lang", text_of("text").alias("text"))
    words = sampled.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))

    def top(df: DataFrame, most: int) -> dict[str, Counter]:
        rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
        out: dict[str, Counter] = defaultdict(Counter)
        for r in df.withColumn("_op_r", rank).where(F.col("_op_r") <= most).select("lang", "word", "n").collect():
            out[r["lang"]][r["word"]] = r["n"]
        return out

    spelt = words.mapInArrow(spell, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return top(words, MODEL_WORDS), top(spelt, MODEL_GRAMS), {r["lang"]: r["count"] for r in size}


def fit(docs: DataFrame, sample: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """Fit on the texts with a lang that are not held out; None where there are none."""
    words, spelt, size = _counts(docs, sample)
    known = sorted(x for x in size if words[x])
    if not known:
        return None
    # Equal priors: how common a language is in the corpus says little about one text.
    return Model(known, words, spelt, [1 / len(known)] * len(known))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row, from its whole text alone."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)  # bounded by MAX_LANGUAGES, MODEL_WORDS and MODEL_GRAMS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        seen: dict[str, int] = {}
        rows = np.zeros((1024, len(m.languages) if m else 1))
        used = 0
        for batch in batches:
            for a, b in pieces_of(batch, 2):
                k = b - a
                at, codes, words = words_of(batch.column(2).slice(a, k))
                place = np.full(len(words), -1)
                if used > REMEMBERED:
                    seen, used = {}, 0
                for c, w in enumerate(words):
                    if (i := seen.get(w)) is None:
                        clean, i = letters(w), -1
                        if clean:
                            i, used = used, used + 1
                            if used > len(rows):
                                rows = np.concatenate([rows, np.zeros_like(rows)])
                            if m:
                                j = m.words.get(clean)
                                rows[i] = m.word_table[j] if j is not None else m.unseen(clean)
                        seen[w] = i
                    place[c] = i
                at, where = at, place[codes]
                full = where >= 0
                at, where = at[full], where[full]
                n = np.bincount(at, minlength=k)
                if not m:
                    pred, score = [UNKNOWN] * k, np.zeros(k)
                else:
                    total = np.column_stack([np.bincount(at, rows[where, j], minlength=k) for j in range(rows.shape[1])]) + m.prior
                    total -= total.max(axis=1, keepdims=True)
                    share = np.exp(total)
                    share /= share.sum(axis=1, keepdims=True)
                    best = np.argmax(share, axis=1)
                    pred = [m.languages[x] if c else UNKNOWN for x, c in zip(best, n)]
                    score = np.where(n > 0, share[np.arange(k), best], 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, k), batch.column(1).slice(a, k), pa.array(pred, pa.string()), pa.array(score)],
                    names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                       text_of("text").alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, sample: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """Learn from the rows that are not held out and predict every row.

    ``und`` with score 0 where the text is null or has no letter, or where there
    is nothing to learn from.  Ties go to the language first by code point.
    Repeated rows and null ids are predicted each for itself; an empty table
    gives no rows; other columns are ignored, whatever their names.
    """
    given = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    return predict(given, fit(given, sample))
