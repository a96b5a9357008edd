"""Quality rules as weak supervision, in DataFrame functions only.

Each rule votes good, votes bad or abstains on a text.  Expectation-
maximisation over the votes estimates how accurate each rule is and what share
of texts is good, without labels; a text is kept when its posterior
probability of being good reaches a threshold.

EM reads the number of documents per combination of votes.  There are at most
3 ** len(RULES) combinations (a fixed 19,683 for nine rules) whatever the number of
documents, so these counts alone go to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import SPACE, own_columns, text_of, written

SYMBOLS = "#*$%&|<>"
#: Bounds of EM: no rule is certain, nor is the share of good texts.
GOOD_ACCURACY, BAD_ACCURACY = (0.6, 0.999), (0.02, 0.99)
PRIOR = (0.05, 0.99)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more.

    Windows are sorted by a 64-bit hash with their positions, equal neighbours
    give the positions of repeated windows, and each of these in turn adds the
    words that the one before did not cover.  n log n in the text's length.
    """
    window = lambda w, i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))
    last = lambda a: F.size(a) - 1

    def repeated(s: Column) -> Column:
        same = lambda a, b: F.get(s, a)["h"] == F.get(s, b)["h"]
        hit = F.filter(F.sequence(F.lit(0), last(s)),
                       lambda j: F.coalesce(same(j, j - 1), F.lit(False)) | F.coalesce(same(j, j + 1), F.lit(False)))
        return F.sort_array(F.transform(hit, lambda j: F.get(s, j)["i"]))

    zero = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    covered = lambda p: F.aggregate(p, zero, lambda acc, i: F.struct(
        i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")), lambda acc: acc["n"])
    found = _let(words, lambda w: _let(
        F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: window(w, i))),
        lambda s: _let(repeated(s), covered)))
    return F.when(F.size(words) > 3, found).otherwise(F.lit(0).cast("long"))


def measures(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and the counts that the rules read, of every whole text (null: none)."""
    text = text_of("text")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, " \t\n\x0b\f\r", "") != "")
    kept = [F.col(c) for c in keep]
    one = docs.select(
        *kept, text.alias("_op_t"), F.array_remove(F.split(text, SPACE, -1), "").alias("_op_words"), lines.alias("_op_lines"),
        F.translate(text, " \t\n\x0b\f\r", "").alias("_op_chars"))
    return one.select(
        *kept,
        F.size("_op_words").cast("long").alias("n_words"),
        F.length("_op_chars").cast("long").alias("word_chars"),
        (F.length("_op_t") - F.length(F.translate("_op_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_op_lines") - F.size(F.array_distinct("_op_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_op_words")).alias("n_repeat_words"),
        F.size("_op_lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("_op_chars", r"\P{L}+", "")).cast("long").alias("n_letters"),
        F.length(F.regexp_replace("_op_chars", r"\P{Lu}+", "")).cast("long").alias("n_upper"),
        (F.length("_op_chars") - F.length(F.translate("_op_chars", "!?", ""))).cast("long").alias("n_shouts"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _vote(value: Column, good: Column, bad: Column) -> Column:
    return F.when(value.isNull(), F.lit(0)).when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))


def rules() -> dict[str, Column]:
    """Name to vote: 1 good, -1 bad, 0 abstains.  Shares of nothing abstain."""
    share = lambda a, b: F.col(a) / F.nullif(F.col(b), F.lit(0))
    between = lambda v, good, bad: _vote(v, v <= good, v > bad)
    words, mean = F.col("n_words"), share("word_chars", "n_words")
    letters, upper = share("n_letters", "word_chars"), share("n_upper", "n_letters")
    return {
        "length": _vote(words, words >= 100, words < 50),
        "word_length": _vote(mean, (mean >= 3) & (mean <= 9), (mean < 2) | (mean > 14)),
        "symbols": between(share("n_symbols", "word_chars"), 0.01, 0.08),
        "symbols_per_word": between(share("n_symbols", "n_words"), 0.05, 0.4),
        "dup_lines": between(share("n_dup_lines", "n_lines"), 0.05, 0.5),
        "repeats": between(share("n_repeat_words", "n_words"), 0.1, 0.4),
        "letters": _vote(letters, letters >= 0.85, letters < 0.7),
        "upper": between(upper, 0.15, 0.5),
        "shouts": between(share("n_shouts", "n_words"), 0.1, 0.5),
    }


def fit(patterns: list[tuple[tuple[int, ...], int]], iterations: int = 100) -> tuple[float, list[tuple[float, float]]]:
    """EM over (votes, documents): the share of good texts, and how accurate each rule is on good and on bad texts.

    A rule that votes is right with an accuracy of its own on either class, as
    a rule that looks for one fault is rarely wrong when it objects and often
    when it does not; abstaining says nothing.  No documents: the starting values.
    """
    k = len(patterns[0][0]) if patterns else 0
    prior, accuracy = 0.85, [(0.97, 0.4)] * k
    for _ in range(iterations):
        weights = [0.0, 0.0]
        right, voted = [[0.0, 0.0] for _ in range(k)], [[0.0, 0.0] for _ in range(k)]
        for votes, n in patterns:
            good = _posterior(prior, accuracy, votes)
            for c, share in enumerate((good, 1 - good)):
                weights[c] += n * share
                for j, v in enumerate(votes):
                    if v:
                        voted[j][c] += n * share
                        right[j][c] += n * share * (v == (1, -1)[c])
        if not sum(weights):
            break
        prior = _clamp(weights[0] / sum(weights), PRIOR)
        accuracy = [(_clamp((r[0] + 1) / (v[0] + 2), GOOD_ACCURACY), _clamp((r[1] + 1) / (v[1] + 2), BAD_ACCURACY))
                    for r, v in zip(right, voted)]
        # A rule is never worse than chance: it objects to bad texts at least as often as to good ones.
        accuracy = [(a, max(b, 1 - a)) for a, b in accuracy]
    return prior, accuracy


def _clamp(x: float, bounds: tuple[float, float]) -> float:
    return min(max(x, bounds[0]), bounds[1])


def _weights(accuracy: tuple[float, float]) -> tuple[float, float]:
    """What a good and a bad vote add to the log odds of a good text."""
    a, b = accuracy
    return math.log(a / (1 - b)), math.log((1 - a) / b)


def _posterior(prior: float, accuracy: list[tuple[float, float]], votes: tuple[int, ...]) -> float:
    x = math.log(prior / (1 - prior))
    for a, v in zip(accuracy, votes):
        x += _weights(a)[0] if v > 0 else _weights(a)[1] if v < 0 else 0.0
    return 1 / (1 + math.exp(-x))


def posterior(votes: Mapping[str, Column], prior: float, accuracy: list[tuple[float, float]]) -> Column:
    """The probability of being good as an expression over the votes."""
    x = F.lit(math.log(prior / (1 - prior)))
    for v, a in zip(votes.values(), accuracy):
        good, bad = _weights(a)
        x = x + F.when(v > 0, good).when(v < 0, bad).otherwise(0.0)
    return 1 / (1 + F.exp(-x))


def _scored(measured: DataFrame, threshold: float) -> DataFrame:
    votes = rules()
    # The model is learnt over all documents; those that the base rules fail take part as well.
    counted = measured.groupBy(*[v.alias(k) for k, v in votes.items()]).count().collect()
    patterns = sorted((tuple(r[: len(votes)]), r["count"]) for r in counted)
    prior, accuracy = fit(patterns)
    return measured.withColumn("base_failed", base_failed()).withColumn(
        "quality", posterior(votes, prior, accuracy) if patterns else F.lit(0.0)).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def judge(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per document: ``doc_id``, the counts, ``base_failed``, ``quality`` (the posterior) and ``kept``.

    Null, empty and blank texts have no words and fail the base; rows with a
    null id or repeated rows are judged each for itself; an empty table gives
    no rows.  Other columns are ignored, whatever their names.
    """
    measured = written(measures(docs.select("doc_id", "text")), "quality")
    return _scored(measured, threshold)


def good_documents(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, columns unchanged, whose text is kept.

    Two scans: one for the documents per combination of votes, one that judges
    each row where it is read, so that no text is shuffled, joined or copied.  Null, empty and blank texts go; repeated
    rows are judged alike and each stays or goes; null ids and other columns
    change nothing; an empty table gives no rows; very long texts are one row's
    arrays of words and lines.
    """
    own_columns(docs)
    measured = measures(docs.withColumn("_op_all", F.struct(*docs.columns)), ("_op_all",))
    return _scored(measured, threshold).where("kept").select("_op_all.*")
