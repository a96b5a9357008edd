"""Importance resampling against brute force, and the interning table's parts."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash

from tests.llm import edge
from tillroll.llm import ngrams, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = ["", "Ab c1!d\x00é", "x", "---", "tail", "Zed", " end ", "a" * 300 + " b " + "c" * 127 + " d " + "e" * 126 + " f" + " g" * 3,
         "", "日本語テキスト " * 9, "q"]


def grams(text, most=3):
    w = WORD.findall(edge.lower(text))
    return [" ".join(w[i:i + k]) for k in range(1, most + 1) for i in range(len(w) - k + 1)]


def brute(rows, target, percent=5, min_words=20, buckets=10_000):
    """(doc_id, n_features, weight, score, rank) as a sorted list; nulls as -1."""
    count = lambda texts: Counter(zlib.crc32(g.encode()) % buckets for t in texts for g in grams(t))
    source, wanted = count(t for _, t in rows), count(target)
    s_all, t_all = sum(source.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s_all + buckets) / ((source[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    out = []
    for i, t in rows:
        g = grams(t)
        weight = sum(gain[zlib.crc32(x.encode()) % buckets] for x in g)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(WORD.findall(edge.lower(t)))])
    able = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = rank
    return sorted(tuple(-1 if x is None else x for x in r[:5]) for r in out)


def found(df):
    return sorted(tuple(-1 if x is None else x for x in r) for r in df.collect())


def test_words_and_runs():
    for digits, rx in ((True, WORD), (False, re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"))):
        w = ngrams.words(pa.array(TEXTS), ngrams.byte_class(digits))
        expected = [(i, x) for i, t in enumerate(TEXTS) for x in rx.findall(edge.lower(t))]
        assert list(zip(w.text.tolist(), w.strings().to_pylist())) == expected
    w = ngrams.words(pa.array(TEXTS), ngrams.byte_class(True))
    seen = []
    for first, last in ngrams.runs(w, 3, chunk=4):
        strings = [w.data[w.start[i]:w.end[j]].tobytes() for i, j in zip(first, last)]
        assert [zlib.crc32(x) for x in strings] == ngrams.crc32(w, first, last).tolist()
        seen += [x.decode() for x in strings]
    assert sorted(seen) == sorted(g for t in TEXTS for g in grams(t))


def test_hash_equals_the_library():
    rng = random.Random(1)
    data = np.frombuffer(bytes(rng.randrange(256) for _ in range(3000)) + bytes(8), np.uint8)
    start = np.array([rng.randrange(2500) for _ in range(2000)])
    end = start + np.array([rng.randrange(200) for _ in range(2000)])
    assert ngrams.xxhash64(data, start, end).tolist() == [xxhash.xxh64_intdigest(data[i:j].tobytes()) for i, j in zip(start, end)]


def test_clashing_keys_keep_their_own_slots():
    w = ngrams.words(pa.array(["a b a c b a " + "x" * 200 + " " + "x" * 200 + " " + "x" * 199 + "y"]), ngrams.byte_class(True))
    slot, owner = ngrams.intern(w.data, w.start, w.end, np.full(len(w.start), 7, np.uint64))
    by_word = {}
    for s, x in zip(slot.tolist(), w.strings().to_pylist()):
        assert by_word.setdefault(x, s) == s
    assert len(set(by_word.values())) == len(by_word) == (owner >= 0).sum() == 5


def test_resample_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("text")
    expected = brute([tuple(r) for r in docs.collect()], [r[0] for r in target.collect()])
    assert found(resample.resample(docs, target)) == expected
    assert sum(r[4] > 0 for r in expected) == 5 * sum(len(WORD.findall(edge.lower(r["text"]))) >= 20 for r in docs.collect()) // 100


def test_resample_awkward_rows(spark):
    docs, none = edge.docs(spark), edge.empty(spark)
    rows = [(r[0], r[1]) for r in edge.rows()]
    target = spark.createDataFrame([(None,), ("w1 w2 w3",), ("",)], "text string")
    assert found(resample.resample(docs, target, percent=40)) == brute(rows, [None, "w1 w2 w3", ""], percent=40)
    assert found(resample.resample(docs, none, percent=40)) == brute(rows, [], percent=40)
    assert resample.resample(none, target).collect() == []
    kept = resample.drawn(docs, target, percent=40)
    assert kept.columns == docs.columns
    ranked = [r for r in brute(rows, [None, "w1 w2 w3", ""], percent=40) if r[4] > 0]
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect()) == sorted(r[0] for r in ranked)
    assert resample.drawn(none, target).collect() == []


def test_long_texts_in_chunks_and_one_hot_document(spark):
    long = edge.prose(3, 300_000)
    rows = [(1, long), (2, "z" * 2_000_000), *[(7, edge.prose(5, 30))] * 400]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    target = spark.createDataFrame([(edge.prose(5, 30),)], "text string")
    assert found(resample.resample(docs, target)) == brute(rows, [edge.prose(5, 30)])
