"""The divergence audit against brute force, and the shared nodes of the trees."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from tests.llm import edge
from tillroll.llm import divergence

WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least=3):
    """(lang, source, part, item, value, rank), sorted, of (lang, source, text) rows."""
    rows = [(lang or "", source or "", WORD.findall(edge.lower(text))) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == lang]
        docs = Counter(t for r in own for t in set(r[2]))
        kept = sorted(t for t, n in docs.items() if n >= least)
        counts = {s: Counter(t for r in own if r[1] == s for t in r[2]) for s in {r[1] for r in own}}
        whole = Counter(t for r in own for t in r[2])

        def share(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 1) // (n + len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        f = lambda a, b: (a - b) * (a - b) // b
        for s in counts:
            pair = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in counts if o != s]
            term = [(f(p[s][t], q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pair), ("term", term)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i) for i, (v, item) in enumerate(found, 1) if part == "pair" or i <= 200]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_trees_share_nodes_and_keep_pairs():
    rng = np.random.default_rng(1)
    counts = rng.choice([0, 0, 0, 0, 1, 2, 5], (6, 300))
    counts[:, 100:] = 0
    counts[3] = counts[2]
    counts[5] = 0
    trees = divergence.Trees(counts)
    assert trees.roots[3] == trees.roots[2] != trees.roots[1]
    # 156 of each tree's 512 leaves beyond the terms, and the empty ones, take one node a level or two.
    assert sum(len(left) for left, _ in trees.children) < 6 * 100 * 2
    others = np.array([0, 2, 3, 4, 5])
    of, a, b, often = trees.pairs(1, others)
    assert len(of) == len({*zip(of.tolist(), a.tolist(), b.tolist())})
    for k, o in enumerate(others):
        expected = Counter(zip(counts[1].tolist(), counts[o].tolist()))
        got = {(int(trees.values[x]), int(trees.values[y])): int(n) for x, y, n in zip(a[of == k], b[of == k], often[of == k])}
        assert got.pop((-1, -1)) == 512 - 300
        assert got == expected


def test_one_term_and_none():
    assert divergence.Trees(np.array([[3], [3]])).pairs(0, np.array([1]))[3].tolist() == [1]
    assert divergence.Trees(np.zeros((2, 0), int)).pairs(0, np.array([1]))[3].tolist() == [1]


def test_shares_are_exact_beyond_64_bits():
    big = 10 ** 15
    assert divergence.shares(np.array([-1, 0, big]), 3 * big, 7).tolist() == [0, 1, 1 + 10 ** 9 * (big + 1) // (3 * big + 7)]


@pytest.mark.parametrize("block, chunk", [(1024, 32), (7, 2), (1, 1)])
def test_audit_equals_brute_force(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "CHUNK", chunk)
    rows = [("en" if i % 4 else "de", f"s{i * i % 7}" if i % 5 else None, " ".join(f"t{chr(97 + (i * j * j + j) % 13)}" for j in range(i % 17))) for i in range(120)]
    rows += [("xx", "a", "only Here"), ("xx", "b", "ÀB été"), (None, None, None), ("xx", "", "été"), ("yy", "a", ""), ("en", "Ω", "ta TA ta tb")]
    df = spark.createDataFrame([(*r, "k") for r in rows], "lang string, source string, text string, term string")
    assert found(divergence.audit(df)) == brute(rows)


def test_audit_awkward_rows(spark):
    rows = [(r[2], r[3], r[1]) for r in edge.rows()]
    assert found(divergence.audit(edge.docs(spark))) == brute(rows)
    assert divergence.audit(edge.empty(spark)).collect() == []
    hot = [("en", "a", "one two"), *[("en", "b", "two three two")] * 500]
    df = spark.createDataFrame(hot, "lang string, source string, text string").repartition(8)
    assert found(divergence.audit(df)) == brute(hot)


def test_audit_of_the_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    expected = brute([(r["lang"], r["source"], r["text"]) for r in df.collect()])
    assert found(divergence.audit(df)) == expected
    assert {r[2] for r in expected} == {"pair", "term"}
