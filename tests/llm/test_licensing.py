"""License notices against brute force over the whole definition."""

from __future__ import annotations

import re

from tests.llm import edge
from tillroll.llm import licensing

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(edge.lower(text))


def pairs(w):
    return {f"{a} {b}" for a, b in zip(w, w[1:])}


def brute(text, templates=licensing.TEMPLATES, percent=75):
    w = words(text)
    at, base = [], set()
    for phrase, label in licensing.PHRASES.items():
        p = phrase.split()
        here = [i for i in range(len(w)) if w[i:i + len(p)] == p]
        at += here
        base |= {label} if here else set()
    labels, best = set(base), 1.0 if at else 0.0
    for block in re.split(r"\n[\x20\x09\x0B-\x0D]*\n", text or ""):
        b = pairs(words(block))
        for label, texts in templates.items():
            for t in texts:
                need = pairs(words(t))
                if need and 100 * len(b & need) >= percent * len(need):
                    labels.add(label)
                    best = max(best, len(b & need) / len(need))
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), best)


def check(spark, texts, **kw):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, row string, tokens int")
    found = {r["doc_id"]: tuple(r)[1:] for r in licensing.licenses(df, **kw).collect()}
    assert len(found) == len(texts)
    for i, t in enumerate(texts):
        assert found[i] == brute(t, **kw), (i, t, found[i])
    return found


def notices():
    mit, bsd = licensing.TEMPLATES["mit"][1], licensing.TEMPLATES["bsd"][0]
    w = mit.split()
    return [
        mit, "Some prose.\n\n" + mit.upper() + "\n \t\nmore", mit.replace(" ", "\n  # "), " ".join(w[:len(w) * 8 // 10]), " ".join(w[:len(w) * 7 // 10]),
        " ".join(w[:40]) + "\n\n" + " ".join(w[40:]), edge.prose(2, 3000) + " " + bsd + " " + edge.prose(4, 3000), bsd + " " + bsd,
        "under the MIT license under the mit license, CC-BY-NC and Apache License, Version 2", "UNDER THE MIT LİCENSE", "under the mit licenseé",
        "under the \N{KELVIN SIGN}it license", "Licensed under CC BY 4.0", "cc by nc cc by nc", "This work is licensed under the GNU General Public License, version 3.",
        "released under the MIT licence agreement", "of the software without restriction including without limitation the rights",
    ]


def test_notices_equal_brute_force(spark):
    found = check(spark, notices())
    assert found[2][5] == "mit" and found[3][5] == "mit" and found[4][5] == "" and found[6][5] == "bsd" and found[14][5] == "gpl-3"
    assert found[9][1] == 0 and found[10][1] == 0 and found[8][1:4] == (4, 0, 12)


def test_awkward_rows_and_templates(spark):
    rows = edge.rows()
    found = sorted(map(repr, (tuple(r) for r in licensing.licenses(edge.docs(spark)).collect())))
    assert found == sorted(repr((r[0], *brute(r[1]))) for r in rows)
    assert licensing.licenses(edge.empty(spark)).collect() == []
    texts = [*notices(), None, "", "a b c d", "b c"]
    check(spark, texts, templates={})
    check(spark, texts, templates={"empty": ("", "one"), "letters": ("a b c d", "b c")}, percent=60)
    check(spark, texts, percent=100)


def test_blocks_of_a_hot_notice(spark):
    """Spans are reported per block; a third of all rows hold one notice."""
    mit = licensing.TEMPLATES["mit"][1]
    texts = [("prose here\n\n" + mit if i % 3 == 0 else edge.prose(i, 20)) for i in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    base, found = licensing.scan(df)
    assert base.count() == 300
    rows = found.groupBy("label", "block", "containment").count().collect()
    assert [tuple(r) for r in rows] == [("mit", 1, 1.0, 100)]


def test_given_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    expected = sorted((r["doc_id"], *brute(r["text"])) for r in docs.collect())
    key = lambda r: (r[0], str(r))
    assert sorted((tuple(r) for r in licensing.licenses(docs).collect()), key=key) == sorted(expected, key=key)
    assert sum(bool(r[6]) for r in expected) > 20
