"""Near duplicates within large groups, against brute force."""

from __future__ import annotations

import random
from collections import Counter

from tests.llm import edge
from tillroll.llm import jaccard


def found(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(df).collect())


def words(rng, n):
    return [f"v{rng.randrange(10 ** 6)}" for _ in range(n)]


def edited(rng, base, edits):
    out = list(base)
    for i in rng.sample(range(len(out)), edits):
        out[i] = f"x{rng.randrange(10 ** 6)}"
    return out


def test_a_third_of_all_rows_alike_but_not_enough(spark):
    """Members share a passage and are below the threshold to each other; a few pairs among them are not."""
    rng = random.Random(7)
    passage, rows = words(rng, 60), []
    for i in range(240):
        text = words(rng, 25) + passage + words(rng, 25) if i % 3 == 0 else words(rng, 110)
        rows.append((i, " ".join(text)))
        if i % 40 == 0:
            rows.append((1000 + i, " ".join(edited(rng, text, 2))))
    expected = edge.brute_components(rows)
    assert found(spark, rows) == expected and sum(c[0] != c[2] for c in expected) == 6


def test_near_copies_of_one_text_at_every_distance(spark):
    """Copies of one text with 0 to 12 edits each: links, chains and gaps in one group."""
    rng = random.Random(11)
    base = words(rng, 120)
    rows = [(i, " ".join(edited(rng, base, i % 13))) for i in range(160)] + [(500 + i, " ".join(words(rng, 90))) for i in range(100)]
    expected = edge.brute_components(rows)
    assert found(spark, rows) == expected and 1 < len({c[2] for c in expected}) < len(rows)


def test_chains_and_containment(spark):
    """A window slides over one long text, so that only neighbours link; and texts that contain others."""
    rng = random.Random(13)
    long = words(rng, 900)
    rows = [(i, " ".join(long[i * 12:i * 12 + 120])) for i in range(60)]
    rows += [(200 + i, " ".join(long[:80 + 6 * i])) for i in range(30)]
    assert found(spark, rows) == edge.brute_components(rows)
