"""Operators over documents, against brute force on awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.conftest import sf_dir
from tests.llm import edge
from tillroll.llm import jaccard, kneser, langid, mixing, packing, pii, quality


# ---- 9 quality -------------------------------------------------------------

def counts(text):
    text = text or ""
    w = edge.WORDS.findall(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    seen = Counter(windows)
    covered = {k for i, x in enumerate(windows) if seen[x] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if edge.WORDS.search(x)]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_quality_counts_and_verdicts(spark):
    got = quality.judge(edge.docs(spark)).collect()
    want = Counter((d, *counts(t)) for d, t, *_ in edge.rows())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept is not None and not (r.kept and r.base_failed)


def test_quality_empty_table(spark):
    assert quality.judge(edge.empty(spark)).collect() == []
    kept = quality.good_documents(edge.empty(spark))
    assert kept.columns == edge.empty(spark).columns and kept.collect() == []


def test_quality_learns_a_fault_and_keeps_clean(spark):
    clean = [(i, edge.prose(i, 120)) for i in range(300)]
    junk = [(1000 + i, " ".join(w + "%%%" for w in edge.prose(i, 120).split())) for i in range(30)]
    out = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(clean + junk, "doc_id long, text string")).collect()}
    assert all(out[i] for i, _ in clean) and not any(out[i] for i, _ in junk)


def test_quality_em_against_its_likelihood():
    rng = random.Random(1)
    accuracy = [(0.95, 0.7), (0.9, 0.6), (0.97, 0.8), (0.92, 0.75)]
    rows = Counter()
    for _ in range(20_000):
        good = rng.random() < 0.8
        rows[tuple((1 if (rng.random() < a[0 if good else 1]) == good else -1) if rng.random() < 0.9 else 0 for a in accuracy)] += 1
    prior, found = quality.fit(sorted(rows.items()))
    assert prior == pytest.approx(0.8, abs=0.03)
    for (a, b), (x, y) in zip(accuracy, found):
        assert x == pytest.approx(a, abs=0.03) and y == pytest.approx(b, abs=0.06)


def test_reserved_names_are_refused(spark):
    bad = spark.createDataFrame([(1, "x", "y")], "doc_id long, text string, _op_key string")
    for run in (quality.good_documents, jaccard.one_of_each, pii.replace):
        with pytest.raises(ValueError):
            run(bad)


# ---- 4 near duplicates -----------------------------------------------------

def test_near_duplicates_on_edges(spark):
    got = jaccard.near_duplicates(edge.docs(spark)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == edge.brute_components([r[:2] for r in edge.rows()])
    assert jaccard.near_duplicates(edge.empty(spark)).collect() == []


def near_copies(seed: int) -> list[tuple]:
    """Chains of edits, groups of copies, and a passage that half of the texts share."""
    rng = random.Random(seed)
    words = [f"t{i}" for i in range(400)]
    passage = " ".join(rng.choices(words, k=60))
    out = []
    for g in range(25):
        base = rng.choices(words, k=rng.choice([4, 5, 7, 20, 60, 120]))
        for _ in range(rng.choice([1, 2, 5, 12])):
            text = " ".join(base)
            out.append(text + " " + passage if rng.random() < 0.5 else text)
            if rng.random() < 0.8:
                base = list(base)
                base[rng.randrange(len(base))] = rng.choice(words)
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_lose_no_link(spark, monkeypatch, seed):
    monkeypatch.setattr(jaccard, "HEAVY", 4)  # so that the order has heavy tokens in a small table
    rows = near_copies(seed)
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == edge.brute_components(rows)


def test_near_duplicates_find_isolated_containment(spark):
    rng = random.Random(5)
    rows = []
    for g in range(120):
        short = [f"g{g}w{rng.randrange(10 ** 9)}" for _ in range(rng.choice([30, 60, 104, 250]))]
        share = rng.uniform(0.75, 0.85)
        extra = int((len(short) - 4) / share) - (len(short) - 4)
        rows += [" ".join(short), " ".join(short + [f"g{g}x{i}" for i in range(extra)])]
    rows = list(enumerate(rows))
    want = edge.brute_components(rows)
    assert sum(1 for d, _, c in want if d != c) == 120
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_one_of_each_group_stays(spark):
    docs = edge.docs(spark)
    kept = [(r.doc_id, r.text) for r in jaccard.one_of_each(docs).collect()]
    want = edge.brute_components([r[:2] for r in edge.rows()])
    groups = {c for (d, n, c) in want if n}
    with_words = [d for d, t in kept if edge.shingle_set(t)]
    assert Counter(with_words) == Counter(groups)
    assert sum(1 for d, t in kept if not edge.shingle_set(t)) == sum(k for (d, n, c), k in want.items() if not n)


def test_shingles_are_hashes_of_whole_windows(spark):
    import pyarrow as pa

    texts = ["a b c d e f", "A b  c d e", "a b", "", "b a", "a b c d e a b c d e"]
    found = jaccard.sets(pa.array(texts))
    assert [len(s) for s in found] == [len(edge.shingle_set(t)) for t in texts]
    assert found[1][0] in found[0] and not set(found[2]) & set(found[4])


# ---- 1 private data --------------------------------------------------------

PRIVATE = [
    (1, "Write to jo.smith@corp.example.org or JO.SMITH@CORP.EXAMPLE.ORG, call +1 (017) 555-7713 now."),
    (2, "jo.smith@corp.example.org from 10.1.2.3, card 4111 1111 1111 1111 or 4111111111111111."),
    (3, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" and Mrs. Patricia Miller met Mr. Miller; Госпожа Иванова.'),
    (4, "Version 4.0, section 10.2.1, in 1998, see 2.1.3; 12 of 100 words. Nothing private."),
    (5, None), (6, ""), (None, "call 555-123-4567 or 555-123-4567"), (7, "call 555-123-4567 or 555-123-4567"), (7, "call 555-123-4567 or 555-123-4567"),
]


def test_surrogates(spark):
    docs = spark.createDataFrame([(i, t, "x", None if t is None else len(t)) for i, t in PRIVATE],
                                 "doc_id long, text string, kind string, n_chars long")
    out = pii.replace(docs)
    assert out.columns == [*docs.columns, "n_replaced"]
    rows = out.collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in PRIVATE)
    by = {r.doc_id: r for r in rows}
    one, two, three = by[1].text, by[2].text, by[3].text
    for secret in ("smith", "SMITH", "555-7713", "10.1.2.3", "4111", "04dbebab", "Patricia", "Miller", "Иванова", "555-123-4567"):
        assert not any(r.text and secret in r.text for r in rows)
    mail = re.search(r"\S+@\S+(?=[ ,])", one)[0]
    assert mail.upper() in one and mail in two  # coreference within and across texts, case kept
    assert re.search(r"call \+1 \(\d{3}\) \d{3}-\d{4} now\.$", one)
    spaced, plain = re.search(r"card (\d{4} \d{4} \d{4} \d{4}) or (\d{16})\.$", two).groups()
    assert spaced.replace(" ", "") == plain
    digits = [int(c) for c in reversed(plain)]
    assert sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0  # valid as before
    assert re.search(r'token = "[0-9a-f]{40}" and Mrs\. \w+ [\w-]+ met Mr\. [\w-]+; Госпожа [А-Я][а-я]+а\.$', three)
    assert re.search(r"Mrs\. (\w+)", three)[1] in pii.GIVEN["latin", "f"]
    assert by[4].text == PRIVATE[3][1] and by[4].n_replaced == 0
    assert by[5].text is None and by[6].text == ""
    assert len({r.text for r in rows if r.doc_id in (None, 7)}) == 1 and by[7].n_replaced == 2
    assert all(r.text is None or r.n_chars == len(r.text) for r in rows)
    again = {r.doc_id: r.text for r in pii.replace(docs).collect()}
    assert again[1] == one and again[3] == three
    assert {r.doc_id: r.text for r in pii.replace(docs, key="other").collect()}[1] != one


def test_surrogates_stay_distinct(spark):
    # More names than single given and family names can tell apart, so that draws collide.
    names = [(i, f"Mr. {chr(65 + i % 26)}{chr(97 + i // 26)}son") for i in range(60)]
    out = {r.doc_id: r.text for r in pii.replace(spark.createDataFrame(names, "doc_id long, text string")).collect()}
    assert len(set(out.values())) == 60 and not set(out.values()) & {t for _, t in names}


def test_surrogates_empty_and_edges(spark):
    assert pii.replace(edge.empty(spark)).collect() == []
    got = pii.replace(edge.docs(spark)).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(r[:2] for r in edge.rows())


# ---- 5 mixing --------------------------------------------------------------

def brute_mix(rows):
    """Targets by the contract's own words: share by weight, stop at twice the size, share the rest again."""
    n = lambda t: len(edge.WORDS.findall(t or ""))
    size = Counter()
    for _, t, s in rows:
        size[s] += n(t)
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(size.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= 2 * size[s]}
        if not full:
            target.update({s: weight[s] * level for s in open_})
            break
        for s in full:
            target[s] = float(2 * size[s])
            left -= target[s]
        open_ -= full
    key = lambda r: (hashlib.md5(f"{mixing.SEED}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] is not None, r[0] or 0, n(r[1]))
    out = Counter()
    for s in order:
        at = 0
        for d, t, _ in sorted((r for r in rows if r[2] == s), key=key):
            k, most = n(t), int(target[s])
            taken = sum(max(0, min(at + e * size[s] + k, most) - at - e * size[s]) for e in (0, 1))
            out[d, k, size[s], round(target[s], 6), taken] += 1
            at += k
    return out


def test_mix_targets_and_taken(spark):
    rows = [(r[0], r[1], r[3]) for r in edge.rows()]
    got = mixing.mix_digest(edge.docs(spark)).collect()
    assert Counter((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in got) == brute_mix(rows)


def test_mix_order_budget_and_reruns(spark):
    docs = spark.read.parquet(f"{sf_dir('0.001')}/documents.parquet")
    items = sorted(mixing.mix(docs).collect(), key=lambda r: r.mix_start)
    assert all(a.finish <= b.finish and a.mix_start + a.taken == b.mix_start for a, b in zip(items, items[1:]))
    total = sum(len(edge.WORDS.findall(r.text or "")) for r in docs.collect())
    sources = Counter()
    for r in items:
        sources[r.source, r.target] += r.taken
        assert r.taken <= r["size"]
    assert abs(sum(sources.values()) - 1.5 * total) <= len(sources)
    assert all(abs(n - t) < 1 for (_, t), n in sources.items())
    again = mixing.mix(docs.repartition(5)).select("doc_id", "epoch", "taken").collect()
    assert Counter(map(tuple, again)) == Counter((r.doc_id, r.epoch, r.taken) for r in items)


def test_mixed_documents_follow_what_is_taken(spark):
    docs = edge.docs(spark)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    taken, have = Counter(), Counter()
    for r in mixing.mix_digest(docs).collect():
        taken[r.doc_id] += r.taken
    for r in out.collect():
        have[r.doc_id] += len(edge.WORDS.findall(r.text))
    assert {k: v for k, v in taken.items() if v} == {k: v for k, v in have.items() if v}


def test_cut_texts_keep_their_white_space(spark):
    text = " \n".join(f"a{i}" for i in range(40)) + "\t\tend "
    docs = spark.createDataFrame([(1, "x", text), (2, "y", "b b"), (3, "z", "  c\n\nd\te  ")], "doc_id long, source string, text string")
    for r in mixing.mixed_documents(docs).collect():
        whole = next(x["text"] for x in docs.collect() if x["doc_id"] == r.doc_id)
        assert whole.startswith(r.text)
    cut = [r.text for r in mixing.mixed_documents(docs).collect() if r.doc_id == 1]
    assert any(len(t) < len(text) for t in cut)


def test_mix_empty(spark):
    assert mixing.mix_digest(edge.empty(spark)).collect() == []
    assert mixing.mixed_documents(edge.empty(spark)).collect() == []


def test_running_total_of_a_hot_group(spark):
    from pyspark.sql import functions as F

    from tillroll.llm.common import running_total

    df = spark.range(0, 3000, 1, 7).select(F.when(F.col("id") % 3 == 0, F.col("id") % 11).otherwise(99).alias("g"), "id", (F.col("id") % 5).alias("v"))
    got = running_total(df, [F.col("g"), F.col("id")], "v", "before", by="g", partitions=8).collect()
    seen = Counter()
    for r in sorted(got, key=lambda r: (r.g, r.id)):
        assert r.before == seen[r.g]
        seen[r.g] += r.v


# ---- 3 packing -------------------------------------------------------------

def test_packing_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = packing.pack_documents(edge.docs(spark)).collect()
    ids = [(r[0], tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0]) for r in edge.rows()]
    want = Counter()
    for d, x in ids:
        raw = np.array(x, "<u4")
        for i in range(0, len(x), 1024):
            want[d, i, min(1024, len(x) - i), zlib.crc32(raw[i:i + 1024].tobytes()), len(x)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    sequences = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sequences.get(r.sequence_id, 0)
        sequences[r.sequence_id] = r.offset + r.length
    assert max(sequences.values()) <= 1024
    assert packing.pack_documents(edge.empty(spark)).collect() == []


def test_special_strings_have_the_ids_of_the_plain_call(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a<|endoftext|>b", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "<|endoftext", "a <|endoftext|> b\n\n", "<|ENDOFTEXT|>", "<<|endoftext|>>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in packing.pack_documents(docs).collect()}
    for i, t in enumerate(texts):
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [0]
        assert got[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), t
    assert got[0][0] == 4


def test_fill_keeps_every_limit_and_item():
    rng = np.random.default_rng(3)
    sizes = np.column_stack([rng.integers(1, 400, 3000), np.ones(3000, int), rng.integers(0, 200, 3000)])
    limits = np.array([1024, 6, 300])
    bins = packing.fill(sizes, limits)
    assert sorted(i for b in bins for i in b) == list(range(3000))
    assert all((sizes[b].sum(axis=0) <= limits).all() for b in bins)
    least = max(sizes[:, k].sum() / limits[k] for k in range(3))
    assert len(bins) <= 1.1 * least


# ---- 8 language ------------------------------------------------------------

def test_language_held_out_accuracy_and_columns(spark):
    docs = spark.read.parquet(f"{sf_dir('0.01')}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = langid.identify(docs).collect()
    assert len(got) == len(lang)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.95


def test_language_edges(spark):
    got = langid.identify(edge.docs(spark)).collect()
    assert len(got) == len(edge.rows())
    und = Counter(r.doc_id for r in got if r.lang_pred == "und")
    assert und == Counter(d for d, t, *_ in edge.rows() if not any(c.isalpha() for c in t or ""))
    assert langid.identify(edge.empty(spark)).collect() == []
    unlabelled = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in langid.identify(unlabelled).collect()] == [("und", 0.0)]


def test_language_backs_off_from_words_to_shorter_grams():
    model = langid.Model(["x", "y"], {"x": Counter(abc=5), "y": Counter(def_=5)},
                         {"x": Counter({"^abc": 2, "abc": 2, "a": 9}), "y": Counter({"de": 3, "d": 9, "z": 1})}, [0.5, 0.5])
    assert "abc" in model.words
    x, y = model.unseen("abcd")  # knows ^abc
    assert x > y
    x, y = model.unseen("dex")  # only "de"
    assert y > x
    assert (model.unseen("qqq") == 0).all()


# ---- 10 n-gram model -------------------------------------------------------

def brute_kneser(rows, order):
    tokens = [(d, edge.WORDS.findall(edge.lower(t)) + ["</s>"]) for d, t in rows]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, _ in rows]
    train = [w for (_, w), h in zip(tokens, held) if not h]
    c = Counter(x for w in train for x in w)
    total, distinct = sum(c.values()), len(c)
    levels = {order: Counter(tuple((["<s>"] * (order - 1) + w)[i:i + order]) for w in train for i in range(len(w)))}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    discounts, contexts = {}, {}
    for k, g in levels.items():
        discounts[k] = (0.0, *kneser._discounts(Counter(g.values())))
        contexts[k] = {}
        for x, n in g.items():
            z = contexts[k].setdefault(x[:-1], [0, 0.0])
            z[0] += n
            z[1] += discounts[k][min(n, 3)]

    def p(h, w, k):
        if not k:
            return 1 / (distinct + 1)
        lower = p(h[1:], w, k - 1)
        z = contexts[k].get(h)
        if not z:
            return lower
        n = levels[k].get((*h, w), 0)
        return max(n - discounts[k][min(n, 3)], 0) / z[0] + z[1] / z[0] * lower

    out = []
    for (d, w), h in zip(tokens, held):
        padded = ["<s>"] * (order - 1) + w
        out.append((d, h, len(w), sum(c[x] > 0 for x in w), total, sum(math.log10((c[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in w),
                    sum(math.log10(p(tuple(padded[i:i + order - 1]), padded[i + order - 1], order)) for i in range(len(w)))))
    return out


@pytest.mark.parametrize("order", [2, 3])
def test_kneser_ney_against_brute_force(spark, order):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got = sorted((tuple(r)[:7] for r in kneser.perplexities(edge.docs(spark), order).collect()), key=key)
    want = sorted(brute_kneser([r[:2] for r in edge.rows()], order), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [x for g in got for x in g[5:]] == pytest.approx([x for w in want for x in w[5:]], rel=1e-9)


def test_kneser_empty_and_nothing_to_learn(spark):
    assert kneser.perplexities(edge.empty(spark)).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    got = kneser.perplexities(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.score) for r in got] == [(3, 0, 0, 0.0)]


def test_hash_of_packed_keys_is_sparks(spark):
    from pyspark.sql import functions as F

    a, b = np.array([0, 5, -1, 1 << 60]), np.array([7, -9, 3, 2])
    df = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b)], "a long, b long")
    assert [r[0] for r in df.select(F.xxhash64("a", "b")).collect()] == kneser.xxhash64_of_longs(a, b).tolist()
