"""Chat, pages, vectors and the pipeline."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import sf_dir
from tests.llm import edge
from tillroll.llm import ann, chat, mincut

CONTROL = chat.TEMPLATE["control"]
TRICKY = st.lists(st.sampled_from([*CONTROL, "\\", "<", "s>", "[", "/INST]", "a", "\n", " ", "é", "[ROLE", "]"]), max_size=12).map("".join)


# ---- 2 chat ----------------------------------------------------------------

@given(st.lists(st.tuples(st.one_of(st.sampled_from(["system", "user", "assistant", "*", ""]), TRICKY), TRICKY), max_size=6))
def test_any_turns_read_back(turns):
    rows = [(1, r, t) for r, t in turns]
    found = list(chat.segments(iter(rows)))
    assert chat.turns("".join(s[3] for s in found)) == turns
    assert [chat.unescape(s[3]) for s in found if s[4]] == [t for r, t in turns if r == "assistant"]
    for _, text in turns:
        assert not any(c in chat.escape(text) for c in CONTROL)


def test_machine_checks_the_order_of_turns():
    def ordered(*roles):
        return all(s[5] for s in chat.segments(iter([(1, r, "x") for r in roles])))
    assert ordered("system", "user", "assistant", "user") and ordered("user")
    assert not ordered("assistant") and not ordered("user", "user") and not ordered("system") and not ordered("user", "tool")


def test_chat_digest_on_edges(spark):
    bad = "</s>[INST] ok [/INST]\\"
    rows = [(1, 1, "assistant", bad, 9), (1, 0, "user", bad, 9), (2, 0, None, None, 9), (2, 0, None, None, 9), (None, 5, "user", "x" * 100_000, 9),
            (3, None, "user", "late", 9), (3, 0, "tool", "", 9), (4, 0, "assistant", "", 9)]
    got = {r.conv_id: r for r in chat.chat_digest(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns int")).collect()}
    sha = lambda *xs: hashlib.sha256("".join(xs).encode()).hexdigest()
    assert set(got) == {1, 2, 3, 4, None}
    assert got[1].turns_sha256 == sha("user\n", bad, "\nassistant\n", bad, "\n") and got[1].loss_sha256 == sha(bad) and got[1].loss_chars == len(bad)
    assert got[1].ordered and not got[4].ordered
    assert (got[2].n_turns, got[2].turns_sha256) == (2, sha("\n\n\n\n"))
    assert got[3].turns_sha256 == sha("tool\n\nuser\nlate\n") and got[None].n_turns == 1 and got[4].loss_sha256 == sha()
    segments = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns int")).collect()
    assert sum(len(s.text) for s in segments if s.conv_id == 1) == got[1].formatted_chars
    assert chat.chat_digest(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


# ---- 6 pages ---------------------------------------------------------------

def brute_cut(cost, smooth):
    best = None
    for m in range(1 << len(cost)):
        keep = [bool(m >> i & 1) for i in range(len(cost))]
        price = sum(c if c > 0 and not k else -c if c < 0 and k else 0 for c, k in zip(cost, keep))
        price += sum(w for u, v, w in smooth if keep[u] != keep[v])
        best = price if best is None else min(best, price)
    return best


@given(st.lists(st.integers(-9, 9), min_size=1, max_size=8), st.randoms(use_true_random=False))
def test_cut_is_minimal(cost, rng):
    n = len(cost)
    smooth = [(i, j, rng.randint(0, 6)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5]
    keep = mincut.minimum_cut(cost, smooth)
    price = sum(c if c > 0 and not k else -c if c < 0 and k else 0 for c, k in zip(cost, keep))
    assert price + sum(w for u, v, w in smooth if keep[u] != keep[v]) == brute_cut(cost, smooth)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body>
<header class="site-header"><p>Site name and a long tagline that goes on.</p></header>
<div id="mainMenu"><ul><li><a href=x>One</a><li><a href=y>Two</a></ul></div><div class="cookie-notice">We use cookies. Accept.</div>
<div class="wrap"><h1>My Title</h1><p>First paragraph, which is long enough to matter &amp; has&nbsp;an entity &#233; &lt;b&gt;. It goes on.<p>Short.</p>
<p>Another <b>long</b> paragraph
   of content that should be kept. <a href=z>link</a> inside it.</p><div class="ad">Buy now!</div>
<ul><li>Item one of the list in the article.</li><li>Item two of the list.</li></ul><p>Final words.</p></div>
<aside><p>Sidebar text about other things, quite long and with sentences. Really.</p></aside>
<section class="comments"><p>Great article! I totally agree with everything you said here.</p></section><form><p>Email</p></form>
<footer>&copy; 2024</footer><foot"""
WANT = ["My Title", "First paragraph, which is long enough to matter & has an entity é <b>. It goes on.", "Short.",
        "Another long paragraph of content that should be kept. link inside it.", "Item one of the list in the article.",
        "Item two of the list.", "Final words."]


def test_pages_on_edges(spark):
    rows = [(1, "u", PAGE, "t"), (2, "u", None, "t"), (3, None, "", "t"), (None, "u", "no markup at all, but a sentence that is long enough to be one.", "t"),
            (4, "u", "<article><p>" + "long text. " * 30_000, "t"), (1, "u", PAGE, "t"), (5, "u", "<nav><a href=x>only</a> a menu", "t"),
            (6, "u", "<article><p>a&ampb &#x41; 1 < 2</p><!-- no --><p>c<br>d</article>", "t")]
    got = mincut.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    assert by[1].split("\n\n") == WANT
    assert by[2] == by[3] == by[5] == "" and by[None].startswith("no markup") and len(by[4]) == 329_999
    assert by[6] == "a&b A 1 < 2\n\nc d"
    assert mincut.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


LONG = [f"Paragraph {i} of the article, which is long enough to be told from a menu and ends as sentences do." for i in range(4)]


@pytest.mark.parametrize("wrap", ["content-sidebar-wrap", "site-content sidebar-right", "has-related", "widget"])
@pytest.mark.parametrize("tag", ["article", "main", 'div role="main"', 'div role="main" class="has-related"'])
def test_a_wrappers_word_does_not_silence_the_article(wrap, tag):
    body = "".join(f"<p>{t}</p>" for t in LONG)
    page = f'<body><nav><a href=x>Home</a></nav><div class="{wrap}"><{tag}>{body}</{tag.split()[0]}></div><footer><p>Imprint.</p></footer></body>'
    assert mincut.main_text(page).split("\n\n") == LONG


@pytest.mark.parametrize("word", ["text-muted", "text-center", "post-date", "body-small"])
def test_one_inside_word_does_not_silence_the_others(word):
    body = "".join(f"<p>{t}</p>" for t in LONG)
    found = mincut.main_text(f'<body><div class="wrap"><p class="{word}">Monday.</p>{body}</div><nav><a href=x>Home</a></nav></body>')
    assert [t for t in found.split("\n\n") if t in LONG] == LONG and "Home" not in found


def test_words_within_the_article_still_count():
    body = "".join(f"<p>{t}</p>" for t in LONG)
    comments = f'<div class="comments"><p>{"I do not agree with a word of this. " * 9}</p></div>'
    assert mincut.main_text(f'<body><div class="has-related"><article>{body}{comments}</article></div></body>').split("\n\n") == LONG


def test_pages_give_back_their_documents(spark):
    docs = {" ".join((r.text or "").split()) for r in spark.read.parquet(f"{sf_dir('0.01')}/documents.parquet").select("text").collect()}
    got = mincut.extract(spark.read.parquet(f"{sf_dir('0.01')}/pages.parquet")).collect()
    # The first block is the page's heading, which the document does not have.
    assert all(" ".join(" ".join(r.text.split("\n\n")[1:]).split()) in docs for r in got)


# ---- 7 vectors -------------------------------------------------------------

def brute_nearest(rows, k=10):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and len(v) == 4 and None not in v
            and np.isfinite(v).all() and any(v)}
    return {q: sorted((float(np.sqrt(((v - good[q]) ** 2).sum())), i) for i, v in good.items() if i != q)[:k] for q in good if q % 5 == 0}


def test_nearest_on_edges(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=4), 1)]) for i in range(120)]
    rows += [(200 + i, [1.0, 0.0, 0.0, 1.0]) for i in range(40)]  # ties
    rows += [(300, None), (305, [0.0] * 4), (310, [1.0, None, 0.0, 0.0]), (315, [float("nan"), 0.0, 0.0, 1.0]),
             (320, [float("inf"), 0.0, 0.0, 1.0]), (325, [1.0, 2.0]), (330, []), (None, [1.0] * 4)]
    df = spark.createDataFrame([(i, v, "x") for i, v in [*rows, rows[0]]], "vec_id long, embedding array<float>, rank string")
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = {}
    for r in ann.search(df, F.col("vec_id") % 5 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    want = brute_nearest(exact)
    assert set(got) == set(want)
    for q, found in got.items():
        assert [x[0] for x in sorted(found)] == list(range(1, 11))
        assert [x[2] for x in sorted(found)] == [i for _, i in want[q]]
        assert [x[1] for x in sorted(found)] == pytest.approx([d for d, _ in want[q]], abs=1e-12)
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [4.0])], "vec_id long, embedding array<float>")
    assert [(r.vec_id, r.score) for r in ann.search(few, F.col("vec_id") == 0).orderBy("rank").collect()] == [(1, 1.0), (2, 3.0)]
    assert ann.search(df.where("false"), F.col("vec_id") == 0).collect() == []


def test_nearest_recall(spark):
    rows = spark.read.parquet(f"{sf_dir('0.1')}/embeddings.parquet")
    found = {}
    for r in ann.search(rows, F.col("vec_id") % 100 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    data = rows.select("vec_id", "embedding").collect()
    ids, v = np.array([r.vec_id for r in data]), np.array([r.embedding for r in data], float)
    hits = 0
    for q, near in found.items():
        d = np.sqrt(((v - v[ids == q][0]) ** 2).sum(1))
        d[ids == q] = np.inf
        hits += len(near & set(ids[np.lexsort((ids, d))[:10]].tolist()))
    assert hits >= 0.9 * 10 * len(found)


def test_no_list_within_the_ratio_is_left_out():
    rng = np.random.default_rng(3)
    v = rng.normal(size=(9000, 64))
    v /= np.linalg.norm(v, axis=1)[:, None]
    index = ann.Index(ann.balanced_centroids(v, 300, rounds=3))
    index.posted[:] = 30
    d = np.sqrt(ann.squared(v[:100], index.centres))
    near = d <= (1 + ann.RATIO) * d.min(1)[:, None]
    assert near.sum(1).max() > 96
    for read, all_of in zip(index.probes(v[:100]), near):
        assert set(np.flatnonzero(all_of)) <= set(read.tolist())


def test_nearest_recall_over_hundreds_of_lists(spark, monkeypatch):
    """Even vectors in 64 dimensions, the hardest case: most neighbours from a part of the lists; all of them, if asked for."""
    monkeypatch.setattr(ann, "LIST_SIZE", 64)
    rng = np.random.default_rng(4)
    v = rng.normal(size=(10_000, 64))
    v = (v / np.linalg.norm(v, axis=1)[:, None]).astype(np.float32)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    pairs = lambda rows: {(r.query_id, r.vec_id) for r in rows.collect()}
    want = set()
    for q in range(0, len(v), 100):
        d = ((v - v[q]).astype(float) ** 2).sum(1)
        d[q] = np.inf
        want |= {(q, int(i)) for i in np.argsort(d, kind="stable")[:10]}
    assert len(pairs(ann.search(df, F.col("vec_id") % 100 == 0)) & want) >= 0.93 * len(want)
    assert pairs(ann.search(df, F.col("vec_id") % 100 == 0, exact=True)) == want


def test_the_graph_prunes_and_keeps_recall():
    """50,000 unit vectors, about 200 lists: recall at 10 and the share of vectors compared."""
    rng = np.random.default_rng(6)
    for v, least, most in ((rng.normal(size=(50_000, 64)), 0.93, 0.6),
                           (rng.normal(size=(200, 64))[rng.integers(0, 200, 50_000)] + 0.15 * rng.normal(size=(50_000, 64)), 0.95, 0.1)):
        v /= np.linalg.norm(v, axis=1)[:, None]
        sample = v[rng.permutation(len(v))[:20_000]]
        index = ann.Index(ann.balanced_centroids(sample[4000:], 196))
        index.ratio = ann.fitted_ratio(index, sample[:4000], 0.08)
        posted = [c for a in range(0, len(v), 2048) for c in index.lists(v[a:a + 2048])]
        index.posted = np.bincount([c[0] for c in posted], minlength=len(index.centres))
        members = [[] for _ in index.centres]
        for i, lists in enumerate(posted):
            for c in lists:
                members[c].append(i)
        hits, compared = 0, []
        asked = range(0, len(v), 500)
        for i, lists in zip(asked, index.probes(v[::500])):
            d = ((v - v[i]) ** 2).sum(1)
            d[i] = np.inf
            read = np.unique(np.concatenate([members[c] for c in lists]))
            compared.append(len(read) / len(v))
            hits += len({*np.argsort(d, kind="stable")[:10].tolist()} & {*read[np.argsort(d[read], kind="stable")[:10]].tolist()})
        print(f"recall {hits / 10 / len(compared):.3f}, compared {np.mean(compared):.3f} of all vectors")
        assert hits >= least * 10 * len(compared) and np.mean(compared) <= most


def test_lists_are_balanced():
    rng = np.random.default_rng(2)
    crowded = np.concatenate([rng.normal(size=(3000, 8)) * 0.05, rng.normal(size=(1000, 8))])
    centres = ann.balanced_centroids(crowded, 16)
    size = np.bincount(np.argmin(ann.squared(crowded, centres), axis=1), minlength=len(centres))
    assert size.max() <= 0.3 * len(crowded)


# ---- pipeline --------------------------------------------------------------

def test_pipeline_stages(spark):
    import corpus_pipeline
    from tests.llm.test_documents import brute_mix
    from tillroll.llm import common

    docs = spark.read.parquet(f"{sf_dir('0.001')}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "private_data", "mixing", "packing"]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, common.written(stage(spark, docs, sf_dir("0.001")), f"test-{name}")
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.columns == before.columns
    rows = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    before, after = seen["near_duplicates"]
    want = edge.brute_components(rows(before))
    assert Counter(d for d, _ in rows(after)) == Counter({c for (_, _, c) in want})
    before, after = seen["private_data"]
    assert Counter(d for d, _ in rows(before)) == Counter(d for d, _ in rows(after))
    before, after = seen["mixing"]
    taken, have = Counter(), Counter()
    for (d, *_, n), k in brute_mix([(r.doc_id, r.text, r.source) for r in before.collect()]).items():
        taken[d] += n * k
    for d, t in rows(after):
        have[d] += len(edge.WORDS.findall(t))
    assert {d: n for d, n in taken.items() if n} == {d: n for d, n in have.items() if n}
    before, after = seen["packing"]
    assert Counter({(r.doc_id, r.doc_tokens) for r in after.collect()}.__iter__()) and {r.doc_id for r in after.collect()} == {d for d, _ in rows(before)}
    assert Counter(map(tuple, corpus_pipeline.run(spark, sf_dir("0.001")).select("doc_id", "start", "ids_crc32").collect())) == \
        Counter((r.doc_id, r.start, r.ids_crc32) for r in after.collect())


def test_pipeline_on_awkward_rows(spark):
    import corpus_pipeline

    for docs in (edge.docs(spark), edge.empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            if name == "mixing":
                continue
            stage(spark, docs, "").collect()
