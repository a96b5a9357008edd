"""Main text whatever wraps it, and pages of hostile depth."""

from __future__ import annotations

import time

import pytest

from tillroll.llm import mincut

LONG = [f"Paragraph {k} tells at some length what happened on that day in the town, who was there and why it mattered to them. " * 2 for k in range(5)]
TEXT = [" ".join(p.split()) for p in LONG]
BODY = "".join(f"<p>{p}</p>" for p in LONG)
NAV = "<nav><a href=a>Home</a> <a href=b>News</a></nav>"
FOOT = "<footer><p>All rights reserved.</p></footer>"


@pytest.mark.parametrize("page", [
    f"<body>{NAV}<form id=aspnet><article>{BODY}</article></form>{FOOT}</body>",
    f"<body>{NAV}<fieldset><article>{BODY}</article></fieldset>{FOOT}</body>",
    f"<body>{NAV}<article><div role=note>{BODY}</div></article>{FOOT}</body>",
    f'<body>{NAV}<div class="page has-sidebar">{BODY}</div>{FOOT}</body>',
    f'<body>{NAV}<div class="no-banner layout">{BODY}</div>{FOOT}</body>',
    f'<body>{NAV}<div class="header-fixed">{BODY}</div>{FOOT}</body>',
    f'<body>{NAV}<div id="share-page">{BODY}</div>{FOOT}</body>',
    f'<body>{NAV}<form action=x><div class="has-sidebar"><div>{BODY}</div><div class=sidebar><p>Buy now and save.</p></div></div></form>{FOOT}</body>',
])
def test_wrappers_do_not_silence_the_article(page):
    assert mincut.main_text(page).split("\n\n") == TEXT


@pytest.mark.parametrize("extra", [
    "<form><p>Sign up for our letter and never miss a story again.</p></form>",
    "<div class=comments>" + "".join(f"<p>Reader {k} thinks that this is all quite wrong and says so at great length, again and again. " * 3 + "</p>" for k in range(30)) + "</div>",
    "<div class=newsletter><p>Subscribe to our letter today, it is free and comes every week to your box.</p></div>",
    "<fieldset><p>Choose your region to go on reading in your language.</p></fieldset>",
])
def test_what_stands_beside_the_article_stays_out(extra):
    for page in (f"<body>{NAV}<article>{BODY}{extra}</article>{FOOT}</body>", f"<body>{NAV}<div class=wrap><div>{BODY}</div>{extra}</div>{FOOT}</body>"):
        assert mincut.main_text(page).split("\n\n") == TEXT


def test_deep_pages_take_time_in_proportion():
    for hostile in ("<div>" * 50_000 + BODY, "<div>x" * 20_000, "<b>" * 50_000 + BODY, "<div>" * 20_000 + "</p></li></span>" * 20_000 + BODY):
        start = time.perf_counter()
        text = mincut.main_text(f"<body>{hostile}</body>")
        assert time.perf_counter() - start < 5
        assert BODY not in hostile or all(p in text for p in TEXT)
