"""Wrappers around the article, omitted tags, and words that only look like chrome."""

import random
from collections import Counter

import pytest

from churnlake.llm.html_text import RUN, _run_hash, blocks_of, extract, repeated_runs, run_codes

ARTICLE = "<article><h1>Title</h1><p title='a hidden gem'>one</p><p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math></p></article>"


@pytest.mark.parametrize("page", [
    "{}", "<div class='content no-sidebar'>{}</div>", "<div class='has-sidebar'>{}</div>", "<div class='page with-comments'>{}</div>",
    "<body class='has-sidebar'><nav>no</nav>{}<aside>no</aside></body>", "<form action='/x'>no{}</form>",
    "<html><head><title>no</title><body><nav>no</nav>{}", "<head><meta charset=utf-8><title>no</title><div>{}</div>",
    "<div class='topbar'>no <div>{}</div></div>", "<div data-x='hidden or not'>{}</div>"])
def test_article_is_kept(page):
    inside, _, _, marked = blocks_of(page.format(ARTICLE))
    assert marked and inside == ["Title", "one", "so x=2"]


@pytest.mark.parametrize("page", [
    "<aside>{}</aside>", "<div class='related-posts'>{}</div>", "<section id=comments>{}</section>", "<div hidden>{}</div>",
    "<div hidden=''>{}</div>", "<div class=sidebar>{}</div>", "<nav>{}</nav>"])
def test_article_beside_the_text_is_chrome(page):
    inside, outside, chrome, marked = blocks_of(page.format(ARTICLE))
    assert not marked and not inside and not outside and len(chrome) == 3


@pytest.mark.parametrize("start,end", [
    ("<section id='related-work'>", "</section>"), ("<h2 id='how-to-share-files'>", "</h2>"), ("<h2 id='navigation'>", "</h2>"),
    ("<p class='ad-hoc'>", "</p>"), ("<section id='social-history'>", "</section>"), ("<p id='notice-of-meeting'>", "</p>"),
    ("<div class='highlight widget-code'><pre>", "</pre></div>"), ("<section id=discussion>", "</section>")])
def test_names_that_only_contain_a_word_keep_their_text(start, end):
    page = f"<article><h1>Title</h1>{start}kept{end}<p>one</p></article>"
    assert blocks_of(page)[0] == ["Title", "kept", "one"]


@pytest.mark.parametrize("start,end", [
    ("<div class='site-footer'>", "</div>"), ("<div class='ad-slot-2'>", "</div>"), ("<ol class='user-feedback-comments'>", "</ol>"),
    ("<div class='share-buttons'>", "</div>"), ("<section id='comments'>", "</section>"), ("<div class='js-newsletter__signup'>", "</div>"),
    ("<div class='related posts'>", "</div>"), ("<p class='cookie-notice'>", "</p>")])
def test_names_made_of_layout_words_are_chrome(start, end):
    assert blocks_of(f"<article><h1>Title</h1>{start}no{end}<p>one</p></article>")[0] == ["Title", "one"]


def test_blocks_in_doubt_go_if_the_host_repeats_them(spark):
    box = "<div class='share-economy'>read all about it in our great weekly letter for you</div>"
    own = "<section id='related-work'>Others before number {0} have seen what {0} is and wrote it down</section>"
    body = "<nav>Home</nav><article><p>the same words that stand on every page of this host</p>{}</article><footer>Imprint</footer>"
    rows = [(n, f"https://a.example/{n}", body.format(box + own.format(n))) for n in range(4)]
    rows += [(9, "https://b.example/9", body.format(box + own.format(9)))]
    rows += [(10 + n, f"https://c.example/{n}", body.format(box)) for n in range(4)]  # one page and three mirrors of it
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for group in (1, 1_000):
        found = {r.page_id: r.text.split("\n") for r in extract(pages, group=group).collect()}
        for n in range(4):
            assert found[n] == ["the same words that stand on every page of this host",
                                f"Others before number {n} have seen what {n} is and wrote it down"]
        assert len(found[9]) == 3
        assert all(len(found[10 + n]) == 2 for n in range(4))


def test_run_counts_of_the_suffix_array_against_counting():
    rng = random.Random(3)
    phrases = [" ".join(rng.choices("abcd", k=rng.randint(1, 15))) for _ in range(8)]
    for _ in range(30):
        streams = ["\n".join(rng.choices(phrases, k=rng.randint(0, 6))) for _ in range(rng.randint(1, 12))]
        expected = Counter()
        for words in map(str.split, streams):
            expected.update({" ".join(words[i:i + RUN]) for i in range(len(words) - RUN + 1)})
        runs, pages = repeated_runs(streams)
        by_hash = {int(_run_hash(run_codes([run])[0], RUN)[0]): n for run, n in expected.items()}
        assert dict(zip(runs.tolist(), pages.tolist())) == by_hash
