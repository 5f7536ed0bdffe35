from __future__ import annotations

import html
import random
import re
from collections import defaultdict

import pytest
from llm.llm_helpers import CLASHING, kept_columns

from tidegauge.llm import boilerplate, markup, queries


def article_of(page):
    """The article of the test tables' pages, by their own few elements."""
    found = re.search(r"<article>(.*?)(</article>|$)", page, re.DOTALL)
    text = re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br|article)>", " ", found.group(1)))
    return " ".join(html.unescape(text).split())


def text_of(page):
    return " ".join(w for b in markup.visible_blocks(page) for w in b.words)


def test_query_gives_whole_articles(spark, sf_dir):
    given = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    result = queries.queries()["op12_main_text"](spark, sf_dir)
    assert result.columns == ["page_id", "url", "text", "n_chars"]
    found = result.collect()
    assert len(found) == len(given)
    for r in found:
        wanted = article_of(given[r.page_id].html)
        assert (r.url, r.text, r.n_chars) == (given[r.page_id].url, wanted, len(wanted))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain text &amp; no markup", "plain text & no markup"),
        ("<p>a<b>b</b>c<br>d<p>e\n\t f&nbsp;g", "abc d e f g"),
        ("1 < 2 and <3 <p>x", "1 < 2 and <3 x"),
        ("a<!-- <p>no</p> -->b<!doctype html><?x y?>c", "abc"),
        ("a<!-- never ends <p>b", "a"),
        ("a<script>if (x < 1) '</p>'</script>b<STYLE>p{}</STYLE >c<script>open", "abc"),
        ("<title>t</title><p>&#233;&eacute;&#x1F642;&am &lt;p&gt;", "éé🙂&am <p>"),
        ('<p title="a > b">x</p><p title=\'"\'>y', "x y"),
        ("<nav>m</nav><header>h<h1>site</h1></header><footer>f</footer><aside>s</aside><p>x", "x"),
        ("<form>f<input><button>go</button></form><p>x<select><option>1</select>", "x"),
        ('<div class="cookie-notice">c</div><div id="sideBar">s</div><div class="adsbygoogle">a</div>x', "x"),
        ('<div class="comments"><article>c</article></div><div class="has-sidebar">x</div>', "x"),
        ('<div role="navigation">n</div><div hidden>h</div><p style="display: none">d</p>x', "x"),
        ("<ul class='menu'><li>1<li>2</ul><ul><li>x<li>y</ul>", "x y"),
        ("<p class=ad>one<p>x<p class=ad>two<div>y", "x y"),
        ("<form><article><header><h1>t</h1></header>x<footer>f</footer><article>c</article></article></form>", "t x"),
        ("<article>x</div></section></b>y<aside>s</aside>z", "xy z"),
        ("<table><tr><td>a<td>b<tr class=promo><td>p<tr><td>c</table>", "a b c"),
        ("<a href='x", ""),
        ("x<foo-bar>y</foo-bar><p/>z", "xy z"),
    ],
)
def test_blocks(page, text):
    assert text_of(page) == text


def test_what_says_most_is_taken(spark):
    pages = [
        (1, "<p>a</p><main><p>b</p><article>c</article></main>"),
        (2, "<p>a</p><main><p>b</p></main>"),
        (3, "<p>a</p><main> <p> </p></main>"),
    ]
    df = spark.createDataFrame(pages, "page_id int, html string").selectExpr("*", "null as url")
    assert [r.text for r in boilerplate.main_text(df).orderBy("page_id").collect()] == ["c", "b", "a"]


def brute_force(pages):
    """Texts by counting every stretch of tokens in all distinct streams of a host."""
    chosen = [(h, *boilerplate._chosen(p)) for h, p in pages]
    held = defaultdict(set)
    for host, _, blocks in chosen:
        if blocks:
            held[host].add(tuple(boilerplate._tokens(blocks)))
    run = boilerplate.RUN
    counts = defaultdict(int)
    for host, streams in held.items():
        for s in streams:
            for w in {s[k : k + run] for k in range(len(s) - run + 1)}:
                counts[host, w] += 1
    out = []
    for host, is_article, blocks in chosen:
        tokens, total = boilerplate._tokens(blocks), len(held[host])
        gone, hits = [False] * len(tokens), [False] * len(tokens)
        for k in range(len(tokens) - run + 1):
            n = counts[host, tuple(tokens[k : k + run])]
            often = n >= 0.9 * total and total >= 10 if is_article else total >= 3
            hits[k] = n > 0.5 * total and often
            if hits[k]:
                gone[k : k + run] = [True] * run
        text, at = [], 0
        for b in blocks:
            end = at + 1 + len(b.words)
            own = [False] * (end - at)
            for k in range(at, end - run + 1):
                if hits[k]:
                    own[k - at : k - at + run] = [True] * run
            if not all(gone[at + 1 : end]):
                text += [w for w, g in zip(b.words, own[1:]) if is_article or not g]
            at = end
        out.append(" ".join(text))
    return out


def made_pages(seed, hosts=(40, 12, 4, 3, 2, 1)):
    """Pages in hosts of so many, most with a template and some with copied articles."""
    pick = random.Random(seed)

    def some(n):
        return " ".join(pick.choice("abcdefgh") + str(pick.randrange(60)) for _ in range(n))

    pages = []
    for number, size in enumerate(hosts):
        top, low, notice = some(7), some(3), some(9)
        articles = [f"<h1>{some(4)}</h1><p>{some(30)}</p><p>{some(5)}</p>" for _ in range(size)]
        for k in range(size):
            text = articles[pick.randrange(size)] if pick.random() < 0.4 else articles[k]
            kind = number % 2
            body = f"<article>{text}<p class=x>{notice}</p></article>" if kind else f"<div>{text}</div>"
            pages.append((f"http://h{number}.org/{k}", f"<div class=t>{top} {k}</div>{body}<p class=l>{low}</p><p>{some(2)}"))
    return pages


@pytest.mark.parametrize("slice_bytes", [300, 2000, 4 << 20])
def test_templates_equal_brute_force(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(boilerplate, "SLICE_BYTES", slice_bytes)
    pages = [*made_pages(1), *made_pages(2, (30, 11)), (None, "<p>x"), ("no url", None), (None, "")]
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(pages)], "page_id int, url string, html string")
    found = boilerplate.main_text(df.repartition(5)).orderBy("page_id").collect()
    hosts = [(re.match("http://(h[0-9]+)", u or "") or [""])[0] for u, _ in pages]
    wanted = brute_force(list(zip(hosts, (p for _, p in pages))))
    assert [r.text for r in found] == wanted
    # Some of the words went.
    assert any(p and len(w.split()) < len(text_of(p).split()) for w, (_, p) in zip(wanted, pages))


def test_a_template_without_markup_goes(spark):
    pages = [(k, f"https://h.org/{k}", f"<div>Read our news every day of the year</div><div>Story {k} of {k * 7} cats</div>") for k in range(9)]
    # Copies of a page are no sign of a template.
    pages += [(9 + k, f"https://h.org/copy{k}", pages[0][2]) for k in range(30)]
    df = spark.createDataFrame(pages, "page_id int, url string, html string")
    found = {r.page_id: r.text for r in boilerplate.main_text(df).collect()}
    assert [found[k] for k in range(9)] == [f"Story {k} of {k * 7} cats" for k in range(9)]
    assert {found[9 + k] for k in range(30)} == {found[0]}


def test_odd_pages(spark, odd):
    given = odd.selectExpr("doc_id as page_id", "text as html", "null as url", *CLASHING)
    given = given.selectExpr("*", "'h' as host", "1 as pieces", "2 as marks", "'t' as TEXT", "'g' as given", "'p' as page")
    result = boilerplate.main_text(given)
    assert result.columns == [c if c != "TEXT" else "text" for c in given.columns]
    kept_columns(result, given)
    assert {r.given + r.page + r.host for r in result.collect()} == {"gph"}
    # Five or more of these texts make a host of their own, but have no stretch in common.
    for r in result.collect():
        assert r.text == text_of(r.html or "")


def test_no_pages(spark):
    df = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert boilerplate.main_text(df).collect() == []
    assert boilerplate.main_text(df).columns == ["page_id", "url", "html", "text"]
