"""HTML extraction: parsing, tree matching, induced wrappers."""

from __future__ import annotations

from functools import lru_cache

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.llm import op8_html as H

PAGE = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])


def text_of(html):
    return H.main_text(html, None)


def test_article_without_what_stands_around_it():
    html = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href=x>Menu</a><li>More</ul></nav><!-- <p>no</p> -->
    <div class="ad">Buy</div><article><header><h1>Title  of\n it</h1></header><p><b>First &amp; best.<br><p>Second &lt;x&gt;
    <script>track()</script>end</p><div class="comments"><p>Nice!</p></div><aside>Side</aside><form>Mail <input></form>
    <ul><li>one<li>two</ul><p hidden>gone</p><p style="display: none">gone</p></article>
    <div id="sidebar">S</div><div role="contentinfo">c</div><footer>&copy; me</footer></body></html>"""
    assert text_of(html) == "Title of it\n\nFirst & best.\n\nSecond <x> end\n\none\n\ntwo"


def test_hard_markup():
    assert text_of(None) == "" and text_of("") == "" and text_of("   ") == ""
    assert text_of("plain text") == "plain text"
    assert text_of("<p>a<p>b</div></p>c") == "a\n\nb\n\nc"
    assert text_of("<article><p>cut off &am") == "cut off &am"
    assert text_of("<p>1 < 2 &nbsp; &#65;&#x42;") == "1 < 2 AB"
    assert text_of("<div title='a > b'>x</div><script>never closed <p>y") == "x"
    assert text_of("<table><tr><td>a<td>b<tr><td>c</table>") == "a\n\nb\n\nc"
    assert text_of("<main>" + "<div>" * 300 + "deep") == "deep"


TREES = st.recursive(st.sampled_from("abc").map(lambda s: (s, ())), lambda c: st.tuples(st.sampled_from("abc"), st.lists(c, max_size=3).map(tuple)),
                     max_leaves=7)


def node(t, path=()):
    n = H.Node((*path, t[0]))
    n.children = [node(c, n.path) for c in t[1]]
    return n


@lru_cache(maxsize=None)
def plain_matching(a, b):
    """The textbook recursion over the last children."""
    if a[0] != b[0]:
        return 0

    @lru_cache(maxsize=None)
    def best(i, j):
        if not i or not j:
            return 0
        return max(best(i - 1, j), best(i, j - 1), best(i - 1, j - 1) + plain_matching(a[1][i - 1], b[1][j - 1]))

    return best(len(a[1]), len(b[1])) + 1


@given(TREES, TREES)
def test_simple_tree_matching(a, b):
    size, pairs = H.simple_tree_matching(node(a), node(b))
    assert size == plain_matching(a, b)
    # each pair joins equal signatures at equal depth
    assert all(p[-1] == q[-1] and len(p) == len(q) for p, q in pairs)


def site(host, n, words, extra=""):
    rows = []
    for i in range(n):
        body = "".join(f"<p>{words.text(15)}</p>" for _ in range(3))
        rows.append((i, f"https://{host}/p/{i}", f"""<html><body><div class="top"><span>{host} daily</span><div>Breaking: none</div></div>
            <div class="wrap"><div class="body"><h2>{words.text(4)}</h2>{body}<div class="buttons2">Send to a friend</div></div></div>
            {extra}<div class="end">All rights reserved by {host}</div></body></html>"""))
    return rows


def test_wrapper_finds_the_region_of_a_site_without_semantic_tags(spark, words):
    rows = site("a.example", 30, words) + [(500 + i, u, h) for i, (_, u, h) in enumerate(site("small.example", 2, words))]
    out = {r.page_id: r for r in H.extract(spark.createDataFrame(rows, PAGE)).collect()}
    for page_id, _, html in rows[:30]:
        want = [b[1] for b in H.Page(html).blocks if "div.body" in b[0] and "div.buttons_" not in b[0]]
        assert out[page_id].text == "\n\n".join(want) and len(want) == 4
        assert out[page_id].n_chars == len(out[page_id].text)
    assert "small.example daily" in out[500].text  # two pages are no wrapper


def test_joined_wrappers_give_the_same(spark, words, monkeypatch):
    rows = site("a.example", 25, words) + [(900, None, "<p>x"), (901, "no url", "<p>y")]
    df = spark.createDataFrame(rows, PAGE)
    want = sorted((r.page_id, r.text) for r in H.extract(df).collect())
    monkeypatch.setattr(H, "BROADCAST_CHARS", 1)
    assert sorted((r.page_id, r.text) for r in H.extract(df).collect()) == want


def test_nulls_repeats_empty_tables_and_clashing_columns(spark, words):
    rows = [(1, None, None), (1, None, None), (None, "https://h.example/", "<p>x</p>"), (2, "https://h.example/", ""),
            (3, "https://h.example/", "<article><p>" + words.text(20_000) + "</article>")]
    df = spark.createDataFrame(rows, PAGE).withColumn("host", F.lit(1)).withColumn("wrapper", F.lit("{")).withColumn("text", F.lit("t"))
    out = H.extract(df).collect()
    assert sorted([(r.page_id, r.url, r.n_chars) for r in out], key=str) == sorted(
        [(1, None, 0), (1, None, 0), (None, "https://h.example/", 1), (2, "https://h.example/", 0), (3, "https://h.example/", len(rows[4][2]) - 22)], key=str)
    assert H.extract(spark.createDataFrame([], PAGE)).count() == 0


def test_whole_table_against_a_plain_reading(spark):
    """The test pages hold their main text in one article of headline and paragraphs."""
    import html as entities
    import re

    from zonecast.llm.frames import read

    pages = read(spark, "/root/testdata/sf0.01", "pages")
    out = {r.page_id: r.text for r in H.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        blocks = [" ".join(entities.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert out[r.page_id] == "\n\n".join(b for b in blocks if b)


def texts(spark, rows):
    return {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, PAGE)).collect()}


def on(host, bodies, start=0):
    return [(start + i, f"https://{host}/{i}", f"<html><body><div class=top>{host} daily</div>{b}<div class=end>All by {host}</div></body></html>")
            for i, b in enumerate(bodies)]


def test_template_is_a_text_on_most_distinct_pages_not_a_slot(spark, words):
    def article(h2=None):
        h1, h2, p = words.text(6), h2 or words.text(2), [words.text(20) for _ in range(3)]
        li = ["red", "green", "blue"][words.pick(3)]
        return (f"<article><h1>{h1}</h1><h2>{h2}</h2>" + "".join(f"<p>{x}</p>" for x in p) + f"<ul><li>{li}</li></ul></article>",
                "\n\n".join([h1, h2, *p, li]))

    heads = ["Background", "Results", "In short", "What comes next"]
    pages = [article(heads[i % 4]) for i in range(60)]
    copy = article()
    pages += [copy] * 2000
    junk = "<article><h1>Junk</h1>" + "<p>Buy now</p>" * 3000 + "</article>"
    pages.append((junk, "\n\n".join(["Junk"] + ["Buy now"] * 3000)))
    # one article under changing headlines
    body = [words.text(30) for _ in range(4)]
    near = [(f"<article><h1>{h}</h1>" + "".join(f"<p>{x}</p>" for x in body) + "</article>", "\n\n".join([h, *body]))
            for h in (words.text(5) for _ in range(40))]
    # a notice in every article is template, beside paragraphs of the same slot that are not
    own = [words.text(25) for _ in range(30)]
    rows = on("hot.example", [h for h, _ in pages]) + on("near.example", [h for h, _ in near], 10_000) + on(
        "notice.example", [f"<article><p>{t}</p><p>Mail to a friend</p></article>" for t in own], 20_000)
    got = texts(spark, rows)
    assert got == dict(enumerate(t for _, t in pages)) | dict(enumerate((t for _, t in near), 10_000)) | dict(enumerate(own, 20_000))


def test_article_is_never_narrowed_and_a_headline_beside_the_region_stays(spark, words):
    def page(i, tag):
        h1, lead, side = words.text(5), words.text(12), words.text(10)
        p = [words.text(30) for _ in range(400 if i == 7 else 4)]
        return (f"<{tag}><h1>{h1}</h1><p>{lead}</p><div class=content>" + "".join(f"<p>{x}</p>" for x in p) +
                f"</div><section><p>{side}</p></section></{tag}>", "\n\n".join([h1, lead, *p, side]))

    few, many, plain = ([page(i, tag) for i in range(n)] for tag, n in (("article", 3), ("article", 30), ("div", 30)))
    got = texts(spark, on("few.example", [h for h, _ in few]) + on("many.example", [h for h, _ in many], 100)
                + on("plain.example", [h for h, _ in plain], 200))
    for start, pages in ((0, few), (100, many), (200, plain)):
        assert {i: t for i, t in got.items() if start <= i < start + 100} == dict(enumerate((t for _, t in pages), start))


def test_one_long_page_does_not_choose_the_region(words):
    body, side = ("html", "body", "div.body"), ("html", "body", "div.log")
    rows = [[(body, words.text(200))] for _ in range(30)] + [[(side, words.text(50_000))]]
    stats = {}
    for blocks in rows:
        page = H.Page("".join(f"<{p[-1].replace('.', ' class=')}><p>{t}</p></div>" for p, t in blocks))
        for _, _, weight in H._page_row(page, {p: 0 for p in page.paths()})[2]:
            path = (*blocks[0][0], "p")
            stats[path] = (0.0, stats.get(path, (0.0, 0))[1] + weight)
    assert H.induce(tuple(stats), stats)[0] == body


# ---- what the contract asks of odd pages --------------------------------------------------------------------

def on_hosts(spark, make, pages):
    """Text of every page of one host of ``pages`` pages; make(i) -> html."""
    rows = [(i, f"http://h{pages}.org/{i}", make(i)) for i in range(pages)]
    out = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return {r.page_id: r.text for r in out}


@pytest.mark.parametrize("pages", [3, 30])
def test_names_inside_an_article_and_around_it(spark, words, pages):
    body = [words.text(30) for _ in range(pages)]
    more = [words.text(20) for _ in range(pages)]
    by = ["By A. Writer", "By B. Writer"]

    def make(i):
        return f"""<html><head><title>t</title><body><nav>Menu</nav><div class="has-sidebar layout sidebar">
        <article class="post tag-search"><header class="entry-header"><h1>Head {i} {body[i][:9].strip()}</h1></header><p class="byline">{by[i % 2]}</p>
        <h2>Background</h2><section class="share-price"><p>{body[i]}</p></section><div class="share"><div>{more[i]}</div></div>
        <div class="share-bar">Tell all</div><div class="related-posts"><p>Read this</p></div><div id="comments"><p>Nice</p></div></article>
        <div class="sidebar">Side</div></div><footer>end</footer>"""

    for i, text in on_hosts(spark, make, pages).items():
        blocks = text.split("\n\n")
        # a subheading of every page of a larger host is template, one of some pages (here: a byline) is the article's own
        heading = ["Background"] if pages < H.TEMPLATE_PAGES else []
        assert blocks == [f"Head {i} {body[i][:9].strip()}", by[i % 2], *heading, body[i]]
        assert "Side" not in text


def test_a_named_element_that_holds_most_of_an_article_is_no_boilerplate(words):
    long = words.text(40)
    assert text_of(f'<article><h1>A b</h1><div class="social"><p>{long}</p></div></article>') == f"A b\n\n{long}"
    assert text_of(f'<div class="sidebar"><article><p>teaser</p></article></div><article><p>{long}</p></article>') == long


def test_unread_elements_end_no_block():
    assert text_of("<p>Second <script>x('</p>')</script>end</p>") == "Second end"
    assert text_of("<p>one<svg><g><text>no</text></g></svg> two <noscript><p>no</p></noscript>three</p>") == "one two three"
    assert text_of("<p>a<br/>b <select><option>x<option>y</select>c</p><p>d</p>") == "a b c\n\nd"
    assert text_of("<div><svg><path d=1><p>lost</p></div><p>kept</p>") == "kept"
    assert text_of("<head><title>T</title><p>no head end</p>") == "no head end"


def test_an_open_quote_does_not_leave_markup():
    assert text_of('<p>see <a href="x>link</a> here</p>') == "see link here"
    assert "<" not in text_of("<p class='a>b</p><p>c</p>")


def test_deep_and_wide_trees():
    deep = tuple(tuple(f"div.{k}" for k in range(n)) for n in (1, 1500, 3000))
    size, pairs = H.simple_tree_matching(H.tree(deep), H.tree(deep[:2]))
    assert size == 1501
    assert len(pairs) == 1501
    wide = tuple((f"p.{i}",) for i in range(4000))
    size, _ = H.simple_tree_matching(H.tree(wide), H.tree(wide[::-1]))
    assert size == 2
    assert H.simple_tree_matching(H.tree(wide), H.tree(wide[1::2]))[0] == 2001
    html = "<div>" * 3000 + "<p>deep text</p>" + "</div>" * 3000
    assert text_of(html) == "deep text"
