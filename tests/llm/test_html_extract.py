"""HTML extraction: known articles come back whole, what surrounds them doesn't."""

import time

from flowsight.llm.html_extract import (
    MUCH_LESS,
    best_container,
    extract,
    host_of,
    is_under,
    page_blocks,
    parsed_page,
    parsed_pages,
    winning_paths,
)

SCHEMA = "page_id long, url string, html string"

BLOG = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header class="top"><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav>
<div class="cookie-notice">We use cookies &amp; more</div>
<div class="layout"><div class="sidebar"><p>About the author, a long text that is no part of it</div>
<div class="post-%d entry"><h2>Title &amp; more %d</h2><p>First   paragraph with <b>bold</b> and <a href=x>a link</a>.
<p>Second &lt;one&gt; with a<br>break &copy; 2024&nbsp;x
<ul><li>point one<li>point two</ul>
<div class="ad">Buy this</div><script>var a = "<p>not text</p>";</script>
<blockquote>Quoted words</blockquote><form><input><label>Mail</label></form><p>Last paragraph, quite some text again.</div>
<div class="comments"><p>Reader: I do not agree with a word of this text, none at all, and here is why.</p></div></div>
<footer>&copy; Site</footer></body></html>"""

BLOG_TEXT = (
    "Title & more {0}\nFirst paragraph with bold and a link.\nSecond <one> with a break © 2024 x\n"
    "point one\npoint two\nQuoted words\nLast paragraph, quite some text again."
)


def test_articles_of_a_blog(spark):
    rows = [(i, f"http://u@Blog.example.com:80/{i}", BLOG % (i, i)) for i in range(12)]
    got = extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in got) == [
        (i, BLOG_TEXT.format(i), len(BLOG_TEXT.format(i))) for i in range(12)
    ]


def test_votes_overrule_a_page(spark):
    page = '<div class="a"><p>{}</p></div><div class="b"><p>{}</p></div>'
    long, short = "many words of the article " * 9, "short text, not much less " * 3
    rows = [(i, "http://h/x", page.format(long, short)) for i in range(5)]
    rows += [(9, "http://h/y", page.format(short, long)), (10, "http://h/z", "<section>elsewhere</section>")]
    pages = spark.createDataFrame(rows, SCHEMA)
    assert [r.winner for r in winning_paths(parsed_pages(pages)).collect()] == ["body>div.a"]
    got = {r.page_id: r.text for r in extract(pages).collect()}
    assert got[0] == long.strip() and got[9] == short.strip() and got[10] == "elsewhere"


def test_article_keeps_its_header_and_sections():
    source = "<main><article><header><h1>H</h1></header><section><p>one</section><section><p>two words here</section></article></main>"
    blocks = page_blocks(source)
    assert [t for _, t, _ in blocks] == ["H", "one", "two words here"]
    assert best_container(blocks)[0] == "body>main"


def test_broken_markup():
    texts = lambda s: [t for _, t, _ in page_blocks(s)]
    assert texts("a < b <p>c<!-- never closed <p>d") == ["a < b", "c"]
    assert texts("<p>x</b></div></p></p>y") == ["x", "y"]
    assert texts('<p title="a>b">in</p><script>x<p>') == ["in"]
    assert texts("<p>&#65;&#x42;&amp;amp; &unknown;") == ["AB&amp; &unknown;"]
    assert texts("<div hidden>no</div><div style='display: none'>no</div><p>yes") == ["yes"]
    assert texts("") == [] and texts("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert len(texts("<p>word</p>" * 20_000)) == 20_000


def test_nulls_and_names(spark):
    rows = [(1, None, "<p>text</p>"), (2, "x", None), (3, "x", ""), (None, "http://a/b", "<p>q"), (1, None, "<p>text</p>")]
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'h' AS host", "1 AS winner", "2 AS text", "3 AS salt")
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in extract(pages).collect())
    assert got == [(0, "q", 1), (1, "text", 4), (1, "text", 4), (2, "", 0), (3, "", 0)]
    assert extract(pages.filter("false")).count() == 0
    assert host_of("https://WWW.x.org:8080/a?b") == "www.x.org" and host_of(None) == host_of("nothing") == ""


LONG = "A sentence of the article with quite a few words in it. " * 6
SIDE = "<div class=sidebar><p>Words beside it.</p></div>"


def text_of(spark, source):
    return extract(spark.createDataFrame([(1, "http://h/x", source)], SCHEMA)).first().text


def test_containers_with_a_dropped_word_in_their_name_keep_the_article(spark):
    want = LONG.strip()
    for source in (
        f'<div class="layout has-sidebar"><p>{LONG}</p>{SIDE}</div>',
        f'<div id="content" class="no-sidebar"><p>{LONG}</p></div>{SIDE}',
        f'<form id="aspnetForm"><div id="main"><p>{LONG}</p></div><input><div class=footer>Foot</div></form>',
        f'<div class="page with-menu"><div class=menu><a href=x>Menu</a></div><div><p>{LONG}</p></div></div>',
    ):
        assert text_of(spark, source) == want, source
    boxes = f'<form class=search><label>Find it</label></form><div class="ad">Buy</div>{SIDE}'
    assert text_of(spark, f"{boxes}<div><p>{LONG}</p></div>{boxes}") == want
    comments = f'<div class="comments">{"<p>I do not think so, said a reader of it.</p>" * 40}</div>'
    assert text_of(spark, f"<div class=post><p>{LONG}</p>{comments}</div>") == want
    theirs = f'<div class="comments">{"<article>I do not think so, said a reader of it.</article>" * 40}</div>'
    assert text_of(spark, f"<div class=post><p>{LONG}</p>{theirs}</div>") == want
    assert text_of(spark, f"<article>Short.</article><div class=ad>{LONG}</div>") == "Short."
    assert text_of(spark, f'<h1 class="page-header">Title</h1><p>{LONG}</p>') == f"Title\n{want}"


def test_title_and_lead_outside_of_the_longest_part(spark):
    source = f"<div class=post><h1>Title</h1><div class=lead>Lead</div><div class=body><p>{LONG}</p></div></div><div>other box</div>"
    assert text_of(spark, source) == f"Title\nLead\n{LONG.strip()}"


def test_two_templates_of_a_host(spark):
    rows = [(i, "http://h/x", f"<div class=a><p>{LONG}{i}</p></div><div class=b>box</div>") for i in range(6)]
    rows += [(i, "http://h/x", f"<div class=a>box</div><div class=c><p>{LONG}{i}</p></div>") for i in range(6, 8)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: f"{LONG}{i}" for i in range(8)}


def test_votes_and_extraction_equal_a_plain_version(spark):
    import random
    from collections import Counter, defaultdict

    pick = random.Random(4)

    def page():
        boxes = [f"<div class={pick.choice('abc')}{pick.randint(1, 99)}><p>{'word ' * pick.choice([2, 9, 60])}</p></div>" for _ in range(4)]
        return pick.choice(["", "<h1>T</h1>"]) + "".join(boxes)

    rows = [(i, f"http://{'hot' if i % 2 else f'host{i % 7}'}/", page()) for i in range(200)]
    votes, parsed = defaultdict(Counter), {}
    for i, url, source in rows:
        blocks, titles = parsed_page(source)
        vote, size = best_container(blocks, titles)
        parsed[i] = host_of(url), blocks, vote
        votes[host_of(url)][vote] += 1
        votes[host_of(url), vote]["size"] += size
    want = {}
    for i, (host, blocks, vote) in parsed.items():
        winner = min(votes[host], key=lambda v: (-votes[host][v], -votes[host, v]["size"], v))
        first, own = ([t for p, t, _ in blocks if is_under(p, top)] for top in (winner, vote))
        enough = first and sum(map(len, first)) >= MUCH_LESS * sum(map(len, own))
        want[i] = "\n".join(first if enough else own)
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want


def test_hostile_pages_take_linear_time():
    n = 1 << 20
    pages = ["<a ", '<a "', "<a '>\"", '<a ">"', "<div>", "<x>", "</p>", "<!--", "<script ", "<script>", "< ", "<p class='", "&#", "<li><p></x>"]
    for part in pages:
        start = time.process_time()
        page_blocks(part * (n // len(part)))
        assert time.process_time() - start < 8, part
    start = time.process_time()
    assert page_blocks("<a " * (n // 3)) != [] and time.process_time() - start < 1
    deep = page_blocks("<div><x>" * 50_000 + "<p>text</p>" * 10)
    assert [t for _, t, _ in deep] == ["text"] * 10 and len(deep[0][0]) < 400
