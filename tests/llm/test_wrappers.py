from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from footfall.llm import wrappers as w


def one(html, *others):
    """The text of the first page, by the wrapper of all."""
    wrapper = None
    for page in (html, *others):
        made = w.wrapper_of(w.parse(page))
        wrapper = made if wrapper is None else w.align(wrapper, made)
    return w.main_text(w.parse(html), w.rules(wrapper))


def test_article_only():
    page = (
        '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>'
        "<nav><ul><li><a href=/x>Menu</a></li></ul></nav><!-- note <p>no</p> --><div class=\"ad\">Buy</div>"
        "<article><h1>A &amp; B</h1><p><b>Bold  \n text<br>on<p>Second &quot;one&quot;</p><aside>Side</aside>"
        '<div class="newsletter-box">Join</div><form>Name <input></form>'
        "<ul><li>x<li>y</ul></article><section id=comments><p>First!</p></section><footer>&copy; me</footer></body></html>"
    )
    assert one(page) == 'A & B\n\nBold text on\n\nSecond "one"\n\nx\n\ny'


@pytest.mark.parametrize("html, text", [
    ("", ""), ("plain words", "plain words"), ("<p>a < b &lt; c", "a < b < c"), ("<article>cut <p off", "cut"),
    ("<article><p>a</p>tail</article>", "a\n\ntail"), ("<main><p>a&nbsp;&#8217;b&#x41;</p></main>", "a ’bA"),
    ("<article><p>one</div></span>two</p></article>", "onetwo"), ("<article>" + "<div>" * 3000 + "deep</article>", "deep"),
    ("<article><a href='x>y'>link</a> text</article>", "link text"), ("<article><pre>a\n  b</pre></article>", "a b"),
    ("<article><table><tr><td>1<td>2<tr><td>3</table></article>", "1\n\n2\n\n3"),
    ('<article><p class="lead">in</p><div role="navigation">out</div></article>', "in"),
])
def test_small_pages(html, text):
    assert one(html) == text


def test_host_without_an_article_element():
    def page(k):
        return (
            f'<body><header><h1>Site</h1></header><div id=top><ul><li><a>a</a></li><li><a>b{k}</a></li></ul></div>'
            f'<div class="content"><h2>Title {k}</h2><p>Text {k} <a>link {k}</a> here</p></div><div class=box>All rights</div>'
        )

    assert one(page(0), page(1), page(2)) == "Title 0\n\nText 0 link 0 here"


def plain(k, extra=""):
    return f'<body><div class="top">All pages</div><div class="content"><h2>Title {k}</h2><p>Text {k}</p>{extra}</div></body>'


def named(k):
    return f"<body><div class=top>All pages</div><main><h1>Main {k}</h1><p>Words {k}</p></main></body>"


def test_host_of_pages_with_and_without_an_article_element(spark):
    pages = [plain(0), *(named(k) for k in range(3)), plain(1)]
    for order in (pages, pages[::-1]):
        assert one(order[0], *order[1:]).startswith("Title ")
    assert one(pages[1], *pages[2:], pages[0]) == "Main 0\n\nWords 0"
    rows = [(k, f"https://h.org/{k}", plain(k) if k % 5 == 0 else named(k)) for k in range(40)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(5)
    got = {r.page_id: r.text for r in w.extract(frame).collect()}
    assert got == {k: f"Title {k}\n\nText {k}" if k % 5 == 0 else f"Main {k}\n\nWords {k}" for k in range(40)}


def test_texts_of_one_page_stay():
    lone = '<blockquote>Quote</blockquote><pre>code</pre><h3>Sub</h3><h2 id=intro>Intro</h2>'
    want = "Title 0\n\nText 0\n\nQuote\n\ncode\n\nSub\n\nIntro"
    assert one(plain(0, lone), *(plain(k) for k in range(1, 30))) == want
    assert one(plain(0, lone), plain(1, lone), *(plain(k) for k in range(2, 30))) == want
    slugs = [f"<h2 id=part-{'abcdefghij'[k]}>Part {k}</h2><p>more {k}</p>" for k in range(10)]
    for k in range(10):
        assert one(plain(k, slugs[k]), *(plain(j, slugs[j]) for j in range(10) if j != k)) == f"Title {k}\n\nText {k}\n\nPart {k}\n\nmore {k}"


def test_one_page_is_no_evidence():
    page = "<body><h1>Title</h1><p>one</p><p>two</p><div class=end>Last</div></body>"
    assert one(page) == one(page, page, page.replace("<body>", "<body><nav>other</nav>")) == "Title\n\none\n\ntwo\n\nLast"


def test_boilerplate_of_nearly_all_pages():
    def text(k, n, odd):
        pages = [plain(j) for j in range(n)] + [f"<body><div class=content><p>Odd {j}</p></div></body>" for j in range(odd)]
        return one(pages[k], *pages[:k], *pages[k + 1:])

    assert text(0, 100, 3) == text(0, 20, 1) == "Title 0\n\nText 0"
    assert text(0, 100, 60) == text(0, 2, 2) == "All pages\n\nTitle 0\n\nText 0"


def test_page_without_a_host(spark):
    page = "<body><h1>Title</h1><p>one</p><p>two</p><blockquote>Quote</blockquote></body>"
    frame = spark.createDataFrame([(1, None, page), (2, "https://one.org/", page), (3, "https://one.org/?again", page)], "page_id bigint, url string, html string")
    assert [r.text for r in w.extract(frame.repartition(3)).collect()] == ["Title\n\none\n\ntwo\n\nQuote"] * 3


def test_alignment_finds_optional_and_repeated_groups():
    a = w.wrapper_of(w.parse("<dl><dt>a</dt><dd>b</dd><dt>c</dt><dd>d</dd></dl><p>same</p><hr>"))
    b = w.wrapper_of(w.parse("<dl><dt>a</dt><dd>b</dd></dl><p>same</p><p>other</p>"))
    both = w.align(a, b)
    dl, p, hr = both[4]
    assert [c[0] for c in dl[4]] == ["(", "dt", "dd"] or dl[4][0][0] == "("
    assert p[2] == 1 and p[3] == "*"
    assert hr[0] == "hr" and hr[1] == 1


def test_alignment_is_settled():
    """Aligning a wrapper with pages it was made of changes nothing."""
    rng = random.Random(1)
    parts = ["<p>x</p>", "<p>y</p>", "<h2>z</h2>", "<ul><li>1</li><li>2</li></ul>", "<dl><dt>q</dt><dd>r</dd></dl>"]
    made = [w.wrapper_of(w.parse("<article>" + "".join(rng.choices(parts, k=rng.randrange(1, 12))) + "</article>")) for _ in range(30)]
    wrapper = made[0]
    for _ in range(3):
        for x in made:
            wrapper = w.align(wrapper, x)
    for x in made:
        assert w.rules(w.align(wrapper, x)) == w.rules(wrapper)


def test_many_different_children_are_known_by_tag():
    page = "<article>" + "".join(f"<p id='{'abcdefghij'[k % 10]}{chr(97 + k // 10 % 26)}{chr(97 + k // 260)}'>t{k}</p>" for k in range(1500)) + "</article>"
    made = w.wrapper_of(w.parse(page))
    assert len(made[4][0][4]) <= w.MOST_CHILDREN
    assert one(page).count("\n\n") == 1499


@pytest.mark.parametrize("around", [
    'div class="content-sidebar-wrap"', 'div class="layout has-sidebar"', "div class=no-sidebar", "div class=page-with-banner",
    "section class=social-news", "div class=sidebar", "div id=comments role=dialog", "form id=aspnetForm",
])
@pytest.mark.parametrize("main", ["main", "article", "div"])
def test_elements_around_the_article(around, main):
    if main == "div" and around in ("div class=sidebar", "div id=comments role=dialog", "form id=aspnetForm"):
        return  # nothing says that the article is in there
    tag = around.split()[0]
    def page(k):
        return f"<body><{around}><div class=menu>Menu</div><{main}><h1>Title {k}</h1><div class=ad>Buy</div><p>Text {k}</p></{main}></{tag}><footer>f</footer>"

    assert one(page(0)) == one(page(0), page(1), page(2)) == "Title 0\n\nText 0"


def test_articles_in_what_is_left_out():
    rest = "<section class=comments><article>First!</article></section><div class=related-posts><article>More</article></div><aside><article>Teaser</article></aside>"
    assert one(f"<article><p>Text</p>{rest}</article>") == one(f"<main><p>Text</p></main>{rest}") == "Text"


@pytest.mark.parametrize("name, out", [
    ("ad", 1), ("ad-3", 1), ("google_ad", 1), ("newsletter-box", 1), ("site-comments-area", 1), ("ad-wrapper", 1), ("widget sidebar-left", 1),
    ("comment-body", 1), ("reader-responses", 1), ("usercomments", 1), ("adsbox", 1), ("article-body", 0), ("response-time", 0),
    ("social-news", 0), ("page-with-banner", 0), ("content-sidebar-wrap", 0), ("has-sidebar layout", 0), ("adverb", 0), ("comment-policy", 0),
])
def test_names_of_what_is_left_out(name, out):
    assert one(f"<article><p>Text</p><div class='{name}'>more</div></article>") == ("Text" if out else "Text\n\nmore")


@pytest.mark.parametrize("n", [3, 119, 120, 121, 200, 3000])
def test_deep_elements(n):
    open_, end = "<div>" * n, "</div>" * n
    assert one(f"<article>{open_}deep{end}after</article>") == "deep\n\nafter"
    assert one(f"<body><div class=ad>{open_}Buy{end}</div><article>{open_}a<p>b<p>c</p>d{end}<p>after</p></article><aside>{open_}x{end}y</aside>") == "a\n\nb\n\nc\n\nd\n\nafter"
    assert one(f"<div class=sidebar>{open_}x{end}y</div><div class=content>{open_}a{end}<p>b</p></div>") == "a\n\nb"
    out = "<aside><div>x</div>x</aside><nav>x<aside>x</aside></nav><div class=ad><p>x</div><script>x</script>"
    assert one(f"<article>{open_}a{out}b<p>c</p>{end}d</article>") == "a\n\nb\n\nc\n\nd"
    assert one(f"<body>{open_}x<div class=sidebar><main>a{out}<p>b</p></main>x</div>x{end}x") == "a\n\nb"


def slug(k):
    return "".join("abcdefghij"[int(d)] for d in str(k))


@pytest.mark.parametrize("n", [20, 500])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_many_slug_ids_do_not_bring_in_what_is_left_out(tag, n):
    """The same text on small and on big hosts, whatever the order of the pages."""
    def page(k):
        return (
            f"<body><{tag}><h2 id={slug(k)}>Title {k}</h2><div class=ad id=x{slug(k)}>Buy {k}</div><p id=p{slug(k)}>Text {k}</p>"
            f"<div id=l{slug(k)}><a>link {k}</a></div><div id=d{slug(k)}>Body {k}</div><section class='comments c{slug(k)}'><p>First {k}!</p></section></{tag}>"
            "<div class=legal><p id=copyright>All rights</p></div></body>"
        )

    links = "link {k}\n\n" if tag == "article" else ""
    pages = [page(k) for k in range(n)]
    for order in (pages, pages[::-1]):
        wrapper = w.wrapper_of(w.parse(order[0]))
        for p in order[1:]:
            wrapper = w.align(wrapper, w.wrapper_of(w.parse(p)))
        decisions = w.rules(wrapper)
        assert [w.main_text(w.parse(p), decisions) for p in pages] == [f"Title {k}\n\nText {k}\n\n{links.format(k=k)}Body {k}" for k in range(n)]


def test_template_among_many_slug_ids():
    def page(k):
        return f"<body><div class=content><h2 id={slug(k)}>Title {k}</h2><p id=legal>All rights</p><div id=end><p>The end</p></div></div></body>"

    assert one(*(page(k) for k in range(500))) == "Title 0"


def test_extract(spark):
    def page(k):
        return f"<nav><a>m</a></nav><article><h1>T{k}</h1><p>b{k} &amp;</p></article><footer>f</footer>"

    rows = [(k, f"https://www.Host{k % 3}.org/p/{k}?q", page(k)) for k in range(60)]
    rows += [(100, "https://host0.org/", None), (101, None, page(101)), (102, "no url", ""), (5, rows[5][1], rows[5][2]), (None, "http://u@host1.org:80/x", page(7))]
    frame = spark.createDataFrame([(*r, "n") for r in rows], "page_id bigint, url string, html string, text string")
    got = w.extract(frame.repartition(4)).collect()
    want = [(i, u, f"T{h.split('<h1>T')[1].split('<')[0]}\n\nb{h.split('<p>b')[1].split(' ')[0]} &" if h else "") for i, u, h in rows]
    assert sorted(((r.page_id, r.url, r.text) for r in got), key=str) == sorted(want, key=str)
    assert all(r.n_chars == len(r.text) for r in got)
    assert w.extract(frame.limit(0)).count() == 0


def test_nearly_all_is_judged_by_all_pages_of_a_host(spark):
    """A text on the 64 pages of the smallest hashes and on few others is no template's; one on nine in ten pages is.
    Pages that differ in what is left out only, and repeated rows, are one page."""
    def page(k, extra, footer=0):
        return f"<body><div class=content><h2>Title {k}</h2><p>Text {k}</p></div>{extra}<footer>{footer}</footer></body>"

    note = "<div class=note>Read on</div>"
    low = sorted(range(800), key=lambda k: w._page_hash(w.parse(page(k, note))))[:70]
    high = sorted(set(range(800)) - set(low), key=lambda k: w._page_hash(w.parse(page(k, ""))))[-300:]
    rows = [(k, f"http://a.org/{k}", page(k, note if k in low else "")) for k in low + high]
    rows += [(1000 + k, f"http://b.org/{k}", page(k, "<div class=legal>All rights</div>" if k % 20 else "")) for k in range(200)]
    rows += [(2000 + k, "http://c.org/", page(0, "<div class=legal>All rights</div>", k)) for k in range(30)]
    frame = spark.createDataFrame(rows + rows[:5], "page_id bigint, url string, html string").repartition(5)
    got = {r.page_id: r.text for r in w.extract(frame).collect()}
    assert {k: t for k, t in got.items() if k < 800} == {k: f"Title {k}\n\nText {k}" + "\n\nRead on" * (k in low) for k in low + high}
    assert {k - 1000: t for k, t in got.items() if 1000 <= k < 2000} == {k: f"Title {k}\n\nText {k}" for k in range(200)}
    assert {t for k, t in got.items() if k >= 2000} == {"Title 0\n\nText 0\n\nAll rights"}


def test_hosts(spark):
    urls = ["https://www.A.org/x", "http://u:p@b.net:80?x", "ftp://c.de", "nothing", None, "https:///x"]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in frame.select(w.host_of(F.col("url"))).collect()] == ["a.org", "b.net", "c.de", None, None, None]
