"""Template deduction and extraction."""

from __future__ import annotations

from cardsentry.llm import htmltemplate as h


def _page(n, body, extra=""):
    return (f"<!DOCTYPE html><html><head><title>t{n}</title><script>var x='<p>no</p>'</script></head><body><header><h2>Site</h2></header>"
            f"<nav><ul><li><a href=/a>Home {n}</a></li></ul></nav>{body}<div class='sidebar box'>side {n}</div>{extra}"
            f"<form><input name=q><button>Go</button></form><footer>&copy; me {n}</footer></body></html>")


def _texts(spark, pages):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    return {r.page_id: r.text for r in h.main_text(df).collect()}


def test_article(spark):
    body = ("<article><h1>A &amp; B</h1><p><b>one <i>two</i>three<br>four<p>five&nbsp;six &lt;b&gt; &amp;lt;</p>"
            "<aside>no</aside><div class=\"ad\">buy</div><section class=comments><p>troll</p></section><p>  last \n line </p></article>")
    got = _texts(spark, [(i, f"https://a.example/{i}", _page(i, body)) for i in range(3)])
    assert set(got.values()) == {"A & B\none twothree four\nfive six <b> &lt;\nlast line"}


def test_template_without_article_names(spark):
    """No element says what is the text: constant text and link lists go."""
    def page(i):
        return (f"<html><body><div id=top>Daily Planet</div><div id=x7><a href=1>Politics {i}</a> <a href=2>Sports {i}</a></div>"
                f"<div id=x8><p>Story number {i} begins here.</p><p>All rights reserved by us.</p><p>It ends with {i * 7}.</p></div></body></html>")

    got = _texts(spark, [(i, f"http://p.example/{i}", page(i)) for i in range(1, 6)])
    assert got == {i: f"Story number {i} begins here.\nIt ends with {i * 7}." for i in range(1, 6)}
    alone = _texts(spark, [(1, "http://q.example/1", page(1))])
    assert alone[1] == "Daily Planet\nStory number 1 begins here.\nAll rights reserved by us.\nIt ends with 7."


def test_host_with_two_layouts(spark):
    """Pages without an article keep their text on a host whose template has one."""
    def new(i):
        return f"<html><body><div id=w><article><h1>New {i}</h1><p>Story {i} of the new layout.</p></article></div></body></html>"

    def old(i):
        return f"<html><body><div id=c><p>Story {i} of the old layout.</p><p>Its end {i}.</p></div></body></html>"

    got = _texts(spark, [(i, f"http://m.example/{i}", new(i) if i < 4 else old(i)) for i in range(7)])
    assert got == {i: f"New {i}\nStory {i} of the new layout." if i < 4 else f"Story {i} of the old layout.\nIts end {i}." for i in range(7)}


def test_names_of_wrappers(spark):
    """Classes of the layout on body, wrappers and the article drop nothing; on a small element they do."""
    def page(i):
        return (f"<html><body class='has-sidebar menu-open'><div id=page class=no-sidebar><div class='{'x' * 2100}'><div class=ad-free>"
                f"<article class='post no-comments'><h1>Head {i}</h1><p>A story of some length with the number {i}.</p>"
                f"<div class=share-bar>tell {i}</div></article></div></div></div></body></html>")

    got = _texts(spark, [(i, f"http://{'v' if i < 4 else i}.example/{i}", page(i)) for i in range(6)])
    assert got == {i: f"Head {i}\nA story of some length with the number {i}." for i in range(6)}


def test_furniture_inside_the_article(spark):
    """Constant blocks and link slots without a telling name go inside articles too; near copies keep theirs."""
    def page(i):
        swap = ["<p>First offer.</p>", "<p>Second offer.</p>"]
        return (f"<html><body><div id=top>Daily Planet</div><article><h1>Head {i}</h1><p>Story {i} begins here.</p>"
                f"<div class=q1><p>Tell your friends about us!</p></div><p>It ends with {i * 7}.</p>"
                f"<div class=q2><a href=1>More on {i}</a> <a href=2>And on {i + 1}</a></div><p>Get our letter.</p>"
                f"<div class=q3>{''.join(swap if i % 2 else swap[::-1])}</div></article></body></html>")

    got = _texts(spark, [(i, f"http://p.example/{i}", page(i)) for i in range(1, 7)])
    # Two of the constant texts change places from page to page.
    assert got == {i: f"Head {i}\nStory {i} begins here.\nIt ends with {i * 7}." for i in range(1, 7)}
    story = "".join(f"<p>Paragraph {n} of one long story.</p>" for n in range(40))
    near = _texts(spark, [(i, f"http://n.example/{i}", f"<html><body><article>{story}<p>Seen {i}</p></article></body></html>") for i in range(5)])
    assert near == {i: "\n".join([*(f"Paragraph {n} of one long story." for n in range(40)), f"Seen {i}"]) for i in range(5)}


def test_copies_are_no_template(spark):
    page = "<html><body><div><p>The only text.</p><p>And more of it.</p></div></body></html>"
    got = _texts(spark, [(i, "http://c.example/", page) for i in range(20)])
    assert set(got.values()) == {"The only text.\nAnd more of it."}


def test_odd_pages(spark):
    got = _texts(spark, [
        (1, None, "<p>no host</p>"), (2, "http://x/", None), (3, "http://x/", ""), (4, "nonsense", "plain text  only"),
        (5, "http://y/", "<article><p>never closed <b>here"), (6, "http://y/", "<p>a<!-- open"), (7, "http://z/", "<script>x"),
        (8, "http://z/", "<p class='>'>ok</p>" + "<div>" * 3000 + "deep"), (None, "http://z/", "<p>nameless</p>"), (4, "nonsense", "plain text  only"),
        (9, "http://w/", "<p>" + "long " * 50_000 + "</p>")])
    assert got[1] == "no host" and got[2] == "" and got[3] == "" and got[4] == "plain text only"
    assert got[5] == "never closed here" and got[6] == "a" and got[7] == "" and got[8] == "ok\ndeep" and got[None] == "nameless"
    assert got[9] == ("long " * 50_000).strip()
    empty = spark.createDataFrame([], "page_id long, url string, html string, host string, text string, id int")
    assert h.main_text(empty).count() == 0


def _of_pages(spark, *pages):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in h.main_text(df).collect()}


def test_paragraphs_that_pages_share_stay(spark):
    """Two pages of one host with eight of ten paragraphs in common, in the
    article itself or in an element of it; a fixed line of its own goes."""
    shared = [f"This paragraph {i} is common to the corrected editions." for i in range(8)]
    for wrap in ("{}", "<div class='x7'>{}</div>"):
        pages, want = [], []
        for k in range(2):
            lines = ["One headline", *shared, f"An own paragraph of edition {k}.", f"Another one that only {k} has."]
            body = "<h1>One headline</h1>" + "".join(f"<p>{x}</p>" for x in lines[1:])
            pages.append(("http://h.example/" + str(k), f"<html><body><nav><ul><li>Home</li></ul></nav><article>{wrap.format(body)}"
                          "<div class='q9'>Write to us now</div></article><footer>Foot</footer></body></html>"))
            want.append("\n".join(lines))
        assert list(_of_pages(spark, *pages).values()) == want


def test_names_inside_an_article(spark):
    html = ("<body><article><h1>Title of it</h1><section id='related-work'><p>Related work is here</p></section><blockquote class=reply>A quotation</blockquote>"
            "<p>one <b>a</b>\n<b>b</b> two</p><div class='comments'><p>Nice post</p></div><div class='share'>Share it</div></article></body>")
    assert _of_pages(spark, ("http://a.example/", html))[0] == "Title of it\nRelated work is here\nA quotation\none a b two"


def test_line_breaks_outside_body_and_stray_quotes(spark):
    pages = [("http://a.example/", "<p>one <b>a</b>\n<b>b</b> two</p>"),
             ("http://b.example/", "<article><p title='it's'>Don't stop</p><p>It's here</p></article>"),
             ("http://c.example/", "<article><p class=\"x>still a tag</p><p>shown</p></article>"),
             ("http://d.example/", "<article><p>1 < 2 and 3 > 2</p><p>a <b</p></article>")]
    got = _of_pages(spark, *pages)
    assert (got[0], got[1], got[2]) == ("one a b two", "Don't stop\nIt's here", "still a tag\nshown")
    assert got[3].startswith("1 < 2 and 3 > 2")


def test_broken_markup_is_read_in_linear_time():
    import time

    hostile = ["<a " * 300_000, "<a " * 300_000 + ">", "<" * 500_000, "<!--" * 200_000, "<a x=\"" * 200_000 + ">", "<a x='\"" * 200_000 + ">", "</div" * 200_000 + ">",
               "<script>" + "</script " * 200_000, "<div>" * 100_000 + "</p>" * 100_000, "<div>" * 50_000 + "</section>" * 100_000, "a='b" * 300_000, "&" * 500_000,
               "<p " + "class='a' " * 100_000 + ">x"]
    for html in hostile:
        began = time.time()
        h.read_page(html)
        assert time.time() - began < 5, html[:30]
