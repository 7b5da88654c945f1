import html
import re

from gigframe.llm import html_consensus as hc
from gigframe.llm import queries

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><a href=/>Home</a></nav>
<script>if (a<b && c=="</p>") x("<p>")</script><!-- <p>no</p> -->
<div id=sidebar><p>Side text that is quite long, longer than the article is, I say.</p></div>
<div class="post-12 content"><h2>Ti&amp;tle</h2><p>One <b>bo</b>ld<br>two
<p>Three &lt;b&gt; <a href="x>y">link</a><ul><li>a<li>b</ul>
<form><input value=">">No form</form><div class="ad">Buy</div><div hidden>secret</div>
<div class="comments"><p>A very long comment by a reader. And more of it.</p></div></div>
<div class="cookie-notice">We use cookies</div><footer>f</footer></body></html>"""


def test_one_page():
    assert hc.main_text(PAGE, None) == "Ti&tle One bold two Three <b> link a b"
    assert hc.best_path(hc.blocks(PAGE))[0] == "html>body.has-sidebar>div.content.post-#"
    for odd in ("", "plain text only", "<p>a<p>b", "</div></p>x", "<div", "<a <b>", "<!-- open",
                "<script>never closed <p>x", "<p>&nbsp;&#160;</p>"):
        hc.main_text(odd, "html>body")
    assert hc.main_text("<p>a<p>b", None) == "a b"
    assert hc.main_text("plain &amp; simple", None) == "plain & simple"


def test_consensus_overrules_one_odd_page(spark):
    def page(body, side):
        return (f'<html><body><div class="main"><p>{body}</p></div>'
                f'<div class="extra"><p>{side}</p></div></body></html>')

    rows = [(k, f"http://h.org/{k}", page(f"body {k} " * 20, "x"), "k") for k in range(5)]
    rows += [(9, "http://h.org/9", page("short body", "long aside " * 50), "k"),
             (10, "http://other.org/", page("short body", "long aside " * 50), "k"),
             (11, None, None, "k"), (12, "http://h.org/12", "", "k"), (12, "http://h.org/12", "", "k")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in hc.extract(df).collect()}
    assert got[9].text == "short body"  # the host's path, not the page's own best
    assert got[10].text.startswith("long aside")
    assert got[11].text == "" and got[11].n_chars == 0 and got[12].text == ""
    assert hc.extract(df).count() == len(rows)
    assert hc.extract(df.limit(0)).count() == 0


def test_query_equals_the_articles(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = queries.QUERIES["op4_html_consensus"](spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split())
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, want, len(want))


def test_text_beside_the_best_container_stays():
    long = "a long line of the article's own words " * 9
    wrap = "<html><body><nav><a href=/>Home</a></nav>{}<footer>f</footer></body></html>"
    for page in ("<article><h1>T</h1><p>lead</p><div class=content><p>L</p></div></article>",
                 "<article><h1>T</h1><div><div class=c><p>L</p></div></div><p>end</p></article>",
                 "<article><section class=a><p>L</p></section><section class=b>L</section></article>",
                 "<main><article><p>L</p></article><section class=more><p>x</p></section></main>",
                 "<article><p>intro</p><ul><li>L<li>L</ul><table><tr><td>x<td>y</table></article>",
                 "<article><p>intro</p><blockquote><p>L</p></blockquote></article>",
                 "<div class=post><h1>T</h1><div class=content><p>L</p></div></div>",
                 "<h1>T</h1><div class=content><p>L</p></div>"):
        page = page.replace("L", long)
        want = " ".join(re.sub(r"<[^>]*>", " ", page).split())
        assert hc.main_text(wrap.format(page), None) == want
        # Also where most pages of the host have nothing beside the best container.
        own = max(hc.blocks(wrap.format(page)), key=lambda x: len(x[1]))[0]
        assert hc.main_text(wrap.format(page), hc._container(own).path) == want


def test_svg_math_and_object_hide_no_text_around_them():
    for page, want in (
            ("<svg class=i/><p>a</p><p>b <math/>c</p>", "a b c"),
            ("<p>a<svg/>b</p><p>c</p><svg><path/><text>no</text></svg><p>d</p>", "ab c d"),
            ("<p>a <svg><svg><g/></svg><text>no</text></svg>b</p><p>c</p>", "a b c"),
            ("<p>a <svg><title>no</title><style/><text>no</p><p>b</p>", "a b"),
            ("<p>a</p><svg><g><p>b</p><p>c</p>", "a b c"),
            ("<p>a</p><svg><foreignObject><p>no</p></foreignObject></svg><p>b</p>", "a b"),
            ("<p>a</p><object data=x><p>b</p><p>c</p>", "a b c"),
            ("<p>a <object data=x><param></p><p>b</p><div><object>no</object>c</div>", "a b c"),
            ("<p>a <object><p>no<object>no</object><div>no</div>no</object> b</p><p>c", "a b c")):
        page = f"<html><body><article>{page}</article></body></html>"
        assert hc.main_text(page, None) == want, page


LINE = "a long line of the article's own words "
WRAPPERS = (
    '<div class="layout has-sidebar">{}</div>', '<form id="aspnetForm" method=post>{}</form>',
    '<div class="elementor-widget">{}</div>', '<div id="content-share-price">{}</div>',
    '<div data-hidden=no>{}</div>', '<div data-x="hidden" class="x-hidden-y">{}</div>',
    '<section class="widget"><div class="no-comments-yet">{}</div></section>',
    '<div class="sidebar"><div>{}</div></div>', '<table><tr><td class="menu-layout">{}</table>',
    '<div class="header-fixed page-with-banner"><div class="modal-open">{}</div></div>')
BODIES = (
    "<article><h1>Title</h1><p>L</p><p>second</p></article>",
    "<main><h1>Title</h1><ul><li>L</li><li>two</li></ul></main>",
    '<div class="post"><h1>Title</h1><table><tr><td>L</td><td>x</td></tr></table></div>',
    "<article><p>L</p><blockquote><p>quoted</p></blockquote></article>",
    '<article><section class="a"><p>L</p></section><section class="b"><p>L</p></section></article>',
    "<article><header><h1>Title</h1><p>lead</p></header><p>L</p></article>")
BESIDE = ('<nav><a href=/>Home</a></nav><div class="sidebar"><p>side text</p></div>',
          '<div class="comments"><article class="comment"><p>a reader says</p></article></div>'
          '<form><input><p>your name</p></form><div hidden>no</div><footer>f</footer>')


def test_wrappers_with_hint_words_lose_no_article():
    for body in BODIES:
        for size in (9, 30_000):
            inner = body.replace("L", LINE * size)
            want = " ".join(re.sub(r"<[^>]*>", " ", inner).split())
            for one in WRAPPERS:
                for two in ("{}", *WRAPPERS[:3]) if size < 100 else ("{}",):
                    for where in ("<body>{w}{b}</body>", "<body>{b}{w}</body>"):
                        page = where.format(w=one.format(two.format(inner)), b=BESIDE[0] + BESIDE[1])
                        got = hc.main_text(f"<html>{page}</html>", None)
                        assert got == want, (one, two, where, body, got[:200])


def test_hints_still_hold_beside_the_article():
    text = f"<article><h1>T</h1><p>{LINE * 9}</p></article>"
    for part in ('<div class="sidebar">{}</div>', '<div id=comments><article>{}</article></div>',
                 '<ol class="comment-list"><li><article class="comment-body">{}</article></ol>',
                 '<form><label>{}</label><input></form>', '<div class="site-header">{}</div>',
                 '<section class="related"><article>{}</article></section>', "<div hidden>{}</div>",
                 '<div class="cookie-notice">{}</div>', '<div class="ad-slot widget">{}</div>'):
        page = f"<html><body>{text}{part.format('<p>' + LINE * 4 + '</p>')}</body></html>"
        assert hc.main_text(page, None) == " ".join(re.sub(r"<[^>]*>", " ", text).split()), part


def test_salted_join_gives_the_same_rows(spark, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").selectExpr(
        "*", "'x' as winner", "1 as salt")
    def rows():
        return sorted(map(tuple, hc.extract(pages).collect()))
    plain = rows()
    monkeypatch.setattr(hc, "BROADCAST_BYTES", -1)
    assert rows() == plain
