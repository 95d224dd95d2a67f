from tidepool.llm import html_extract as H
from tests.llm.harness import matches

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body class="home">
<header><h1>Site</h1></header><nav><ul><li><a href="/a>b">Menu</a></li></ul></nav><!-- <p>no</p> --><div class="cookie-notice">Cookies</div>
<main><article><h1>Ti&amp;tle</h1><p>One <b>two</b>
 three<br>four<p>Five &lt;six&gt;<div class="ad">Buy</div><ul><li>x<li>y</ul><section id="comments"><p>reader</p></section>
<aside>side</aside><form><p>name</p><input></form></article></main><footer>&copy; foot</footer></body></html>"""


def test_rules():
    assert H.main_text(PAGE) == "Ti&tle\n\nOne two three four\n\nFive <six>\n\nx\n\ny"
    assert H.main_text("") == "" and H.main_text("just text &am") == "just text &am"
    assert H.main_text("<p>a<b>b</p><p>c</b>d") == "ab\n\ncd"
    assert H.main_text("<p>a</p><p>cut <a href='x") == "a\n\ncut"
    assert H.main_text("<div>a < b</div><!-- open <p>x</p>") == "a < b"
    assert H.main_text("<table><tr><td>1<td>2<tr><td>3</table>") == "1\n\n2\n\n3"
    assert H.main_text("<p>x</p><script>never closed <p>y</p>") == "x"


def page(i, extra=""):
    return (f"<html><body><div><span>Welcome to the site</span></div><div><p>Article {i} says {i * i}.</p><p>Read more soon</p>{extra}</div>"
            f"<div><i>Visits {i}</i></div></body></html>")


def test_template_text_goes(spark):
    rows = [(i, f"http://h.com/{i}", page(i), 1) for i in range(20)] + [(50 + i, f"http://few.com/{i}", page(i), 1) for i in range(2)]
    rows += [(90, None, None, 1), (91, "nohost", "", 1), (None, "http://h.com/x", page(3), 1), (1, "http://h.com/1", page(1), 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    got = H.extract(df).collect()
    assert len(got) == len(rows)
    texts = {r.page_id: r.text for r in got}
    assert texts[4] == "Article 4 says 16.\n\nVisits 4" and texts[None] == "Article 3 says 9.\n\nVisits 3"
    assert texts[50] == "Welcome to the site\n\nArticle 0 says 0.\n\nRead more soon\n\nVisits 0"
    assert texts[90] == texts[91] == "" and all(r.n_chars == len(r.text) for r in got)
    assert H.extract(df.limit(0)).collect() == []


def test_valid_classes():
    # Tokens 1..4 in order are valid; 5 and 6 cross them out of order.
    order = {t: t for t in range(1, 9)}
    of = {1: 0, 2: 0, 3: 0, 4: 0, 5: 1, 6: 1, 7: 2, 8: 2}
    assert H.valid_classes([1, 7, 8, 7, 8, 2, 3, 4], order, of) == {0, 2}
    assert H.valid_classes([1, 6, 2, 5, 3, 4], order, of) == {0}
    assert 1 not in H.valid_classes([1, 5, 2, 3, 6, 4], order, of)


def test_query(spark):
    assert matches(spark, "op1_html_extraction", "/root/testdata/sf0.01")


def test_names_of_wrappers_and_slugs():
    for wrap in ("content-sidebar-wrap", "layout has-sidebar", "page-with-header", "sidebar", "comments-open"):
        assert H.main_text(f'<div class="{wrap}"><main><article><h1>T</h1><p>Text</p></article></main></div><div class="menu">M</div>') == "T\n\nText"
        assert H.main_text(f'<form id="form"><div class="{wrap}"><article><p>Text</p></article></div></form><p>no</p>') == "Text"
    for wrap in ("content-sidebar-wrap", "layout has-sidebar", "page-with-header", "sidebar"):
        assert H.main_text(f'<div class="menu"><a href="/">A long list of places</a></div><div class="{wrap}"><p>Text one</p></div><p>More</p>') == "Text one\n\nMore"
    slugs = ('<article><h2 id="search">Search</h2><p>A</p><section id="related-work"><p>B</p></section><section id="legal-history"><p>C</p></section>'
             '<div class="entry-header"><h1>D</h1></div><p>E <math><mi>x</mi><mo>=</mo><annotation>tex</annotation></math></p></article>')
    assert H.main_text(slugs) == "Search\n\nA\n\nB\n\nC\n\nD\n\nE x="
    # What is no article stays out, however long it is.
    for name in ("comments", "cookie-notice", "ad", "site-ads"):
        assert H.main_text(f'<div><p>Text</p></div><div class="{name}"><p>{"long " * 50}</p></div>') == "Text"
    assert H.main_text('<article><p>Text</p></article><section id="comments"><article>A long reader comment</article></section>') == "Text"
    assert H.main_text('<p>Text of the page</p><div class="site-nav">Menu</div><div id="sidebar-left">Side</div>') == "Text of the page"


def test_copies_are_no_template(spark):
    same = "<html><body><ul>" + "<li><a>m</a>" * 3 + "</ul><div>" + "".join(f"<p>Paragraph {k} of it.</p>" for k in range(6)) + "</div></body></html>"
    whole = H.main_text(same)
    intro = "".join(f"<p>Introduction {k}.</p>" for k in range(5))
    part = "<html><body><div class='x'><p>Welcome here</p></div><div class='y'>%s<p>Own text %d</p></div></body></html>"
    rows = [(f"{n}.com", i, same) for n in (9, 10, 1000) for i in range(n)]
    # A third copies of one page; four in ten with the same introduction.
    rows += [("third.com", i, same if i % 3 == 0 else page(i)) for i in range(60)]
    rows += [("intro.com", i, part % (intro if i % 10 < 4 else "", i)) for i in range(50)]
    rows += [("slot.com", i, f"<html><body><div><b>Welcome here</b></div><article>{intro}<p>Own text {i}</p></article></body></html>") for i in range(20)]
    # Copies that differ in what isn't shown.
    rows += [("nonce.com", i, same.replace("<ul>", f"<script>n={i}</script><ul>")) for i in range(30)]
    df = spark.createDataFrame([(i, f"http://{h}/{i}", t) for h, i, t in rows], "page_id long, url string, html string")
    got = H.extract(df).collect()
    assert len(got) == len(rows)
    by: dict = {}
    for r in got:
        by.setdefault(r.url.split("/")[2], {})[r.page_id] = r.text
    assert whole.count("Paragraph") == 6
    for h in ("9.com", "10.com", "1000.com", "nonce.com"):
        assert set(by[h].values()) == {whole}, h
    assert by["third.com"][3] == whole and by["third.com"][4] == "Article 4 says 16.\n\nVisits 4"
    assert by["intro.com"][3] == "\n\n".join([f"Introduction {k}." for k in range(5)] + ["Own text 3"])
    assert by["slot.com"][3] == "\n\n".join([f"Introduction {k}." for k in range(5)] + ["Own text 3"])


def test_empty_article_stays_empty(spark):
    rows = [(i, f"http://h.com/{i}", f"<html><body><div><b>Welcome here</b><i>to us</i></div><article>{f'<p>Own {i}</p>' if i else ''}</article></body></html>") for i in range(20)]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == "" and got[5] == "Own 5"
