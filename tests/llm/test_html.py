"""Site style tree extraction on pages written out by hand."""

import math
from collections import Counter, defaultdict

import pytest

from trisk.llm import style_tree
from trisk.llm.style_tree import Page, extract

PAGES = [
    ("<article><h1>A &amp; B</h1><p>one\n two<br>three<p>fo<b>ur</b></article>", "A & B one two three four"),
    ("<nav>menu</nav><header>site</header><div class='ad'>buy</div><article>text</article><footer>x</footer>", "text"),
    ("<body><div id=content><p>kept</p><div class='cookie-notice'>no</div></div><aside>no</aside></body>", "kept"),
    ("<article><header><h1>Title</h1></header><p>a</p><form>f<input></form><section class=comments>c</section>"
     "</article>", "Title a"),
    ("<script>var t='</p><article>no</article>'</script><main>yes<style>p{}</style></main>", "yes"),
    ("<article>a<!-- <p>no</p> -->b<!-- open", "ab"),
    ("<article><p>unclosed <b>bold<p>next</article><p>outside", "unclosed bold next"),
    ("<p title='a>b'>x</p><a href=\"y>z\">l</a>", "x l"),
    ("<article>1 &lt; 2 &eacute;&#233;&nbsp;&copy;</article>", "1 < 2 éé ©"),
    ("</div></p>stray<ul><li>one<li>two</ul>", "stray one two"),
    ("plain text, no markup", "plain text, no markup"), ("", ""), ("<", "<"), ("<article>", ""), ("\x00", "\x00"),
    ("<article><script>never closed <p>x", ""), ("<article class=comment>c</article><p>body</p>", "body"),
]


@pytest.mark.parametrize("source, text", PAGES)
def test_text_of_a_page(source, text):
    assert Page(source).text() == text


CLASSED = [
    ("<html class='has-menu'><body class='page no-sidebar comments-closed'><article>a</article></body></html>", "a"),
    ("<body class='comments'><div class=menu>m</div><p>kept</p></body>", "kept"),
    ("<article class='post has-comments'><p>a</p><div class='post-comments'>c</div></article>", "a"),
    ("<main class='with-menu' id=search><p>a</p></main>", "a"), ("<div class='no-sidebar'><p>a</p></div>", "a"),
    ("<div class='layout sidebar'><main><p>a</p></main></div>", "a"), ("<div id='left-sidebar'><article>a</article></div>", "a"),
    ("<div class='left-sidebar'><article>teaser</article></div><article>a</article>", "a"),
    ("<div class='comments'><article>c</article></div><p>a</p>", "a"),
    ("<div class='social-history'>a</div><div class=social>s</div><div class='top-menu'>m</div>", "a"),
]


@pytest.mark.parametrize("source, text", CLASSED)
def test_names_of_pages_and_articles_are_no_noise(source, text):
    assert Page(source).text() == text


def site(n, host="site.example"):
    """Pages of one template: every page has the same box in its article, and its own text."""
    return [(k, f"http://{host}/p{k}", f"<html><body><article><h1>T{k}</h1><div class=box>Written by our <i>staff</i>"
             f"</div><p>Own words {k} {'xyz' * (k % 4)}</p><p>common</p></article></body></html>") for k in range(n)]


def texts(spark, rows):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {(r.page_id, r.url): r.text for r in extract(frame).collect()}


def test_low_importance_branches_are_cut(spark):
    got = texts(spark, site(20))
    assert got[3, "http://site.example/p3"] == "T3 Own words 3 xyzxyzxyz common"


def classless(k, host):
    """A page without names or kinds: menu, notice, body of k paragraphs, optional box, footer."""
    body = "".join(f"<p>Paragraph {k} {j} of {host}</p>" for j in range(1 + k % 4))
    extra = "<div><span>see also</span></div>" if k % 2 else ""
    return (f"<html><body><div><b>Home</b> <i>About</i> Contact us</div><div>We use small files</div><div><h1>Title {k}</h1>"
            f"{body}</div>{extra}<div>All prices in dollars <b>Imprint</b></div></body></html>",
            f"Title {k} " + " ".join(f"Paragraph {k} {j} of {host}" for j in range(1 + k % 4)))


@pytest.mark.parametrize("n", [5, 40])
def test_places_without_names_go_by_importance_alone(spark, n):
    pages = [classless(k, "h.example") for k in range(n)]
    got = texts(spark, [(k, f"http://h.example/{k}", html) for k, (html, _) in enumerate(pages)])
    for k, (_, body) in enumerate(pages):
        text = got[k, f"http://h.example/{k}"]
        # The box of every other page comes last but one: a place that few pages share on a small host.
        assert text.replace(" see also", "") == body, k
        assert n < 40 or text == body


def test_two_pages_are_no_evidence_and_own_text_stays(spark):
    two = [classless(k, "two.example")[0] for k in range(2)]
    got = texts(spark, [(k, "http://two.example/", html) for k, html in enumerate(two)])
    assert all(t.startswith("Home About Contact us") for t in got.values())
    # One page of forty has an article of its own where the others have their notice.
    rows = [(k, "http://own.example/", classless(k, "own.example")[0]) for k in range(40)]
    rows[7] = (7, "http://own.example/", rows[7][2].replace("We use small files", "A text that is here alone"))
    got = texts(spark, rows)
    assert got[7, "http://own.example/"].startswith("A text that is here alone Title 7")
    assert got[8, "http://own.example/"].startswith("Title 8")


def test_pages_that_differ_in_markup_alone_count_once(spark):
    rows = [(k, "http://same.example/", f"<body><div data-token={k}>Whole text</div><script>{k}</script></body>") for k in range(30)]
    assert set(texts(spark, rows).values()) == {"Whole text"}


def test_importance_equals_plain_entropy(spark):
    rows = [(1, classless(k, "e.example")[0]) for k in range(12)] + [(2, row[2]) for row in site(15)] + [(3, site(1)[0][2])]
    rows += rows[:5]
    pages = defaultdict(dict)
    for host, html in rows:
        features = Page(html).features()
        pages[host][features[0][0]] = features
    plain = {}
    for host, by_page in pages.items():
        kinds = defaultdict(lambda: (Counter(), Counter()))
        for features in by_page.values():
            for _, node, main, kind, value in features:
                kinds[node, main][kind][value] += 1
        for (node, main), (styles, contents) in kinds.items():
            m = sum(styles.values())
            assert m == sum(contents.values())
            if m > 1:
                presentation = -sum(c / m * math.log(c / m, m) for c in styles.values())
                content = 1 - sum(c / m * math.log(c, m) for c in contents.values())
                weight = 0.9 ** len(styles)
                measured = (1 - weight) * presentation + weight * content
            else:
                measured = 1.0
            first, pages_of_prior = (1.0, 2.0) if main else (0.5, 1.0)
            plain[host, node] = m, measured, (first * pages_of_prior + (m - 1) * measured) / (pages_of_prior + m - 1)
    frame = spark.createDataFrame(rows, "host long, html string")
    found = style_tree.node_importance(style_tree.value_counts(style_tree.page_features(frame))).collect()
    assert len(found) == len(plain)
    for r in found:
        m, measured, importance = plain[r.host, r.node]
        assert r.n_pages == m and abs(r.measured - measured) < 1e-9 and abs(r.importance - importance) < 1e-9
    assert {r.importance < style_tree.MIN_IMPORTANCE for r in found} == {True, False}


def test_few_pages_and_copies_are_no_evidence(spark):
    assert "Written by" in texts(spark, site(4))[0, "http://site.example/p0"]
    one = site(1)[0][2]
    got = texts(spark, [(k, "http://copy.example/", one) for k in range(30)] + [(99, None, one)])
    assert len(set(got.values())) == 1 and "Written by our staff" in got[99, None]


def test_awkward_pages(spark):
    rows = [(1, None, None), (1, None, None), (None, "x", ""), (2, "http://h/", "<p>" + "word " * 100_000),
            (3, "http://h/", "<div>" * 3000 + "deep"), (4, "http://U:p@H:80/x", "<b>x</b>")]
    frame = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows],
                                  "page_id long, url string, html string, host string, cut long, text long")
    got = extract(frame).collect()
    assert len(got) == len(rows) and got[0].n_chars == len(got[0].text)
    assert {(r.page_id, r.n_chars) for r in got} == {(1, 0), (None, 0), (2, 499_999), (3, 4), (4, 1)}
    assert extract(frame.filter("page_id < 0")).collect() == []


def test_articles_of_the_table(spark):
    import html
    import re
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        plain = re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", body))
        assert got[r.page_id] == " ".join(html.unescape(plain).split())
