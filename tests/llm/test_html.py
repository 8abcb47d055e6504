import pytest

from voltrail.llm import html_extract as H


def run(tree, row):
    while not isinstance(tree, bool):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def local(html):
    tree = H.grow(*H.labelled_table())
    found = H.blocks(html)
    return "\n\n".join(b.text for b, f in zip(found, H.features(found)) if run(tree, f))


PAGES = [
    ("<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><a href=x>Home</a></nav><div class='ad'>Buy this now</div><article><header><h1>Title</h1></header><p>One &lt;two&gt; a &amp;\n  b&nbsp;c</p><p>Go.</p><p>Hello<br>world <a href='x'>link</a> tail</p><aside>note</aside><form><p>sub</p></form><script>if (a<b) '</article>'</script><div class='comments'><p>nice one</p></div><p>Last</p></article><section id='comments'><p>reader words that are long enough to look like text</p></section><footer><p>c</p></footer></body></html>",
     "Title\n\nOne <two> a & b c\n\nGo.\n\nHello world link tail\n\nLast"),
    ("<article><h1>A</h1><p>only<p>unclosed <b>bold<p>end", "A\n\nonly\n\nunclosed bold\n\nend"),
    ("<nav><p>menu words here</p></nav><main><p>x</p><!-- <p>gone</p> --></main><div>outside words that go on for a while</div>", "x"),
    ("<ul><li><a href=x>One</a></li><li><a href=x>Two</a></li></ul><h1>Head of page</h1><p>" + "word " * 60 + "</p><p>" + "text " * 40 + "</p><div class='sidebar'><p>" + "side " * 50 + "</p></div>",
     "Head of page\n\n" + " ".join(["word"] * 60) + "\n\n" + " ".join(["text"] * 40)),
    ("", ""), (None, ""), ("<p", ""), ("<nav>only menu</nav>", ""),
    ("<article><p>a < b and 3 > 2 <unfinished 'quote</p>", "a < b and 3 > 2"),
]


@pytest.mark.parametrize("html,text", PAGES)
def test_article_text(html, text):
    assert local(html or "") == text


def test_tree_learns_the_labelled_pages():
    x, y = H.labelled_table()
    tree = H.grow(x, y)
    assert all(run(tree, r) == bool(v) for r, v in zip(x, y))
    assert H.FEATURES[tree[0]] in ("links", "words")


#: Labelled pages that the tree hasn't seen.
HELD_OUT = (
    H.menu(2, 1, 1, 5) + "<h1>+6</h1>" + H.text(58, 33, 8) + H.menu(4, sign="+") + H.text(71, 3) + H.menu(2, 4) + "<div>-6c</div>",
    H.menu(1, 1, 3, 2, 1) + H.text(110, 26) + H.menu(3, 7, 2, sign="+") + H.text(19, 44),
    "<h1>+4</h1>" + H.text(62) + "<h2>+3</h2>" + H.text(15, 87) + "<div class='comments-area'><p>-9</p><p>-28</p></div><div class='page-footer'>-13</div>",
    "<div class='top-menu'>-6</div><div class='content'><h1>+5</h1>" + H.text(48, 2, 66) + "</div><div class='sidebar-right'><p>-31</p></div>",
    "<div class='layout no-sidebar'><h1>+5</h1>" + H.text(48, 12, 66) + "</div>",
    "<nav>" + H.menu(2, 2) + "</nav><div class='page-with-sidebar'><main><h1>+2</h1>" + H.text(1, 4, 130, 1) + H.menu(1, 6, 3, sign="+") + "</main><div class='sidebar'>-40</div></div><footer>-8c</footer>",
    "<article><h1>+9</h1>" + H.text(27) + "<div class='adSlot'>-7</div>" + H.text(1, 95) + "<section class='search-engines'><h2>+2</h2>" + H.text(36, 3) + "</section><ol class='comment-list'><li>-12</li><li>-2</li></ol></article><p>-55</p>",
    "<div>-11</div><article>" + H.menu(5, 2, 8, sign="+") + "</article><div>-4</div>" + H.menu(1, 3),
)


def test_tree_is_right_on_pages_it_has_not_seen():
    tree = H.grow(*H.labelled_table())
    x, y = H.labelled_table(HELD_OUT)
    right = [run(tree, r) == bool(v) for r, v in zip(x, y)]
    assert sum(right) >= 0.97 * len(right), [(i, dict(zip(H.FEATURES, x[i])), y[i]) for i, r in enumerate(right) if not r]


A, B, C = (" ".join([w] * n) for w, n in (("alpha", 60), ("beta", 60), ("gamma", 25)))


@pytest.mark.parametrize("html,text", [
    (f"<p>{A}</p><ul><li><a href=x>See the full report here</a></li></ul><p>{B}</p>", [A, "See the full report here", B]),
    (f"<p>{A}</p><p><a href=x>Report</a></p><p>{B}</p><p>{C}</p>", [A, "Report", B, C]),
    (f"<p>{A}</p><ul><li><a href=x>One</a></li><li><a href=x>Two parts</a></li><li><a href=x>And three more</a></li></ul><p>{B}</p>", [A, "One", "Two parts", "And three more", B]),
    (f"<article><p>{A}</p><section class='search'><h2>Search</h2><p>{B}</p><p>{C}</p></section></article>", [A, "Search", B, C]),
    (f"<article><p>{A}</p><div class='ad-slot'>Buy one now</div><p>{B}</p><div class='comment-list'><p>Nice.</p><p>{C}</p></div><div class='cookie-banner'><p>We use cookies {C}</p></div></article>", [A, B]),
    (f"<div class='main-nav'><p>Home</p></div><p>{A}</p><p>{B}</p><div class='left-sidebar'><p>{C}</p></div><div class='footer-links'><a href=x>Terms</a> of use</div><div class='site-footer'><p>{C}</p></div>", [A, B]),
    (f"<p>{A}</p><p>{B}</p><div>Copyright 2024 Some Company</div>", [A, B]),
    (f"<article><h1>Copyright law</h1><p>{A}</p><p>Copyright lasts.</p></article>", ["Copyright law", A, "Copyright lasts."]),
    (f"<article><ul><li><a href=x>One</a></li><li><a href=x>Two</a></li></ul></article>", ["One", "Two"]),
    (f"<div class='blog has-sidebar'><p>{A}</p><p>{B}</p></div>", [A, B]),
])
def test_pages_without_telling_tags(html, text):
    assert local(html) == "\n\n".join(text)


def test_repeated_rows_and_a_very_long_page(spark):
    long = "<article>" + "".join(f"<p>paragraph {i} " + "word " * 30 + f"<a href=x>link {i}</a></p>" for i in range(30000)) + "</article><footer>end</footer>"
    rows = [(1, "u", long), (1, "u", long), (2, "v", "<p>x y z " + "w " * 50)]
    got = H.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert len(got) == 3 and got[0] == got[1]
    text = next(r["text"] for r in got if r["page_id"] == 1).split("\n\n")
    assert len(text) == 30000 and text[29999].startswith("paragraph 29999 word") and text[29999].endswith("link 29999")


def test_spark_condition_agrees_with_the_tree(spark):
    pages = spark.createDataFrame([(i, f"u{i}", h) for i, (h, _) in enumerate(PAGES)], "page_id bigint, url string, html string").selectExpr("*", "'x' as text", "1 as blocks", "2 as n_chars", "3 as kept")
    got = {r["page_id"]: r for r in H.extract(pages).collect()}
    for i, (_, text) in enumerate(PAGES):
        assert got[i]["text"] == text and got[i]["n_chars"] == len(text)
    assert H.extract(pages.limit(0)).count() == 0


def test_broken_markup_takes_linear_time():
    import time
    t0 = time.perf_counter()
    for h in ("<p>" + 'x"' * 100000 + '<a href="' + "y" * 100000, "<div>" * 30000, "<div><i a=b>" * 3000 + "</b>" * 50000):
        H.blocks(h)
    assert time.perf_counter() - t0 < 5


def test_given_pages_give_what_their_article_holds(spark):
    import html as escapes
    import re
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: r["text"] for r in H.extract(pages).collect()}
    for p in pages.collect():
        m = re.search(r"<article>(.*?)(</article>|$)", p["html"] or "", re.S)
        parts = re.split(r"</?(?:p|h1)>", m[1] if m else "")
        parts = [" ".join(escapes.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in parts]
        assert got[p["page_id"]] == "\n\n".join(x for x in parts if x)


@pytest.mark.parametrize("inner,text", [
    ("<h2 id='related-work'>Related work</h2>", "Related work"), ("<h3 id=\"search\">Search</h3>", "Search"), ("<ul><li id='notice'>An entry</li></ul>", "An entry"),
    ("<section class='share-prices'><p>Prices rose</p></section>", "Prices rose"), ("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding='t'>x\\eq 2</annotation></math> holds</p>", "so x=2 holds"),
    ("<div class='box comments'><p>gone</p></div>", ""), ("<h2 class='related'>gone</h2>", ""),
])
def test_topics_of_an_article_are_no_asides(inner, text):
    around = "<article><p>" + "word " * 40 + "</p>{}<p>" + "text " * 40 + "</p></article>"
    assert local(around.format(inner)) == "\n\n".join(x for x in (" ".join(["word"] * 40), text, " ".join(["text"] * 40)) if x)
