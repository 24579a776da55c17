import random

import pytest

from threadloom.llm import html_text as ht


@pytest.fixture(scope="module")
def pages(spark):
    def build(*rows):
        return spark.createDataFrame([(*r, "x", "y") for r in rows],
                                     "page_id long, url string, html string, host string, code string")

    return build


def texts(frame):
    return {r.page_id: r.text for r in ht.main_text(frame).collect()}


def test_site_templates_without_telling_names_are_removed(pages):
    rng = random.Random(1)
    rows = []
    for i in range(24):
        host = "a.example" if i % 2 else "b.example"
        body = " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(30))
        rows.append((i, f"https://{host}/p{i}",
                     f"<html><body><div class=x7><b>{host}</b> welcome</div><div><p>{body}</p>"
                     f"<div>extra {i}</div></div><div>end of {host}</div></body></html>"))
    got = texts(pages(*rows))
    for i, _, source in rows:
        body = source.split("<p>")[1].split("</p>")[0]
        assert got[i] == f"{body}\nextra {i}"


def test_copies_of_a_page_are_no_template(pages):
    same = "<body><div>the very same text of a page that has been copied</div></body>"
    rows = [(i, "http://c.example/" + str(i), same) for i in range(30)]
    rows += [(100 + i, "http://c.example/o", f"<body><div>other text {i}</div></body>")
             for i in range(3)]
    got = texts(pages(*rows))
    assert all(got[i] == "the very same text of a page that has been copied" for i in range(30))


def test_paragraphs_quoted_by_many_pages_stay(pages):
    rows = [(i, "http://d.example/", f"<article><h1>t{i}</h1><p>quoted by all</p><p>own {i}</p>"
             "<div>read on</div></article>") for i in range(12)]
    assert texts(pages(*rows)) == {i: f"t{i}\nquoted by all\nown {i}" for i in range(12)}


def test_parts_without_main_text_go_by_their_meaning(pages):
    source = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
    <header>Site</header><nav><a href=x>menu</a></nav><div id="cookie-notice">cookies</div>
    <main><article><h1>Head &amp; line</h1><p>One  two
    three<p>Four <b>five</b><br>six<ul><li>a<li>b</ul><aside>side</aside>
    <form><input value=q>mail</form><script>var t="</p>";</script><!-- no -->
    <div class="ad">buy</div><pre>x &lt; y</pre></article>
    <section class="comments"><article class="comment">reader</article></section></main>
    <div class=sidebar>bar</div><footer>&copy; foot</footer>"""
    assert texts(pages((1, "http://e.example", source))) == {
        1: "Head & line\nOne two three\nFour five six\na\nb\nx < y"}


def test_names_of_text_blocks_and_cards_do_not_hide_an_article(pages):
    card = "<article class=card>teaser</article>"
    rows = [
        (1, "u", f"<body><main><p>text of the page</p>{card}</main>"),
        (2, "u", "<article><h2 id='search'>Search</h2><p class='share'>Share prices rose.</p>"
                 "<section id='related-work'>Others</section><div id='related-posts'>more</div>"
                 "<div class='share'>tell</div><section id='comments'>reader</section></article>"),
        (3, "u", "<main><p>intro</p><article class='post'>the longer text of the article</article>"
                 "</main>"),
        (4, "u", "<main><p>a text that is longer than its parts</p><article>part</article></main>"),
        (5, "u", f"<main><p>a text that is longer</p></main>{card}"),
        (6, "u", "<main class='ad'><article>inside</article></main><article>own</article>"),
        (7, "u", "<p class='share'>outside</p><p>text</p>"),
    ]
    assert texts(pages(*rows)) == {
        1: "text of the page", 2: "Search\nShare prices rose.\nOthers",
        3: "the longer text of the article", 4: "a text that is longer than its parts\npart",
        5: "a text that is longer", 6: "own", 7: "text"}


def test_tolerant_parsing(pages):
    rows = [(1, None, None), (2, "u", ""), (3, "http://f/", "plain & text &eacute; < 5"),
            (4, "http://f/", "<p>a<p>b</div></p><b>c"), (5, "http://f/", "<p title='>'>x</p"),
            (6, "http://f/", "<p class=\"a>b</p>c"), (7, "::", "<![CDATA[k]]><x-y>z</x-y>"),
            (8, "http://f/", "<script>never closed"), (9, "u", "<p>" * 5000 + "deep" + "<div>" * 5000),
            (9, "u", "<p>" * 5000 + "deep" + "<div>" * 5000), (None, None, "<p>n</p>")]
    frame = ht.main_text(pages(*rows)).collect()
    got = {r.page_id: r.text for r in frame}
    assert len(frame) == len(rows) and all(r.n_chars == len(r.text) for r in frame)
    assert (got[1], got[2], got[3]) == ("", "", "plain & text é < 5")
    assert (got[4], got[7], got[8], got[9], got[None]) == ("a\nb\nc", "kz", "", "deep", "n")
    assert {r.page_id: r.url for r in frame}[7] == "::"


def test_given_pages(spark, data_directory):
    frame = spark.read.parquet(f"{data_directory}/pages.parquet")
    sources = {r.page_id: r.html for r in frame.collect()}
    got = texts(frame)
    assert got.keys() == sources.keys()
    for key, source in sources.items():
        inside = source.split("<article>")[1].split("</article>")[0]
        blocks = inside.replace("<h1>", "<p>").replace("</h1>", "<p>").replace("</p>", "<p>")
        import html as entities
        import re
        wanted = [" ".join(entities.unescape(re.sub("<[^>]*>", " ", b)).split())
                  for b in blocks.split("<p>")]
        assert got[key] == "\n".join(w for w in wanted if w)


def test_empty_table(pages):
    assert texts(pages((1, "u", "x")).filter("false")) == {}
