import re

import html as entities

from lopside.llm import pages
from lopside.llm.queries import QUERIES

RICH = """<html><head><title>T</title><script>var x="<p>no</p>";</script></head><body class="home">
<header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div class="cookie-notice"><p>We use cookies, many of them, all day long.</p></div>
<div id="wrap"><div class="post-{n}"><h1>Title &amp; more</h1><p>First&nbsp;part
 of a <b>long</b> paragraph with words {n}.<p>Second &lt;part&gt; goes on<br>and on, &quot;quoted&quot;.</p><ul><li>one</li><li>two</ul>
<div class="ad"><p>Buy now, buy a lot, buy everything that we have to sell today.</p></div>
<form><p>Your mail here please and press the button</p><input name=a><button>Send</button></form>
<section class="comments"><p>A reader says that this was a very long and interesting text, thank you so much.</p></section></div>
<aside><p>Sidebar words, quite a few of them, but not the article.</p></aside></div><footer><p>&copy; footer</p></footer></body></html>"""
WANT = 'Title & more\nFirst part of a long paragraph with words {n}.\nSecond <part> goes on and on, "quoted".\none\ntwo'


def test_rich_page_and_odd_rows(spark):
    rows = [(i, f"https://a.example/{i}", RICH.replace("{n}", str(i))) for i in range(30)]
    rows += [(100, None, None), (101, "https://a.example/x", ""), (102, "u", "plain words, no tags"), (103, "https://b.example/", "<div"),
             (104, "https://b.example/2", "<article><p>x &am"), (30, "https://a.example/0", RICH.replace("{n}", "0")),
             (105, "https://c.example/", "<body><div><p>" + "word " * 100000 + "<!-- open")]
    df = spark.createDataFrame([(*r, "old", 1) for r in rows], "page_id long, url string, html string, text string, path int")
    got = {r.page_id: r.text for r in pages.main_text(df).collect()}
    assert all(got[i] == WANT.replace("{n}", str(i)) for i in range(30))
    assert got[100] == got[101] == got[103] == "" and got[102] == "plain words, no tags" and got[104] == "x &am"
    assert got[30] == got[0] and got[105] == ("word " * 100000).strip()
    assert pages.main_text(df.limit(0)).count() == 0


def test_consensus_overrules_a_page(spark):
    long = "<div class=other><p>" + "noise " * 80 + "</p></div>"
    page = "<body><div class=story><p>" + "real words here " * 20 + "</p></div>{}</body>"
    rows = [(i, "http://h.example/", page.format("")) for i in range(9)] + [(9, "http://h.example/", page.format(long))]
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[9] == got[0]


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    html = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = QUERIES["op2_pages"](spark, folder).collect()
    assert len(rows) == len(html)
    for r in rows:  # these pages have one article each: its blocks, read another way
        body = re.split(r"</article>|<footer>", html[r.page_id].split("<article>")[1])[0]
        body = re.sub(r"<[^<>]*$", "", body)
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]+>", " " if False else "", re.sub(r"<br>", " ", b))).split())
                  for b in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def text_of(page):
    return pages.extract(pages.blocks(pages.parse(page)), None)


def test_a_class_word_does_not_outweigh_an_article():
    article = "<h1>Title</h1>" + "".join(f"<p>Paragraph {k} of the story, with some words in it.</p>" for k in range(6))
    want = "Title\n" + "\n".join(f"Paragraph {k} of the story, with some words in it." for k in range(6))
    rest = "<nav><a href=/>Home</a></nav><div class=sidebar><p>Other stories that you may like, of all kinds.</p></div>"
    for name in ("content has-sidebar", "post no-ads", "entry with-comments", "story legal", "more", "article-tags", "form", "page-sidebar", "post comments-open"):
        page = f"<body>{rest}<div class='{name}'>{article}</div><div class=footer><p>All rights are reserved here.</p></div></body>"
        assert text_of(page) == want, name
        assert text_of(f"<body>{rest}<article>{article.replace('<p>', f'<p class={name.split()[-1]!r}>', 1)}</article></body>") == want or (
            name == "page-sidebar"), name
    assert text_of(f"<form id=aspnet>{rest}<div class=x>{article}</div></form>") == want


def test_headers_formulas_and_comments_of_an_article():
    assert text_of("<article><div class=entry-header><h1>Title</h1></div><p>Words of it.</p></article>") == "Title\nWords of it."
    assert text_of("<div class=entry><div class=entry-header><h1>Title</h1></div><p>Words of it.</p></div>") == "Title\nWords of it."
    assert text_of("<article><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>") == "So x=2 holds."
    assert text_of("<article><p>Before <svg><path d=x> after it.</p><video src=y><p>More words.</p></article>") == "Before after it.\nMore words."
    assert text_of("<article><p>In <svg><text>no</text></svg>side.</p></article>") == "In side."
    talk = "".join(f"<p>Reader {k} says a lot more than the article itself does, on and on.</p>" for k in range(40))
    for name in ("comments", "comment-list", "user-comments"):
        assert text_of(f"<body><div class=post><p>A short article.</p></div><section class='{name}'>{talk}</section></body>") == "A short article."
    assert text_of("<body><div class=ad><p>Buy it now, buy all of it.</p></div></body>") == ""


def test_deep_pages_and_clashing_columns(spark):
    deep = "<div>" * 10_000 + "<p>Deep words.</p>" + "</div>" * 10_000 + "<p>After.</p>"
    stairs = "".join(f"<div><p>Step {k}.</p>" for k in range(1500))
    html = {0: deep, 1: stairs}
    df = spark.createDataFrame([(k, "u", h, "a", 7, "p") for k, h in html.items()],
                               "page_id long, url string, html string, _host string, _salt int, _path string")
    out = {r.page_id: r for r in pages.main_text(df).collect()}
    assert "Deep words." in out[0].text and "Step 1499." in out[1].text
    assert all((r["_host"], r["_salt"], r["_path"]) == ("a", 7, "p") for r in out.values())
