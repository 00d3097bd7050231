"""Main texts of pages: planted articles, and template counts against a plain count."""

from collections import defaultdict

import pandas as pd
from hard_rows import prose
from pyspark.sql import functions as F

from tidemark.llm.page_text import page_texts, parse

SCHEMA = "page_id long, url string, html string, text string, host string, key string, e string"


def kept(source):
    page = parse(source)
    return [b for b, m in zip(page.blocks, page.marked) if not m]


def run(spark, pages, **more):
    rows = [(i, url, source, "t", "h", "k", "e") for i, url, source in pages]
    out = page_texts(spark.createDataFrame(rows, SCHEMA).repartition(3), **more)
    return out.select("row.page_id", "text", "n_blocks", "n_template", "n_marked").toPandas()


def paragraphs(i):
    return [prose(100 * i + j, 25).replace("\n", " ").replace("  ", " ").strip() for j in range(4)]


def plain_site(i, body):
    """A page without any telling tag or name: only what recurs tells the template."""
    bar = "<div><div>Start</div><div>All about our little shop</div></div>"
    side = f"<div><p>Latest offer number {i % 3}</p><div>Write to us any time</div></div>"
    return f"<html><body>{bar}<div><h1>Title {i}</h1>{''.join(f'<p>{p}</p>' for p in body)}</div>{side}<div>Made with care since 1999</div></body></html>"


def test_what_a_site_repeats_goes(spark):
    pages = [(i, f"https://Shop.example.com:80/{i}", plain_site(i, paragraphs(i))) for i in range(20)]
    pages += [(100 + i, "http://shop.example.com/x", plain_site(50 + i, paragraphs(50))) for i in range(30)]  # copies of one article
    pages += [(200 + i, f"http://small.example.com/{i}", plain_site(i, paragraphs(60 + i))) for i in range(2)]  # too few to tell
    pages += [(300 + i, None, plain_site(i, paragraphs(70 + i))) for i in range(8)]
    out = run(spark, pages).set_index("page_id")
    assert len(out) == len(pages)
    for i in range(20):
        assert out.loc[i, "text"] == "\n".join([f"Title {i}", *paragraphs(i)]) and out.loc[i, "n_template"] == 5
    for i in range(30):
        assert out.loc[100 + i, "text"] == "\n".join([f"Title {50 + i}", *paragraphs(50)])
    for i in (200, 201, 300, 307):
        assert "Made with care" in out.loc[i, "text"] and out.loc[i, "n_template"] == 0


def test_counts_equal_plain(spark):
    pages = [(i, f"http://h{i % 2}.example/", plain_site(i, paragraphs(i % 9))) for i in range(40)]
    parsed = {i: parse(source) for i, _, source in pages}
    holders = defaultdict(lambda: defaultdict(set))
    for i, page in parsed.items():
        for h, _, _ in page.elements:
            holders[i % 2, h][page.key].add(i)
    expected = {}
    for i, page in parsed.items():
        gone = {b for h, a, z in page.elements for b in range(a, z)
                if len(k := holders[i % 2, h]) >= 5 and len(k) >= 0.25 * sum(map(len, k.values()))}
        expected[i] = "\n".join(t for b, t in enumerate(page.blocks) if b not in gone and not page.marked[b])
    out = run(spark, pages)
    assert dict(zip(out["page_id"], out["text"])) == expected


ARTICLE = """<!DOCTYPE html><html><head><title>Not text</title><style>p{}</style><script>var t="</p>";if (a<b) {}</script></head>
<body class="has-sidebar"><header><a href="/">Home</a></header><nav><ul><li><a href=x>One</a><li><a href=y>Two</a></ul></nav>
<div id="cookie-consent">We use cookies</div><main><article class="post"><header><h1>The  head&shy;line</h1><span>by someone</span></header>
<p>First <b>bold &amp; <i>bright</i></b>,&nbsp;and&#160;so
on<br>after a break<p>Second &lt;tag&gt; caf&eacute; 5 < 6
<ul><li>one<li>two <a href=z>linked</a></ul><table><tr><td>a<td>b<tr><td>c</table><blockquote>said</blockquote>
<aside>Aside</aside><div class="related-posts"><a href=1>Other</a></div><form><label>Your mail</label><input></form>
<script>document.write("<p>no</p>")</script><!-- <p>no comment</p> --><pre>x
  y</pre><footer>Posted on Monday</footer></article>
<section id="comments"><article class="comment"><p>Nice!</p></article></section></main>
<div class="sidebar"><p>Side</p></div><div><a href=1>a</a> <a href=2>b</a> <a href=3>c</a></div><div hidden>secret</div>
<div role="contentinfo">Imprint</div><footer>&copy; all</footer></body></html>"""


def test_an_article_by_its_tags():
    assert kept(ARTICLE) == ["The head\xadline", "First bold & bright, and so on after a break", "Second <tag> café 5 < 6", "one", "two linked", "a", "b",
                             "c", "said", "x y"]


def test_articles_without_tags_of_their_own():
    assert kept("just words") == ["just words"]
    assert kept("<p>a<p>b<div>c</div>d</p>e") == ["a", "b", "c", "d", "e"]
    assert kept("<div class='content sidebar-left'><article>text</article></div>") == ["text"]
    assert kept("<article><p>one</p></article><article><p>two</p></article><p>three</p>") == ["one", "two", "three"]
    assert kept("<form id=page><main>all in a form</main></form>") == ["all in a form"]
    assert kept("<article class=comment>x</article><p>text</p>") == ["text"]
    assert kept("<nav>menu<p>more</nav>text") == ["text"]
    assert kept("a<script>never closed <p>b</p>") == ["a"]
    assert kept("a<textarea><p>b</textarea>c") == ["ac"]
    assert kept("<a b='x>y' \">text") == ["text"] and kept("<p title=\"a>b\" x='>'>text <b") == ["text"]
    assert kept("x <3 y </ z> <1> & &copy &unknown;") == ["x <3 y <1> & © &unknown;"]
    assert kept("") == [] and kept("<div> \n </div>") == []


def test_hard_rows(spark):
    long = "<div>" * 3000 + "<p>deep " + "word " * 50_000 + "</p>" + "</span>" * 3000
    bad = [(1, "http://h.example/", None), (2, None, ""), (None, "no host", "<p>x"), (4, "http://h.example/", long), (5, "", "<" * 20_000),
           (6, "http://h.example/", "<a '" * 20_000), (7, "http://h.example/", "&#xD800; &#0; \x00 ok")]
    out = run(spark, bad + [bad[3]] * 2).sort_values("page_id")
    texts = dict(zip(out["page_id"].fillna(-1).astype(int), out["text"]))
    assert len(out) == 9 and texts[1] == texts[2] == "" and texts[-1] == "x" and texts[4].startswith("deep word") and len(texts[4]) == 250_004
    assert texts[5] == "<" * 20_000 and texts[7].endswith("ok")
    assert run(spark, []).empty
    cols = page_texts(spark.createDataFrame([(1, "u", "<p>a", "t", "h", "k", "e")], SCHEMA)).select("row.*", "text").columns
    assert cols == ["page_id", "url", "html", "text", "host", "key", "e", "text"]


def test_repeated_paragraphs_of_articles_stay(spark):
    shared = "This notice stands in very many articles and is a part of each of them."
    page = "<html><body><div class=w><article><h1>{0}</h1><p>" + shared + "</p><p>{1}</p><div>Share this story with your friends</div></article></div></body></html>"
    pages = [(i, "http://h.example/", page.format(f"Title {i}", paragraphs(i)[0])) for i in range(12)]
    out = run(spark, pages)
    assert set(out["text"]) == {f"Title {i}\n{shared}\n{paragraphs(i)[0]}" for i in range(12)} and set(out["n_template"]) == {1}


def test_the_given_shape(spark, tables):
    pages = spark.read.parquet(f"{tables}/pages.parquet")
    out = page_texts(pages, columns=["page_id"]).select(F.col("row.page_id").alias("p"), "text").toPandas()
    assert len(out) == pages.count() and isinstance(out, pd.DataFrame) and (out["text"].str.len() > 0).sum() >= 42
