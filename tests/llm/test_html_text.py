"""Page text: known pages, and minimum cuts against all labellings."""

import itertools
import random
import re

from areacube.llm import html_text as H

SF = "/root/testdata/sf0.01"


def cost(pref, edges, label):
    return sum(max(0, -p) if k else max(0, p) for p, k in zip(pref, label)) + sum(w for i, j, w in edges if label[i] != label[j])


def test_minimum_cut_against_all_labellings():
    rng = random.Random(0)
    for _ in range(150):
        n = rng.randint(1, 9)
        pref = [rng.uniform(-2, 2) for _ in range(n)]
        edges = [(i, j, rng.uniform(0, 2)) for i in range(n) for j in range(i) if rng.random() < 0.5]
        best = min(cost(pref, edges, k) for k in itertools.product([True, False], repeat=n))
        assert abs(cost(pref, edges, H.minimum_cut(pref, edges)) - best) < 1e-9


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{x}</style><script>var a="</p><p>no</p>";</script></head><body>
<header class="site-header"><a href="/">Home</a> Big Site Name</header><nav><ul><li><a href=x>One</a><li><a href=y>Two</a></ul></nav>
<div class="cookie-notice">We use cookies. Accept them all, they are tasty and good for you.</div><!-- <p>hidden</p> -->
<div class="ad">Buy this thing now, it is really cheap and good.</div>
<article><header><h1>A   title&nbsp;here</h1></header><p><b>First &lt;b&gt;<br>para.<p>Second para &eacute;&#233;.</p><p>Ok.</p>
<aside>See also: other things that you may like to read now.</aside><figure><figcaption>A caption.</figcaption></figure>
<div class="newsletter"><form><input>Mail <button>Go</button></form></div><ul><li>Point one.</li><li>Point <a href=z>two</a>.</li></ul>
<section id="comments"><h2>Comments</h2><p>Great text, I read it twice and told all my friends.</p></section>
<footer>By someone.</footer></article>
<div id="sidebar"><h3>Popular</h3><p>A long sidebar text that has many words and ends like a sentence.</p></div>
<footer>&copy; 2020 Site. All rights reserved by the owner of the site.</footer></body></html>"""


def test_page_with_everything():
    assert H.main_text(PAGE).split("\n") == ["A title here", "First <b> para.", "Second para éé.", "Ok.", "A caption.", "Point one.", "Point two."]


def test_page_without_article():
    text = " ".join(f"word{i}" for i in range(40)) + "."
    page = f"<body><div><a href=1>a</a> <a href=2>b</a></div><div><p>{text}</p><p>{text}</p><p>Short one here.</p><p>{text}</p></div><div>x</div>"
    assert H.main_text(page).split("\n") == [text, text, "Short one here.", text]


def test_broken_pages():
    assert H.main_text("") == ""
    for page in ("<article><p>Some words of a text.", "<article><p>Some words of a text.</p><script>x", "<article><p>Some words of a text.</p><!-- x",
                 "<article><p>Some words of a text.</p><a href='", "<ARTICLE><P>Some words\n\t of a text.</P><p></p>"):
        assert H.main_text(page) == "Some words of a text.", page
    assert H.main_text("<article><p>Some words of a text &am") == "Some words of a text &am"
    assert H.main_text("<article>" + "<p>a b c d." * 20000).count("\n") == 19999
    assert len(H.main_text("<article>" + "<div>" * 3000 + "deep text here.")) == 15
    H.main_text("<a " + "'\"" * 20000)


def test_pages_table(spark):
    """The article's headings and paragraphs, read off the pages' own markup."""
    import html
    rows = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in H.extract(rows).collect()}
    for r in rows.collect():
        inner = r.html.split("<article>", 1)[1].split("</article>")[0]
        want = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " ", x))).strip() for x in re.split(r"</h1>|<p>|</p>", inner)]
        assert got[r.page_id] == "\n".join(x for x in want if x), r.page_id


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, None, 5), (1, "u", "", 5), (None, "u", "<article><p>Text of it.</p>", 5)], "page_id long, url string, html string, n_chars int")
    got = sorted((tuple(r) for r in H.extract(df).collect()), key=str)
    assert got == sorted([(1, None, "", 0), (1, "u", "", 0), (None, "u", "Text of it.", 11)], key=str)
    assert H.extract(df.limit(0)).collect() == []
