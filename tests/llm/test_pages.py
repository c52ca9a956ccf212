"""Wrappers and main text: constructed templates, and the given pages against a direct cut."""

import html
import re

from flowlake.llm import pages
from flowlake.llm.common import table
from tests.llm.helpers import CLASHING

SF = "/root/testdata/sf0.001"

ARTICLE = """<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header>Site</header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>Head &amp; tail</h1><p>One <b>bold</b> word&nbsp;here.<br>Next<p>Unclosed<ul><li>i1<li>i2</ul>
<div class="ad">Buy!</div><form><input value="x">Send</form></article>
<aside>Side</aside><div id="comments"><p>Reader says</p></div><footer>&copy; me</footer></body></html>"""


def text_of(page, others=()):
    wrapper = None
    for p in (page, *others):
        own = pages.pattern(pages.parse(p))
        wrapper = own if wrapper is None else pages.merge(wrapper, own)
    return pages.main_text(page, pages.judge(wrapper))


def test_article_without_furniture():
    assert text_of(ARTICLE) == "Head & tail One bold word here. Next Unclosed i1 i2"


def test_a_wrapper_covers_optional_and_repeated_groups():
    short = "<html><body><article><p>a</p></article></body></html>"
    long = "<html><body><article><h1>h</h1><p>a</p><p>b</p><h2>x</h2><p>c</p><h2>y</h2><p>d</p><table><tr><td>t</td></tr></table></article></body></html>"
    for page, want in ((short, "a"), (long, "h a b x c y d t")):
        assert text_of(page, (short, long, ARTICLE)) == want
    folded = pages.pattern(pages.parse(long))
    article = folded[3][0][3][0][3][0]
    # the run p h2 p h2 is one repeated group, before the last p
    assert [(c[0], c[1]) for c in article[3]] == [("h1", False), ("p", True), ("h2", True), ("p", False), ("table", False)]


def test_without_an_article_mark_template_text_and_links_go():
    def page(body):
        return (f"<html><body><div class='x'><p>Always the same words here</p></div><div class='y'><p>{body}</p><p>{body} again</p></div>"
                f"<div class='z'><a href='#'>link one</a> <a href='#'>link two {body[:3]}</a></div></body></html>")

    bodies = ["the first long story of this page " * 5, "another quite different text on it " * 5, "third body with words of its own " * 5]
    others = [page(b) for b in bodies]
    for b, p in zip(bodies, others):
        assert text_of(p, others) == " ".join(f"{b} {b} again".split())


def test_odd_markup():
    assert text_of("<article>a &lt;b&gt; &amp;am &#233;&#x41;<!-- c --><script>x</article>") == "a <b> &am éA"
    assert text_of("<article>" + "<div>" * 500 + "deep" + "</div>" * 500 + " end</article>") == "deep end"
    assert text_of("plain words only") in ("plain words only", "")
    assert text_of("<article></article>") == ""


def test_class_words_on_wrappers_do_not_drop_the_article():
    story = "<p>the whole story of the day in many words</p><p>and its end</p>"
    want = "the whole story of the day in many words and its end"
    side = "<div class='sidebar'><p>short aside</p></div>"
    for page in (f"<body><article class='post has-comments'>{story}</article>{side}</body>",
                 f"<body class='has-sidebar'><article>{story}</article>{side}</body>",
                 f"<body class='sidebar menu'><article>{story}</article>{side}</body>",
                 f"<body><div class='layout-no-sidebar'><article>{story}</article></div>{side}</body>",
                 f"<body><div class='story ad-free'>{story}</div>{side}</body>",
                 f"<body><div class='banner-page'><article>{story}</article></div></body>",
                 f"<body><div class='page-header-wide widget'>{story}</div></body>"):
        assert text_of(page) == want, page
    # the words still mark what they name
    for furniture in ("<article class='comment'><p>reader</p></article>", "<div class='related'><article><p>teaser</p></article></div>",
                      "<div class='cookie-notice'>We use cookies</div>", "<div id='site_footer'>me</div>", "<p class='ad'>Buy</p>"):
        assert text_of(f"<body><article>{story}</article>{furniture}</body>") == want, furniture
    assert text_of("<body><div class='cookie-notice'>We use cookies</div></body>") == ""


def test_copies_on_an_unmarked_host_keep_their_text():
    page = "<body><h1>Head</h1><p>One paragraph that all copies have</p></body>"
    near = [page.replace("</body>", f"<i data-n={k}></i></body>") for k in range(5)]
    for copies in ([page] * n for n in (1, 2, 3, 50)):
        assert text_of(page, copies) == "Head One paragraph that all copies have"
    assert text_of(near[0], near) == "Head One paragraph that all copies have"


def test_formulas_stay_and_their_source_goes():
    assert text_of("<article><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds</p></article>") == "So x=2 holds"


def test_given_pages(spark):
    rows = {r["page_id"]: r for r in pages.extract_main_text(table(spark, SF, "pages")).collect()}
    for r in table(spark, SF, "pages").collect():
        body = re.search(r"(?s)<article>(.*?)</article>", r["html"]).group(1)
        blocks = re.split(r"</?(?:p|h1|h2|br|div|ul|li)[^>]*>", body)
        texts = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in blocks]
        assert rows[r["page_id"]]["text"] == " ".join(t for t in texts if t)
        assert rows[r["page_id"]]["n_chars"] == len(rows[r["page_id"]]["text"])


def test_awkward_rows(spark, monkeypatch):
    long = "<article>" + "<p>word word</p>" * 5000 + "</article>"
    data = [(0, "http://a.example/x", None), (1, None, ""), (2, "http://a.example/y", ARTICLE), (2, "http://a.example/y", ARTICLE),
            (3, "http://[bad", "<article>x</article>"), (None, "http://b.example", long)]
    rows = [(*r, *([k] * len(CLASHING))) for k, r in enumerate(data)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string" + "".join(f", `{c}` long" for c in CLASHING))
    want = sorted(("", "", "x", "Head & tail One bold word here. Next Unclosed i1 i2", "Head & tail One bold word here. Next Unclosed i1 i2",
                   " ".join(["word word"] * 5000)))
    assert sorted(r["text"] for r in pages.extract_main_text(df).collect()) == want
    assert pages.infer_wrappers(df).count() == pages.infer_wrappers(df.repartition(5)).count() == 3
    monkeypatch.setattr(pages, "BROADCAST_BYTES", 0)         # the join instead
    assert sorted(r["text"] for r in pages.extract_main_text(df).collect()) == want
    assert pages.extract_main_text(df.limit(0)).count() == 0
