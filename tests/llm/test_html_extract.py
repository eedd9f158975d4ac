import pytest

from reviewlake.llm import html_extract as hx

BODY = "<p>First  paragraph of&nbsp;the\n story &amp;amp; more &lt;b&gt;.</p><p>Second <b>bold</b> one<br>next line<p>Third &eacute;&#233; one is long enough to count."
WANT = "Title\n\nFirst paragraph of the story &amp; more <b>.\n\nSecond bold one next line\n\nThird éé one is long enough to count."
JUNK = '<header><h2>Site</h2></header><nav><a href="/">Home</a></nav><div class="cookie-notice">We use cookies on this site, as you may know by now.</div>'
END = '<aside>Side text that nobody reads at all</aside><div class="ad-box">Buy</div><footer>(c) 2024</footer><script>var x = "<p>no</p>";</script>'


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>T</title><style>p{{}}</style></head><body>{JUNK}<article><h1>Title</h1>{BODY}</article>{END}</body></html>",
        f'{JUNK}<div id="main"><div class="post-12 entry"><h1>Title</h1>{BODY}<div class="comments"><p>Reader says something at great length, but it is a comment.</p></div></div></div>{END}',
        f"<body>{JUNK}<main><h1>Title</h1><!-- <p>no</p> -->{BODY}<form><p>Name</p><input></form></main>{END}",
        f'<BODY>{JUNK}<table><tr><td class=sidebar>x y z</td><td class="text"><H1>Title</H1>{BODY}</td></tr></table>{END}',
    ],
)
def test_templates(page):
    assert hx.extract(page, None) == WANT
    assert hx.extract(page, hx.vote(page)[0]) == WANT


def test_votes_of_a_host_overrule_a_page_unless_little_is_there(spark):
    good = f'<body><div class="story">{BODY}</div><div class="box">short</div></body>'
    odd = '<body><div class="story"><p>The story itself, in a few words.</p></div><div class="box">' + "long talk of others " * 7 + "</div></body>"
    tiny = '<body><div class="story"><p>Tiny.</p></div><div class="box">' + "long other text " * 50 + "</div></body>"
    pages = [(i, f"http://www.a.com/{i}", good) for i in range(5)] + [(9, "https://A.com:80/9", odd), (10, "http://b.com/", odd), (11, "http://a.com/11", tiny)]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, text string")
    for most in (20_000, 0):
        got = {x.page_id: x.text for x in hx.extract_pages(df, ("page_id", "url"), broadcast_rows=most).collect()}
        assert got[9] == "The story itself, in a few words." and got[10].startswith("long talk") and got[3] == WANT.split("\n\n", 1)[1]
        assert got[11].startswith("long other")


def test_odd_pages(spark, tmp_path):
    rows = [(1, None, None), (2, "http://a.com", ""), (None, "x", "plain text"), (4, "http://a.com", "<p>unclosed <b>bold"), (4, "http://a.com", "<p>unclosed <b>bold"), (5, "http://a.com", "<div>" * 5000 + "deep"), (6, "http://c.com", "<p>w</p>" * 30000), (7, "u", "</div></p><p <>< a < b")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted((x.page_id or 0, x.text[:30], x.n_chars) for x in hx.op8_consensus_paths(spark, str(tmp_path)).collect())
    assert got[:6] == [(0, "plain text", 10), (1, "", 0), (2, "", 0), (4, "unclosed bold", 13), (4, "unclosed bold", 13), (5, "deep", 4)]
    assert got[6][2] == 30000 * 3 - 2
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/e/pages.parquet")
    assert hx.op8_consensus_paths(spark, f"{tmp_path}/e").count() == 0


@pytest.mark.parametrize(
    "inner",
    [
        *(f'<{tag} class="{name}"><h1>Title</h1>{BODY}</{tag}>' for tag in ("div", "article", "main") for name in ("content no-sidebar", "has-sidebar main", "post comments-open", "print-content", "overflow-hidden", "elementor-widget-text-editor")),
        f'<div class="print-content"><h1>Title</h1>{BODY}</div><div class="ad">Buy this now</div><p>Short line.</p>',
    ],
)
def test_words_of_a_class_do_not_drop_the_article(inner):
    page = f"<body><header>Site</header>{inner}<footer>(c) 2024</footer></body>"
    assert WANT in hx.extract(page, None) and WANT in hx.extract(page, hx.vote(page)[0])
    assert "Buy" not in hx.extract(page, None)


def test_a_page_of_marked_parts_alone_is_not_empty():
    page = '<body><div class="share">' + "some words here " * 4 + '</div><div class="widget">' + "other words there " * 4 + "</div></body>"
    assert "words" in hx.extract(page, None) and hx.vote(page)[1] > 0
    hidden = f'<body><div style="display:none">{BODY}</div></body>'
    assert hx.extract(hidden, None) == ""


def test_a_long_thread_of_comments_is_still_dropped():
    page = f'<body><div class="post"><h1>Title</h1>{BODY}</div><div class="comments">' + "<p>A reader writes at length.</p>" * 99 + "</div></body>"
    assert hx.extract(page, None) == WANT


LONG = "<p>" + "A line of the story that goes on and on. " * 6 + "</p>"
SHAPES = {
    "comments open": f'<div class="hentry comments-open"><h1>Title</h1>{BODY}</div>',
    "has right sidebar": f'<div class="has-right-sidebar"><article><h1>Title</h1>{BODY}</article></div>',
    "print friendly": f'<div class="content print-friendly"><h1>Title</h1>{BODY}</div>',
    "one form around all": f'<form action="/"><input type="hidden" value="x"><div><h1>Title</h1>{BODY}</div><button>Go</button></form>',
    "header of the article": f"<article><header><h1>Title</h1></header>{BODY}</article>",
    "header of main": f"<main><header><h1>Title</h1><nav>Home &gt; News</nav></header>{BODY}</main>",
    "stray quote": f'<article><h1>Title</h1><img alt="it"s">{BODY}</article>',
    "stray apostrophe": f"<article><h1 title=it's>Title</h1>{BODY}</article>",
    "sign in a value": f'<article><h1 data-x="a > b">Title</h1>{BODY}</article>',
    "upper case": f"<ARTICLE><H1>Title</H1>{BODY}</ARTICLE>",
    "teasers below": f'<article><h1>Title</h1>{BODY}</article><div class="related"><article>Read this too</article></div>',
    "marked around the article, much else": f'<div class="widget-area"><article><h1>Title</h1>{BODY}</article></div><div class="comments">{LONG}{LONG}</div>',
    "search form inside": f'<article><h1>Title</h1><form><input name="q"><p>Search</p></form>{BODY}</article>',
    "table layout": f'<table><tr><td class="menu">a b c<td><h1>Title</h1>{BODY}</table>',
    "nested divs": f'<div><div><div id="c"><h1>Title</h1>{BODY}</div></div></div>',
    "comment in markup": f"<article><h1>Title</h1><!-- > <p>no -->{BODY}</article>",
    "template": f"<article><h1>Title</h1><template><p>no</p></template>{BODY}</article>",
    "hidden part": f'<article><h1>Title</h1><div hidden>no</div><p aria-hidden="true">no</p>{BODY}</article>',
    "sponsored box": f'<article><h1>Title</h1><div class="sponsoredBox"><p>Buy</p></div>{BODY}</article>',
    "stray end tags": f"</p></b></div><article></i><h1>Title</h1></em>{BODY}</span></article>",
    "section": f"<section><h1>Title</h1>{BODY}</section>",
    "no body": f"<!doctype html><article><h1>Title</h1>{BODY}</article>",
}


@pytest.mark.parametrize("shape", SHAPES)
def test_shapes_of_pages(shape):
    page = f"<body>{JUNK}{SHAPES[shape]}{END}</body>"
    for path in (None, hx.vote(page)[0], "div.nowhere"):
        assert hx.extract(page, path) == WANT


def test_very_deep_pages_take_linear_time():
    import time

    for tag, inner in (("div", ""), ("span", ""), ("b", "<hr>"), ("section", "</p>"), ("div", "x")):
        page = f"<{tag}>{inner}" * 50_000 + "the end"
        began = time.process_time()
        path, n = hx.vote(page)
        assert hx.extract(page, path).endswith("the end") and n > 0
        assert time.process_time() - began < 4


def slow_extract(page):
    """Of pages whose only article element is well formed: its text by the standard library's parser, block by block."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.inside, self.off, self.blocks = 0, 0, [""]

        def handle_starttag(self, tag, attrs):
            self.inside += tag == "article"
            self.off += tag in ("script", "style", "nav", "aside", "form")
            if tag in hx.BLOCKS:
                self.blocks.append("")
            elif tag == "br":
                self.handle_data(" ")

        def handle_endtag(self, tag):
            self.inside -= tag == "article"
            self.off -= tag in ("script", "style", "nav", "aside", "form")
            if tag in hx.BLOCKS:
                self.blocks.append("")

        def handle_data(self, data):
            if self.inside and not self.off:
                self.blocks[-1] += data

    reader = Reader()
    reader.feed(page)
    reader.close()
    return "\n\n".join(x for b in reader.blocks if (x := " ".join(b.split())))


def test_agrees_with_a_slow_extractor_on_all_made_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    got = {x.page_id: x.text for x in hx.op8_consensus_paths(spark, "/root/testdata/sf0.01").collect()}
    plain = [r for r in rows if r.html and r.html.count("<article") == 1 and 'class="ad"' not in r.html.split("<article")[1].split("</article>")[0]]
    assert len(plain) > 100
    assert sum(got[r.page_id] == slow_extract(r.html) for r in plain) == len(plain)
