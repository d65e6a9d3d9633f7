import html
import random
import re
from collections import Counter

import pytest
from cases import documents

from tradewind.llm import main_text as M

WRAP = '<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">%s</body></html>'
SCHEMA = "page_id long, url string, html string"


def text_of(body, host="h", lows=None):
    return M.written(lows, *M.parsed_page(WRAP % body, host)[3:])


def texts(spark, rows):
    return {r.page_id: r.text for r in M.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}


def brute(source):
    """What stands in the article of the given pages: its tags taken out, its blocks on lines."""
    inner = re.search(r"<article>(.*)</article>", source, re.S)[1]
    lines = re.split(r"</?(?:p|h1)>", inner)
    plain = (" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x))).split()) for x in lines)
    return "\n".join(x for x in plain if x)


def test_pages_equal_their_articles(spark, small):
    pages = documents(spark, small, "pages").collect()
    got = M.main_text(documents(spark, small, "pages"))
    rows = got.collect()
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id, r.url, r.text, r.n_chars) for r in rows) == sorted(
        (r.page_id, r.url, brute(r.html), len(brute(r.html))) for r in pages)


@pytest.mark.parametrize("body, want", [
    ("<header>Site</header><nav><ul><li><a href=/>Home</a></ul></nav><main><h1>T</h1><p>One<p>Two <b>bold</b>, &amp; more</main><footer>x</footer>", "T\nOne\nTwo bold, & more"),
    ('<div class="cookie-banner">We use cookies</div><article><header><h1>T</h1></header><p>A<br>B</p><aside>See</aside><footer>Tags</footer></article>', "T\nA B"),
    ('<article><p>Body.</p><div class="share-buttons"><a>Post</a></div><section id="comments"><article class="comment"><p>First!</p></article></section></article>', "Body."),
    ('<article><p>Body.</p></article><div id="disqus_thread"><p>Reader</p></div><div class="sidebar"><p>S</p></div>', "Body."),
    ("<article><p>x &lt;tag&gt; &nbsp; y&#8217;s &eacute;</p><script>if (a<b) '</p>'</script><!-- <p>no</p> --><p>a < b and c>d</p></article>", "x <tag> y’s é\na < b and c>d"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table></article>", "one\ntwo\na\nb\nc"),
    ("<article><p>in<span>side</span> <em>words</em></p>loose text<div>deep<div>er</div></div></article>", "inside words\nloose text\ndeep\ner"),
    ('<div id="page"><div class="menu"><a>x</a></div><div class="text"><p>No article here.</p><p>Yes.</p></div><form><input>Mail<button>Go</button></form></div>', "No article here.\nYes."),
    ("<div><a>A</a><a>B</a><a>C</a></div><div><p>Words with <a>a link</a></p></div>", "Words with a link"),
    ('<form id="aspnetForm"><article><p>Kept.</p></article></form>', "Kept."),
    ('<article><p hidden>no</p><p style="display: none">no</p><p>yes</p><div role="alert">no</div></article>', "yes"),
    ('<article><p title="a > b">q</p><a href="x>y</a><p>after</p></article>', "q\ny\nafter"),
    ("<article><p>cut off <a hre", "cut off"), ("<p>only text</p>", "only text"), ("", ""), ("plain words", "plain words")])
def test_markup(body, want):
    assert text_of(body) == want


def site(draw, page, words=40):
    """A page without any telling markup: the same head and foot on all, texts of its own between."""
    own = lambda: " ".join(draw.choice("abcdefgh") * draw.randint(2, 9) for _ in range(words))
    paragraphs = [own() for _ in range(draw.randint(1, 4))]
    top, foot = "<div><span>Welcome to our site</span></div>", f"<div>All rights reserved {2000 + page}</div>"
    return f"{top}<div>{''.join(f'<p>{p}</p>' for p in paragraphs)}</div>{foot}", "\n".join(paragraphs)


def test_what_all_pages_of_a_host_say_goes(spark):
    draw = random.Random(3)
    rows, want = [], {}
    for page in range(60):
        body, text = site(draw, page)
        rows.append((page, f"https://User@Big.example:8080/{page}", WRAP % body))
        want[page] = text
    body, text = site(draw, 7)
    rows += [(100 + at, f"http://copies.example/{at}", WRAP % body) for at in range(40)]   # copies tell nothing
    rows += [(200, "http://small.example/", WRAP % body), (201, None, WRAP % body), (202, "no url", WRAP % body)]
    whole = f"Welcome to our site\n{text}\nAll rights reserved 2007"
    want |= {page: whole for page in [*range(100, 140), 200, 201, 202]}
    assert texts(spark, rows) == want


def test_importance_is_the_entropy_of_what_pages_hold(spark):
    rows = [(at, f"http://h.example/{at}", WRAP % f"<div>{'same' if at % 4 else at * 'x'} </div><div>fixed</div><p>{'y' * at}</p>") for at in range(1, 41)]
    pages = M.parsed(spark.createDataFrame(rows, SCHEMA))
    counts = {}
    for r in pages.collect():
        for key, feature in zip(r["keys"], r.features):
            counts.setdefault(key, Counter())[feature] += 1
    import math
    low = set()
    for key, seen in counts.items():
        m = sum(seen.values())
        entropy = -sum(n / m * math.log(n / m) for n in seen.values())
        if m >= M.SUPPORT and entropy / math.log(m) < M.LEAST:
            low.add(key)
    assert low and {r.low for r in M.low_nodes(pages).collect()} == low


def test_edges(spark):
    deep = "<div>" * 20000 + "deep" + "</div>" * 20000
    rows = [(1, None, None), (None, None, None), (2, "http://a.b/", ""), (3, "http://a.b/", " \n\t"), (3, "http://a.b/", " \n\t"), (4, "http://a.b/", "<article>" + "<p>long text</p>" * 50000),
            (5, "http://a.b/", deep), (6, "http://a.b/", "<" * 1000 + "a" + '"' * 1000), (7, "http://a.b/", "<a x='" * 3000)]
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA + ", text string, template int, lows string")
    got = M.main_text(frame).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by_id = {r.page_id: r.text for r in got}
    assert by_id[1] == by_id[None] == by_id[2] == by_id[3] == "" and by_id[4] == "\n".join(["long text"] * 50000) and by_id[5] == "deep"
    assert M.main_text(frame.where("false")).count() == 0
