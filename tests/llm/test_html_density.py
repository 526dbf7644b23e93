"""Main text of hand-made pages of many shapes."""

import pytest
from pyspark.sql import functions as F

from curata.llm.html_density import extract, main_text

PARA = ["The first paragraph of the article says what it is about, in enough words to be one.",
        "A second paragraph goes on & on about the same; it has <b>bold</b> and <a href='/x'>linked</a> words in it.",
        "Short one.",
        "The last paragraph closes the article with a few more words than the one before it had."]
PLAIN = [PARA[0], "A second paragraph goes on & on about the same; it has bold and linked words in it.", *PARA[2:]]
WANT = "\n".join(["A title", *PLAIN])
BODY = "<h1>A title</h1>" + "".join(f"<p>{p}</p>\n" for p in PARA)
MENU = "<ul>" + "".join(f"<li><a href='/{i}'>Menu item {i}</a></li>" for i in range(8)) + "</ul>"
JUNK = "Subscribe to our excellent newsletter today and never miss a single story from all of our writers again."

PAGES = {
    "article": f"<html><head><title>T</title><style>p{{x:y}}</style><script>var t='</p><p>no</p>';</script></head><body><nav>{MENU}</nav>"
               f"<div class='ad'>{JUNK}</div><article>{BODY}</article><footer>&copy; {JUNK}</footer></body></html>",
    "unclosed": f"<nav>{MENU}</nav><article><h1>A title</h1><p><b>" + "<br><p>".join(PARA) + f"</article><footer>{JUNK}",
    "div page": f"<body><div id='header'><div class='nav-menu'>{MENU}</div></div><div class='content has-sidebar'>{BODY}</div>"
                f"<div class='sidebar'><p>{JUNK}</p></div><div id='footer'>{JUNK}</div></body>",
    "links without marks": f"<body><div>{MENU}</div><div><h1>A title</h1><div>{BODY[16:]}</div></div><div>{MENU}</div></body>",
    "main": f"<body><header><h2>Site</h2>{MENU}</header><main>{BODY}<form><input value='x'><label>Name</label><button>Send</button></form></main>"
            f"<aside><p>{JUNK}</p></aside></body>",
    "comments": f"<article><header><h1>A title</h1></header>{BODY[16:]}<section id='comments'><h2>Comments</h2><div class='comment'><p>{JUNK} {JUNK}"
                f"</p></div></section><div class='share-buttons'>Share this</div></article>",
    "notice": f"<body><div class='cookie-notice'><p>{JUNK}</p></div><div role='dialog'><p>{JUNK}</p></div><article>{BODY}</article>"
              f"<div class='comments-area'><ol class='commentlist'><li><p>{JUNK}</p></li></ol></div></body>",
    "hidden": f"<article>{BODY}<div style='display: none'>{JUNK}</div><p hidden>{JUNK}</p><noscript>{JUNK}</noscript><!-- {JUNK} --></article>",
    "div header": f"<body><div id='header'><h2>The site's name</h2><p>{JUNK}</p></div><div class='post'><div class='entry-header'><h1>A title</h1></div>"
                  f"{BODY[16:]}<div class='adsbygoogle'>{JUNK}</div></div><div id='disqus_thread'><p>{JUNK}</p></div></body>",
    "unmarked ad": f"<body><div><p>{JUNK}</p></div><article>{BODY}</article></body>",
    "link list": f"<article>{BODY}{MENU}</article>",
}


@pytest.mark.parametrize("name", PAGES)
def test_pages(name):
    assert main_text(PAGES[name]) == WANT


KEPT = {
    "wrapper class": f"<body><nav>{MENU}</nav><div class='prose overflow-hidden'>{BODY}</div></body>",
    "page class": f"<body><div id='page' class='right-sidebar'>{BODY}<div class='sidebar'><p>{JUNK}</p></div></div></body>",
    "whole class": f"<body><div class='sidebar'><h1>A title</h1>{BODY[16:]}</div></body>",
    "form": f"<body><form id='aspnetForm'><nav>{MENU}</nav>{BODY}<form><label>Name</label></form></form></body>",
}


@pytest.mark.parametrize("name", KEPT)
def test_marks_do_not_drop_the_article(name):
    assert main_text(KEPT[name]) == WANT


def test_words_of_titles_are_no_marks():
    more = ("<h2 id='cookies-and-sessions'>Cookies</h2><p>{0}</p><section id='discussion'><h2 id='feedback-loops' class='notice'>Loops</h2><p>{0}</p></section>"
            "<section id='ad-hoc-networks'><p>{0}</p></section><div class='section' id='discussion'><p>{0}</p></div>").format(PARA[0])
    want = "\n".join([WANT, "Cookies", PARA[0], "Loops", PARA[0], PARA[0], PARA[0]])
    assert main_text(f"<article>{BODY}{more}<div class='share-buttons'>Share</div><div id='comments'><p>{JUNK * 20}</p></div></article>") == want
    assert main_text(f"<article>{BODY}<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>") == WANT + "\nSo x=2 holds."


def test_linked_blocks_of_the_article_stay():
    refs = [f"Author {i}, a report of some length on the subject, volume {i}" for i in range(4)]
    body = ("<h1><a href='/t'>A title</a></h1>" + BODY[16:] + "<h2><a href='#s'>Section</a></h2><p>" + PARA[0] + "</p><p><a href='/r'>Source report</a></p>"
            "<p>See also:</p><ul>" + "".join(f"<li><a href='/{i}'>Page {i}</a></li>" for i in range(4)) + "</ul><div><ul><li><a href='/z'>One link</a></ul></div>"
            "<h2>Links</h2><div><ul>" + "".join(f"<li><a href='/l{i}'>Link {i}</a></li>" for i in range(3)) + "</ul></div><p>" + PARA[3] + "</p><ol>"
            + "".join(f"<li><a href='/{i}'>{x}</a></li>" for i, x in enumerate(refs)) + "</ol>")
    want = [WANT, "Section", PARA[0], "Source report", "See also:", *[f"Page {i}" for i in range(4)], "One link", "Links", *[f"Link {i}" for i in range(3)], PARA[3], *refs]
    assert main_text(f"<nav>{MENU}</nav><article>{body}<p>{PARA[3]}</p><div>{MENU}</div></article>") == "\n".join([*want, PARA[3]])


def test_titles_and_leads_outside_the_content_stay():
    rest = BODY[16:]
    assert main_text(f"<article><div class='header'><h1>A title</h1><p>By A</p></div>{rest}</article>") == WANT.replace("A title", "A title\nBy A")
    long = "".join(f"<p>{p}</p>" for p in PARA * 6)
    want = "\n".join(["A title", "A lead that says what follows.", *PLAIN * 6])
    page = f"<body><nav>{MENU}</nav><h1>A title</h1><p>A lead that says what follows.</p><div>{MENU}</div><div class=content>{long}</div><div class='sidebar'>{JUNK}</div></body>"
    assert main_text(page) == want
    assert main_text(page.replace("<h1>", "<div><div class=top-part><h1>").replace("follows.</p>", "follows.</p></div></div>")) == want
    # a title behind the main text, or one of two, says nothing
    assert main_text(f"<div class=content>{long}</div><div><h1>Other</h1></div>") == "\n".join(PLAIN * 6)


def test_comment_sections_by_heading():
    for heading in ("Comments", "12 comments", "Reader comments (3)", "Kommentare", "Leave a reply"):
        more = f"<section id='reader-opinions'><div><h3>{heading}</h3></div><p>{JUNK}</p><p>{JUNK}</p></section>"
        assert main_text(f"<article>{BODY}{more}</article>") == WANT
    kept = f"<section><h3>Comments on the method</h3><p>{JUNK}</p></section>"
    assert main_text(f"<article>{BODY}{kept}</article>") == "\n".join([WANT, "Comments on the method", JUNK])


def test_comments_that_are_never_closed():
    assert main_text(f"<article>{BODY}<!-- unclosed <p>{JUNK}</p></article>") == WANT
    assert main_text(f"<article>{BODY}<!-- closed --><p>More.</p><!--> <!--- x --!></article>") == WANT + "\nMore."
    assert main_text(f"<script>x = '<!--';</script><article>{BODY}</article>") == WANT


def test_deep_nesting_takes_linear_time():
    import time

    for tag in ("<div>", "<div class='ad'>", "<section><h3>Comments</h3>"):
        began = time.perf_counter()
        text = main_text("<article><h1>A title</h1>" + tag * 20_000 + "deep words")
        assert time.perf_counter() - began < 10 and text.startswith("A title")


def density_of(node):
    """The same figures by recursion straight from their definitions: characters, tags, link characters, link tags."""
    chars = tags = link_chars = link_tags = 0
    for part in node.parts:
        if type(part) is str:
            chars += len("".join(part.split()))
        elif not part.out:
            c, t, lc, lt = density_of(part)
            chars, tags, link_chars, link_tags = chars + c, tags + t + 1, link_chars + lc, link_tags + lt + (part.tag == "a")
    return chars, tags, chars if node.tag == "a" else link_chars, link_tags


def test_densities_against_their_definition():
    import math
    import random

    from curata.llm.html_density import measure, parse

    rng = random.Random(3)

    def some(depth):
        if depth == 0 or rng.random() < 0.3:
            return "word " * rng.randint(0, 9)
        return "".join(f"<{t}>{some(depth - 1)}</{t}>" for t in rng.choices(["div", "b", "a", "section", "span", "script"], k=rng.randint(1, 3)))

    for _ in range(60):
        body, _ = parse(some(4))
        whole = density_of(body)
        for n in measure(body):
            c, t, lc, lt = density_of(n)
            want = 0.0
            if c:
                base = math.log(c / max(c - lc, 1) * lc + (whole[2] / whole[0]) * c + math.e)
                want = c / max(t, 1) * max(math.log(max(c / max(lc, 1) * max(t, 1) / max(lt, 1), 1.0)) / base, 0.0)
            assert n.density == pytest.approx(want)
            assert n.density_sum == pytest.approx(sum(x.density for x in n.children() if not x.out))


def test_text_rules():
    assert main_text(None) == main_text("") == main_text("<html><body></body></html>") == main_text("<nav>x</nav>") == ""
    assert main_text("just  text \n here") == "just text here"
    assert main_text("<p>a &lt;b&gt; &amp;amp; &#233;&nbsp;x&eacute;</p>") == "a <b> &amp; é xé"
    assert main_text("<div>one<p>two</p>three<span>four</span> <i>five</i></div>") == "one\ntwo\nthreefour five"
    assert main_text("<article><p>x<br/>y</p><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>") == "x\ny\na\nb\nc\nd"
    assert main_text("<p>" + "<i>" * 5000 + "deep") == "deep"
    assert main_text("<article><p>" + "w " * 200000 + "</p></article>") == ("w " * 200000).strip()


def test_frame(spark):
    rows = [(1, "u", PAGES["article"]), (1, "u", PAGES["article"]), (None, None, None), (2, "v", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("n_chars", F.lit("x"))
    got = extract(pages)
    assert got.columns[:4] == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "u", WANT, len(WANT))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=str)
    assert extract(pages.limit(0)).count() == 0


def test_all_given_pages(spark):
    """The given pages have one shape, so a plain cut out of the article gives the same text."""
    import html
    import re

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for r in rows:
        article = re.search(r"(?s)<article>(.*)</article>", r.html)[1]
        blocks = re.split(r"</?p>|</?h1>|<br>", re.sub(r"</?b>", "", article))
        want = [" ".join(html.unescape(x).split()) for x in blocks]
        assert main_text(r.html) == "\n".join(x for x in want if x)
