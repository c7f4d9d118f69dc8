import pytest

from onlinecast.llm import extract
from tests.llm.frames import SMALL, clashing, none_of

PAGES = "page_id long, url string, html string"


def text(source):
    return "\n\n".join(t for t, _ in extract.Page(source).text_blocks())


@pytest.mark.parametrize(
    "source,want",
    [
        ("", ""),
        ("plain  text\n here", "plain text here"),
        ("<p>a<p>b<br>c</p>d", "a\n\nb c\n\nd"),
        ("<article><h1>T</h1><p><b>One.<br><p>Two</article><p>out", "T\n\nOne.\n\nTwo"),
        ("<nav>m</nav><header>h</header><main><header><h1>T</h1></header>x</main><footer>f</footer>", "T\n\nx"),
        ("<div class='ad'>buy<div>now</div></div><div>keep</div>", "keep"),
        ("<div id=comments><article>reply</article></div><article>text<aside>s</aside></article>", "text"),
        ("<script>var a='</p><p>x';</script><style>p{}</style><p>k<!-- <p>c --></p><noscript>n</noscript>", "k"),
        ("<p>a &amp; b&nbsp;&#233;&lt;i&gt;</p>", "a & b é<i>"),
        ("<ul><li>one<li>two</ul><table><tr><td>x<td>y</table>", "one\n\ntwo\n\nx\n\ny"),
        ("<p>un<b>bro</b>ken</p><form><p>q</form><div hidden>z</div><p style='display:none'>w", "unbroken"),
        ("<p>open <a href='x>y'>link</a><script>never closed <p>z", "open link"),
        ("<p>a</div></p></span>b<", "a\n\nb<"),
        ("<div class='cookie-notice'>c</div><div role=navigation>n</div><section class=shared-adventure>s</section>", "s"),
        ("<title>t</title><p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
        ("<p>before<!-- never closed <p>after", "before"),
    ],
)
def test_blocks(source, want):
    assert text(source) == want


@pytest.mark.parametrize(
    "source,want",
    [
        (f"<div class='{name}'><article><h1>T</h1><p>body</article><div class=sidebar>links and more links</div></div>", "T\n\nbody")
        for name in ("has-sidebar", "no-sidebar", "comments-open", "with-banner", "nav-fixed", "share-enabled", "widget")
    ]
    + [
        ("<div class='post comments-open'><p>all of the text</div><p>x", "all of the text\n\nx"),
        ("<div class=widget>everything there is</div>", "everything there is"),
        ("<article class='post has-sidebar'>text</article><div class=sidebar>links</div>", "text"),
        ("<p>text <button>Share</button></p>", "text"),
        ("<p>one <span class='ad'>buy</span> two <span hidden>three</span> four</p>", "one two four"),
        ("<p>one <b hidden>two", "one"),
        ("<p><label class=share>Tell</label> a longer story</p>", "a longer story"),
    ],
)
def test_class_names_are_evidence(source, want):
    assert text(source) == want


def test_repeated_branches_of_a_site_go(spark):
    rows = []
    for k in range(8):
        body = f"<div class=box><p>Read our other pages today</p></div><div class=story><p>Story {k} begins {k * k}</p><p>and ends {k}</p></div>"
        rows.append((k, f"http://Site.example/{k}?x", f"<html><body>{body}</body></html>"))
    rows.append((20, "http://other.example/", "<body><div class=box><p>Read our other pages today</p></div></body>"))
    rows.append((21, None, "<body><div class=box><p>Read our other pages today</p></div></body>"))
    got = {r.page_id: r.text for r in extract.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[3] == "Story 3 begins 9\n\nand ends 3"
    assert got[20] == got[21] == "Read our other pages today"


def test_copies_of_a_page_do_not_erase_it(spark):
    page = "<body><div><p>The very same page, again and again</p></div></body>"
    rows = [(k, f"http://mirror.example/{k}", page) for k in range(9)]
    rows += [(10 + k, f"http://m2.example/{k}", page.replace("very", f"v{k}")) for k in range(9)]
    got = {r.page_id: r.text for r in extract.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[4] == "The very same page, again and again"
    assert got[13] == "The v3 same page, again and again"


def test_marks_and_long_notices_lose_no_article(spark):
    """Teasers or a part in ``article`` are not the page; a notice longer than every article goes all the same."""
    notice = "<div class=legal><p>" + "This notice stands on every page of this site. " * 20 + "</p></div>"
    rows = []
    for k in range(8):
        body = f"<div class=body><p>Report {k} is about {k * k} things</p></div>"
        card = f"<article class=card><p>Teaser {k}</p></article>"
        rows.append((k, f"http://cards.example/{k}", f"<body>{body}{card}</body>"))
        rows.append((10 + k, f"http://short.example/{k}", f"<body>{notice}{body}</body>"))
        many = "".join(f"<div class=n{'abcdefghijkl'[j]}><p>Notice {j}</p></div>" for j in range(12))
        rows.append((20 + k, f"http://many.example/{k}", f"<body><div>{many}{body}</div><p>by {k}</p></body>"))
        rows.append((40 + k, f"http://same.example/{k}", f"<body><main>{notice}<h1>Title {k}</h1></main></body>" if k else f"<body><main>{notice}</main></body>"))
    rows.append((60, "http://alone.example/", "<body><p>The first half</p><article><p>the second half</p></article></body>"))
    got = {r.page_id: r.text for r in extract.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[3] == "Report 3 is about 9 things\n\nTeaser 3"
    assert got[13] == "Report 3 is about 9 things"
    assert got[23] == "Report 3 is about 9 things\n\nby 3"
    assert got[43] == "Title 3"
    assert got[40].startswith("This notice stands")
    assert got[60] == "The first half\n\nthe second half"


def test_query_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    rows = extract.main_text(pages, keep=["page_id"]).join(pages, "page_id").collect()
    assert len(rows) == pages.count()
    for r in rows:
        article = r.html.split("<article>")[1].split("</article>")[0]
        blocks = [text(b) for b in article.replace("<b>", "").replace("</b>", "").replace("<br>", " ").replace("</p>", "<p>").replace("<h1>", "<p>").replace("</h1>", "<p>").split("<p>")]
        assert r.text == "\n\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)


def test_odd_rows(spark):
    long = "<article>" + "<p>one more line</p>" * 20_000 + "</article>"
    rows = [
        (1, None, None), (2, "not an address", ""), (3, "http://x/", "<" * 500), (4, "http://x/", long), (4, "http://x/", long),
        (None, "http://x/", "<p>no id"), (5, "http://x/", "<div>" * 3_000 + "deep"),
    ]
    pages = clashing(spark.createDataFrame(rows, PAGES), "text", "n_chars", "host", "node")
    got = extract.main_text(pages).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert by[1].text == by[2].text == "" and by[1].n_chars == 0
    assert by[4].text.count("one more line") == 20_000
    assert by[None].text == "no id" and by[5].text == "deep" and by[5].node == "taken"
    assert extract.main_text(none_of(pages)).count() == 0
