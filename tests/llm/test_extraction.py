import html
import random
import re

import pytest

from mailsift.llm import extraction
from mailsift.llm.common import table

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"
BARE = extraction.Weights({})
WORDS = "the quick brown fox jumps over a lazy dog and runs away from all of the hounds in the old wood"


def marked_article(page):
    """The article of a given page, read by a plain pattern."""
    inner = re.search(r"<article>(.*?)(</article>|$)", page or "", re.S)
    found = re.sub(r"</?(p|h1|br)>", " ", inner.group(1)) if inner else ""
    return " ".join(html.unescape(re.sub(r"</?b>", "", found)).split())


def fresh(spark, rows, schema=PAGES):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def learned(spark):
    return extraction.learned(table(spark, SF, "pages"))


def test_run_with_the_highest_sum_by_brute_force():
    draw = random.Random(5)
    for _ in range(300):
        scores = [draw.choice([-3.0, -2.0, -1.0, -0.5, 1.0, 2.0]) for _ in range(draw.randint(0, 14))]
        start, end = extraction.best_run(scores)
        every = [sum(scores[a:b]) for a in range(len(scores) + 1) for b in range(a, len(scores) + 1)]
        assert sum(scores[start:end]) == max(every)


def test_every_page_of_the_table(spark):
    pages = table(spark, SF, "pages")
    found = {r["page_id"]: r for r in extraction.extract(pages).collect()}
    given = pages.collect()
    assert len(found) == len(given)
    for row in given:
        got = found[row["page_id"]]
        assert (got["url"], got["text"]) == (row["url"], marked_article(row["html"]))
        assert got["n_chars"] == len(got["text"])


def test_articles_that_are_not_marked_on_held_out_pages(spark, learned):
    """Learned on marked pages, held against pages whose article and menus are plain divisions."""
    weights = extraction.Weights(learned)
    rows = table(spark, "/root/testdata/sf0.01", "pages").collect()
    right = 0
    for row in rows:
        plain = row["html"].replace("<article>", '<div id="story">').replace("</article>", "</div>")
        plain = plain.replace("<nav>", "<div>").replace("</nav>", "</div>")
        right += extraction.main_text(plain, weights) == marked_article(row["html"])
    assert right >= 0.97 * len(rows)


@pytest.mark.parametrize("known", [False, True])
def test_what_is_no_content(learned, known):
    weights = extraction.Weights(learned) if known else BARE
    page = f"""<html><head><title>T</title><script>if (a < b) w("<p>no</p>")</script></head>
    <body class="has-sidebar"><header><h1>Site</h1><a href=/>home</a></header><nav><ul><li>menu</ul></nav>
    <div id='cookie-notice'>We use cookies and more of them, {WORDS}</div>
    <div class="layout sidebar-right"><aside>side {WORDS}</aside><main><article class="post has-comments"><header><h1>Head</h1></header>
    <p>One &amp; {WORDS}.<p>Two&nbsp;\n  two {WORDS}<div class="ad-box"><p>Buy {WORDS}</div>
    <form action="x>y"><label>mail</label><input name=a><button>send</button></form>
    <ul><li>first {WORDS}</li><li>last</li></ul><p class=notice>notice {WORDS}<p>Th<i>re</i>e<br>four<!-- c --></p>
    <section class="comments"><article class="comment"><p>I say {WORDS}</p></article></section>
    <footer>by me</footer></article></main></div><div class="related"><p>{WORDS} {WORDS}</p></div>
    <footer>&copy; all {WORDS}</footer></body></html>"""
    said = f"Head One & {WORDS}. Two two {WORDS} first {WORDS} last Three four"
    assert extraction.main_text(page, weights) == said


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("   \n", ""),
        ("no markup at all, 1 < 2", "no markup at all, 1 < 2"),
        ("<p>cut off <b>here &am", "cut off here &am"),
        ("<article><p>cut in a tag</p><p cla", "cut in a tag"),
        ("<nav>only <b>a menu</b></nav>", ""),
        ("<article></article>", ""),
        ("<script>never closed <p>x</p>", ""),
        ("<article><p>&lt;p&gt; &#228; &amp;amp; &bogus;</p></article>", "<p> ä &amp; &bogus;"),
        ("<article><p>a" + "<b>" * 5 + "b</p></article>", "ab"),
        ('<a href="unclosed><p>text of a page whose quote is open</p>', "text of a page whose quote is open"),
        ("</div></p>stray ends</b>", "stray ends"),
    ],
)
def test_odd_pages(page, text):
    assert extraction.main_text(page, BARE) == text


def test_very_long_pages():
    many = "<p>" + WORDS + "</p>"
    long = "<nav>" + "<li><a href=x>l</a></li>" * 20_000 + "</nav><article>" + many * 20_000 + "</article>"
    assert extraction.main_text(long, BARE) == " ".join([WORDS] * 20_000)


def test_nulls_repeated_rows_empty_table_and_clashing_columns(spark):
    article = "<html><body><nav>m</nav><article><h1>Head</h1><p>Some text</p></article></body></html>"
    rows = [(None, None, None), (1, "u", article), (1, "u", article), (None, "v", ""), (2, None, "<p>x y z</p>")]
    wide = spark.createDataFrame([r + ("a", 9) for r in rows], PAGES + ", text string, n_chars int")
    found = sorted((str(r[0]), str(r[1]), r[2], r[3]) for r in extraction.extract(wide).collect())
    assert found == sorted(
        [("None", "None", "", 0), ("1", "u", "Head Some text", 14), ("1", "u", "Head Some text", 14), ("None", "v", "", 0),
         ("2", "None", "x y z", 5)]
    )
    assert extraction.extract(fresh(spark, [])).collect() == []


def test_bound_of_labelled_pages_changes_no_text(spark):
    pages = table(spark, SF, "pages")
    some = extraction.extract(pages, bound=10).select("page_id", "text").collect()
    assert {r["page_id"]: r["text"] for r in some} == {r["page_id"]: marked_article(r["html"]) for r in pages.collect()}
