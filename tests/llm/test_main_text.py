"""Main text of pages: planted articles in many page shapes, and the table's own marked articles (operator 11)."""
import html
import random
import re

import pytest

from ledgerflow.llm import common, main_text

SCHEMA = "page_id long, url string, html string"


def marked_article(source):
    """Blocks of the one marked article of a page of the table, by plain splitting."""
    inner = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", source, re.S)[1]
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inner))
    return " ".join(b for b in blocks if b)


@pytest.fixture(scope="module")
def learned(spark):
    return main_text.learn(common.read_table(spark, "/root/testdata/sf0.001", "pages"))


def test_whole_table(spark):
    pages = common.read_table(spark, "/root/testdata/sf0.01", "pages")
    got = {r.page_id: r for r in main_text.extract(pages).collect()}
    for r in pages.collect():
        want = marked_article(r.html)
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


def test_marks_are_not_needed(spark, learned):
    """The same pages with a plain div for the article, read with the weights of marked pages."""
    weights = main_text.Weights(learned)
    for r in common.read_table(spark, "/root/testdata/sf0.01", "pages").collect():
        plain = r.html.replace("<article>", "<div class='x7'>").replace("</article>", "</div>")
        assert main_text.page_text(plain, weights) == marked_article(r.html)


TITLE, FIRST, SECOND = "A title &amp; more", "First words of the <b>art</b>icle, with a <a href=/x>link</a> in them.", "Second one,\n  a bit\tlonger, ends here &lt;so&gt;."
TEXT = "A title & more First words of the article, with a link in them. Second one, a bit longer, ends here <so>."
BODY = f"<h1>{TITLE}</h1><p>{FIRST}</p><p>{SECOND}</p>"
MENU = "<ul>" + "".join(f"<li><a href=/{i}>Menu item {i}</a></li>" for i in range(6)) + "</ul>"
AD = "<div class='ad-slot'>Buy this very good thing now, it is cheap and it is good, buy it now or never again.</div>"
COMMENTS = ("<section id=comments><h2>Comments</h2><article class=comment><p>Reader says this is quite long and wrong, and goes on about it "
            "for many more words than the article itself has in it, so that length alone would take it.</p></article></section>")
SHAPES = {
    "plain article": f"<body><nav>{MENU}</nav><article>{BODY}</article><footer>© site, all rights</footer></body>",
    "main": f"<header><h1>Site name</h1>{MENU}</header><main>{BODY}</main><aside><p>Side words here to read.</p></aside>",
    "role main": f"<div role=navigation>{MENU}</div><div role='main'>{BODY}</div><div role=contentinfo>Imprint and such</div>",
    "class names": f"<div id=masthead>Site name and motto</div><div class='main-menu'>{MENU}</div><div class='post-content no-sidebar'>{BODY}</div>"
                   f"<div class='sidebar'><p>Side words here to read.</p></div><div id='footer'>Imprint</div>",
    "advert inside": f"<article><h1>{TITLE}</h1>{AD}<p>{FIRST}</p>{AD}<p>{SECOND}</p></article>",
    "comments": f"<article>{BODY}{COMMENTS}</article>{COMMENTS}",
    "comments without article": f"<div class=body>{BODY}</div>{COMMENTS}",
    "notice and form": f"<div class='cookie-notice'><p>We use cookies, and you agree to them by reading on.</p></div><form action=/s><input name=q>"
                       f"<label>Search the site</label><button>Go</button></form><article>{BODY}<form><p>Subscribe to our letter now</p></form></article>",
    "whole page in a form": f"<form id=aspnetForm><div class=nav>{MENU}</div><main>{BODY}</main></form>",
    "own header and footer": f"<header>Site name and motto of it</header><article><header><h1>{TITLE}</h1></header><p>{FIRST}</p><p>{SECOND}</p>"
                             f"<footer>Posted by someone in some place</footer></article>",
    "open elements": f"<nav>{MENU}</nav><article><h1>{TITLE}<p><b>{FIRST}<p>{SECOND}",
    "script and style": f"<script>var t='</p><p>words of a script</p>';</script><style>p > b {{}}</style><article>{BODY}<script type=x>more();</script></article>",
    "comments in the markup": f"<!-- <article><p>not this</p></article> --><article>{BODY}<!-- nor > this --></article><!-- open <p>end",
    "hidden": f"<article>{BODY}<div hidden>Words not shown</div><p style='display: none'>Nor these</p><noscript><p>Nor those</p></noscript></article>",
    "tag in quotes": f"<nav title='a > b'>{MENU}</nav><article data-x=\"<p>no</p>\">{BODY}</article>",
    "unlabelled": f"<div><div><a href=/a>Home</a> <a href=/b>News</a> <a href=/c>Contact us</a></div><div>{BODY}</div><div><a href=/i>Imprint</a></div></div>",
    "upper case": f"<NAV>{MENU}</NAV><ARTICLE>{BODY.replace('<p>', '<P>').replace('</p>', '</P>')}</ARTICLE><FOOTER>End of it</FOOTER>",
    "many names": f"<div id=siteHeader>Site and motto</div><div class='top-nav menu'>{MENU}</div><div class='alert alert-info'>Site notice of today</div><article>{BODY}"
                  f"<div class='related-posts'><p>Read this as well, it is long enough to count.</p></div><ol class=commentlist><li>Reader says so</li></ol></article>"
                  f"<div class='right-rail'><p>Popular words of other pages, many of them.</p></div><div class=siteFooter>Imprint and more</div>",
    "table layout": f"<table><tr><td class=menu>{MENU}</td><td>{BODY}</td></tr></table>",
}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("weights", ["learned", "priors"])
def test_shapes(shape, weights, learned):
    page = f"<!DOCTYPE html><html lang=en><head><title>Head title</title><meta charset=utf-8></head>{SHAPES[shape]}"
    assert main_text.page_text(page, main_text.Weights(learned if weights == "learned" else {})) == TEXT


def test_nulls_repeats_long_and_clashing(spark):
    long = "<article>" + "<p>many words in a row</p>" * 40_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", "   "), (None, "u", f"<article>{BODY}</article>"), (4, "u", long), (4, "u", long), (5, "u", "<nav>a</nav>")]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", TEXT string")
    got = sorted(((r.page_id, r.url, r.n_chars) for r in main_text.extract(df).collect()), key=str)
    n = len("many words in a row") * 40_000 + 39_999
    assert got == sorted([(1, "u", 0), (2, None, 0), (3, "u", 0), (None, "u", len(TEXT)), (4, "u", n), (4, "u", n), (5, "u", 0)], key=str)
    assert main_text.extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_best_region_against_all_regions():
    rng = random.Random(5)
    for _ in range(200):
        s = [rng.choice([-3, -1, 0, 1, 2]) for _ in range(rng.randrange(0, 12))]
        first, last = main_text.best_region(s)
        sums = [sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)]
        assert sum(s[first:last]) == max([0, *sums])


def test_broken_markup_is_read_in_linear_time():
    for bad in ("<p title=\"" * 20_000, "<" * 200_000, "<!--" * 50_000, "<a href='x" * 20_000, "&" * 200_000, "<div>" * 20_000, "</li>" * 20_000 + "<ul><li>" * 3_000):
        main_text.page_text(bad + "<p>x</p>", main_text.Weights({}))
