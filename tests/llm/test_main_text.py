import html
import re

import pytest

from tidelog.llm import main_text as module
from tidelog.llm.main_text import extract, main_text

ARTICLE = "<p>A long enough paragraph, with commas, stops. And some more of it, for good measure.</p>"


def test_article_of_every_page(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r for r in extract(pages).collect()}
    for r in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        words = re.sub(r"<[^>]*>", "", re.sub(r"<(h1|p|/p|/h1|br)>", " ", inside))
        expected = " ".join(html.unescape(words).split())
        assert found[r.page_id].text == expected and found[r.page_id].n_chars == len(expected)


@pytest.mark.parametrize("around", [
    "<nav><a href=x>Home</a></nav>{}<footer>&copy; us, all rights reserved.</footer>",
    "<div class='site-header'>Our site, the best.</div><div id=main>{}</div><div class='sidebar'>See also, here.</div>",
    "<table><tr><td>{}<td><div class='ad-slot'>Buy this, now!</div></table>",
    "{}<section class=comments><p>I, for one, do not agree with any of it. Not at all, never.</p></section>",
    "<aside>Aside, and more.</aside><script>var x = '<p>no, no</p>';</script>{}<form>Your name <input></form>",
    "<div class='cookie-notice'>We use cookies, sorry.</div><!-- <p>not, this</p> -->{}<noscript>Turn it on, please.</noscript>",
])
def test_only_the_article_stays(around):
    for inside in (ARTICLE * 3, f"<article><h1>Head</h1>{ARTICLE}<p>Short.{ARTICLE}</article>",
                   f"<div class='post with-sidebar'><h2>Head</h2>{ARTICLE * 2}<ul><li>one<li>two</ul></div>"):
        expected = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inside)).split())
        assert main_text(around.format(inside)) == expected


def test_broken_and_odd_pages(spark):
    assert main_text("a<b>b</b> c&amp;d&#233;&nbsp;e<br>f") == "ab c&dé e f"
    assert main_text("<p title='a > b'>x</p>") == "x"
    assert main_text("<p>a <script>'</p>'</script>b") == "a b"
    for empty in ("", "<html></html>", "<nav>menu</nav>", "<!-- never closed", "<script>x", "<div hidden>x</div>"):
        assert main_text(empty) == ""
    main_text("<p " * 50_000), main_text("<" * 50_000), main_text("<div>" * 20_000 + "x"), main_text('<a "' * 20_000)
    rows = [(1, None, None, "x"), (2, "u", "", "x"), (2, "u", f"<p>{'word, ' * 50_000}", "x"), (None, "u", ARTICLE, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = extract(pages).collect()
    assert sorted(r.n_chars for r in found) == sorted([0, 0, 299_999, len(re.sub("<.*?>", "", ARTICLE))])
    assert extract(pages.limit(0)).count() == 0


LONG = ARTICLE * 12


@pytest.mark.parametrize("parts", [
    ("<div class=lead>{}</div>", ARTICLE, "<div class=text><h2>Head</h2>{}</div>", LONG),
    ("<div class=text><h2>Head</h2>{}</div>", ARTICLE, "<div class=text><h2>More</h2>{}</div>", LONG),
    ("<main><article><h1>One</h1>{}</article>", ARTICLE, "<article><h1>Two</h1>{}</article></main>", LONG),
])
def test_all_containers_stay(parts):
    inside = parts[0].format(parts[1]) + parts[2].format(parts[3])
    expected = " ".join(re.sub(r"<[^>]*>", " ", inside).split())
    page = f"<html><body><nav><a href=x>Home</a></nav>{inside}<footer>&copy; us.</footer></body></html>"
    assert main_text(page) == expected


@pytest.mark.parametrize("around", [
    "<form id=aspnetForm action=x><div class=top-menu><a href=x>Home</a></div>{}<label>Your name</label><input></form>",
    "<article class='comments-open post'>{}</article>",
    "<article class='social-policy'>{}</article>",
    "<div class='page-navigation-wrapper'><nav><a href=x>Home</a></nav><div>{}</div></div>",
    "<p>foo bar</p><div class='share-price-report'>{}</div>",
    "<article>{}</article><div class=thread><p>No, not at all, I think.</p><p>Yes, it is, my friend.</p></div>",
    "<div class=post>{}</div><div class=comments>" + "<p>I, for one, do not agree. Not at all, never.</p>" * 60 + "</div>",
    "<form class=site><div class='comment-list'><p>No, never.</p></div><main>{}</main></form>",
    "<div class=related><article><p>Short, one.</p></article></div><article>{}</article>",
    "{}<form action=x><p>Leave us, if you want, your address.</p><span class=promo>Now!</span></form>",
])
def test_hints_alone_take_nothing_away(around):
    inside = LONG + "<p>Short end.</p>"
    found = main_text(f"<html><body>{around.format(inside)}</body></html>")
    expected = " ".join(re.sub(r"<[^>]*>", " ", inside).split())
    assert found in (expected, f"foo bar {expected}" if "foo bar" in around else expected)


def test_speech_stays_where_nothing_else_is():
    page = f"<div class=thread>{LONG}</div>"
    assert main_text(page) == " ".join(re.sub(r"<[^>]*>", " ", LONG).split())


def test_the_ratios_decide(monkeypatch):
    """Equal ratios for all paths change what stays."""
    links = "<div class=x>" + "".join(f"<p><a href=x>Link {n} to some other place of ours</a></p>" for n in range(60)) + "</div>"
    plain = f"<body>{links}<div class=text>{LONG}</div></body>"
    hinted = f"<body><div class=sidebar>{links}</div><div class=text>{LONG}</div></body>"
    expected = " ".join(re.sub(r"<[^>]*>", " ", LONG).split())
    assert main_text(plain) == main_text(hinted) == expected
    monkeypatch.setattr(module, "path_ratios", lambda found: module.np.ones(len(found)))
    assert main_text(plain) != expected and main_text(hinted) != expected
