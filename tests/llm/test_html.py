import re
import time

import pytest

from tripcraft.llm import html


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("a &lt; b &amp;\n c", "a < b & c"), ("<p>x", "x"), ("<div>" * 3000 + "deep", "deep"),
    ("<article><p>tiny</p></article><footer>a very long footer text with many words in it</footer>", "tiny"),
    ("<body><div id=nav><a href=x>Home</a></div><div class='cookie-notice'>We use cookies here</div><main><article><header>"
     "<h1>T &lt; U</h1></header><p>One two three four five six.<p>Short<ul><li>a<li>b</ul><aside>side</aside><form><input>Send"
     "</form></article><section class=comments><p>I think this is a long comment</p></section></main><footer>f</footer>",
     "T < U\nOne two three four five six.\nShort\na\nb"),
    ("<body><nav>menu menu</nav><div class=content><h2>Head</h2><p>First   line<br>goes on.</p><p>Second <b>bold</b>.</p></div>"
     "<script>var x='<p>no</p>'</script><!-- <p>no</p> --><div class='ad'>Buy this</div></body>",
     "Head\nFirst line goes on.\nSecond bold."),
])
def test_cases(page, text):
    assert html.extract(page) == text


@pytest.mark.parametrize(("page", "text"), [
    ("<body><p class=ad>Buy<p>Article 1<p>Article 2</body>", "Article 1\nArticle 2"),
    ("<body><ul><li class=ad>Buy<li>Article 1<li>Article 2</ul></body>", "Article 1\nArticle 2"),
    ("<body><table><tr><td class=sidebar>Buy<td>Article 1<tr><td>Article 2</table></body>", "Article 1\nArticle 2"),
    ("<body><div><nav><a href=x>Home</a></div><div><p>Article 1</p><p>Article 2</p></div></body>", "Article 1\nArticle 2"),
    ("<body><div><p class=ad>Buy</div><ul><li class=promo>Buy</ul><div>Article 1</div></body>", "Article 1"),
    ("<body><span class=ad><div>Buy</span>Article 1</body>", "Article 1"),
    ("<body><p>Article 1 <button>Buy<div>now</div></button> goes on</body>", "Article 1 goes on"),
    ("<head><title>T</title><meta name=x><body><p>Article 1", "Article 1"), ("<head><title>T</title>Article 1", "Article 1"),
])
def test_unclosed_unwanted_elements(page, text):
    """Implied ends and ends of ancestors end what is skipped."""
    assert html.extract(page) == text


_LONG = "One two three four five six, seven eight nine ten."


@pytest.mark.parametrize("wrapper", ["div class='content-sidebar-wrap'", "div class='page has-sidebar'", "div id='page-with-nav'",
                                     "section class='post related'", "form action=x", "body class=x><form", "div hidden"])
@pytest.mark.parametrize("inside", [f"<p>{_LONG}</p>", f"<main><p>{_LONG}</p></main>", f"<article><p>{_LONG}</p></article>"])
def test_wrappers_stay(wrapper, inside):
    """Marked elements and forms around the text; what is marked inside them still goes."""
    end = "</form>" if "form" in wrapper else f"</{wrapper.split()[0]}>"
    page = f"<{wrapper}>{inside}<div class=ad>Buy this</div>{end}<footer>{_LONG} {_LONG}</footer></body>"
    assert html.extract(page) == _LONG


@pytest.mark.parametrize(("page", "text"), [
    (f"<body><nav>Menu<article><p>{_LONG}</p></article></body>", _LONG),  # never closed
    (f"<body><div class=promo><article>{_LONG}</article></div><div class=promo><article>{_LONG}!</article></div></body>", f"{_LONG}\n{_LONG}!"),
    (f"<article><p>Post</p><section class=comments><article>{_LONG}</article><article>{_LONG}</article></section></article>", "Post"),
    (f"<article><p>{_LONG}</p></article><aside><article>Other</article></aside>", _LONG),
])
def test_what_is_no_wrapper(page, text):
    assert html.extract(page) == text


@pytest.mark.parametrize(("page", "text"), [
    # articles inside an article that has text of its own are reader comments; a heading alone makes it a wrapper
    (f"<article><p>Post</p><p>More</p><article><p>{_LONG}</p><p>{_LONG}</p></article></article>", "Post\nMore"),
    (f"<article>Post<article><p>{_LONG}</p></article></article>", "Post"),
    (f"<article><h1>Head</h1><article><p>{_LONG}</p></article></article>", f"Head\n{_LONG}"),
    ("<body><p>First part.</p><p class=x don't>Second part.</p><p>Third part.</p></body>", "First part.\nSecond part.\nThird part."),
    ("<p title='a > b' alt=\"c'd\" e=f\"g>One</p><p x = 'y'>Two</p>", "One\nTwo"),
    (f"<body><div><h1>Head</h1><p><b>a</b> <i>b</i> {_LONG}</p></div></body>", f"Head\na b {_LONG}"),
    (f"<body><div><a href=x>Home</a> <a href=y>News</a></div><div><p>{_LONG}</p><p>{_LONG}</p></div></body>", f"{_LONG}\n{_LONG}"),
    (f"<body><ul><li><a href=x>One</a><li><a href=y>Two</a></ul><div><h2>Head</h2><p>{_LONG}</p></div></body>", f"Head\n{_LONG}"),
])
def test_choice_of_the_subtree(page, text):
    """The outermost article; without articles, the density alone."""
    assert html.extract(page) == text


def test_pages_without_article_tags(spark, sf01):
    """The density finds the same text with every article turned into a div."""
    for r in spark.read.parquet(f"{sf01}/pages.parquet").collect():
        assert html.extract(re.sub("<(/?)article", r"<\1div", r.html)) == html.extract(r.html)


@pytest.mark.parametrize("name", ["span", "div", "b"])
def test_deep_pages_take_linear_time(name):
    page = "<body>" + f"<{name}>" * 20_000 + "".join(f"<p>part {k}</i></p>" for k in range(3000))
    start = time.process_time()
    assert html.extract(page) == "\n".join(f"part {k}" for k in range(3000))
    assert time.process_time() - start < 3


def test_query_equals_articles(spark, sf01):
    """On the pages of the data, the article's blocks by a plain split of the markup."""
    import html as standard
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf01}/pages.parquet").collect()}
    got = html.op3_html(spark, sf01).collect()
    assert len(got) == len(pages)
    for r in got:
        page = pages[r.page_id]
        body = page[page.index("<article>"):]
        body = body[:body.find("</article>") if "</article>" in body else body.find("<footer")]
        blocks = (re.sub(r"\s+", " ", standard.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", body))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_frames(spark):
    df = spark.createDataFrame([(1, None, "u", 3), (1, None, "u", 3), (None, "<p>a</p>" * 20000, None, None)],
                               "page_id long, html string, text string, row int")
    assert sorted(r.n_chars for r in html.main_text(df).collect()) == [0, 0, 39999]
    assert html.main_text(df.limit(0)).count() == 0
