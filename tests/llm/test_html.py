import html
import random
import re
import time

import pytest

from plumeledger.llm import html_extraction as h

PROSE = "Long text here, with words. And more of them, of course; this goes on for a while."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("   <p> </p>", ""),
        ("plain   text", "plain text"),
        ("a < b and <b>c</b>d", "a < b and cd"),
        ("<p>a<p>b", "a\nb"),
        ("<p>unclosed <!-- c", "unclosed"),
        ("<script>x", ""),
        (f"<p>x &lt; y &amp; &eacute;&nbsp;{PROSE}", f"x < y & é {PROSE}"),
        (f"<article><h1>T</h1><p>{PROSE}<br>next</p><ul><li>one<li>two</ul></article>", f"T\n{PROSE} next\none\ntwo"),
        (f"<div class=content><p>{PROSE}</p></div><div id='comments'><p>{PROSE}</p></div>", PROSE),
        (f"<header>Head, er.</header><main><section><p>{PROSE}</p></section><aside>Side.</aside><section><p>{PROSE}</p></section></main><form>Name <input></form><footer>F.</footer>", f"{PROSE}\n{PROSE}"),
        (f"<nav><ul><li><a href=x>Home, sweet</a></ul></nav><p>{PROSE}</p><div class='cookie-notice'>{PROSE}</div>", PROSE),
        (f"<p>{PROSE}</p><script>if (a<b) document.write('</p><p>no, no.</p>')</script><style>p>b{{}}</style>", PROSE),
        (f"<p title='a>b'>{PROSE}</p><div style='display: none'>{PROSE} {PROSE}</div>", PROSE),
        ("<P>UPPER, case.</P><DIV CLASS=AD>no, no.</DIV>", "UPPER, case."),
    ],
)
def test_pages(page, text):
    assert h.main_text(page) == text


LINKS = "<ul><li><a href=x>First source</a><li><a href=y>Second source</a></ul>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<article><h1>Title</h1><div class=body><p>{PROSE}</p><p>{PROSE}</p></div></article>", f"Title\n{PROSE}\n{PROSE}"),
        (f"<div><div>{f'<p>{PROSE}</p>' * 20}</div><section><p>Short, it is.</p></section></div>", "\n".join([*[PROSE] * 20, "Short, it is."])),
        (
            f"<article><h1>T</h1><div>{f'<p>{PROSE}</p>' * 20}</div><ul><li>one<li>two</ul><table><tr><td>x<td>y</table>"
            "<section><p>Short, it is.</p></section></article>",
            "\n".join(["T", *[PROSE] * 20, "one", "two", "x", "y", "Short, it is."]),
        ),
        (f"<article><p>{PROSE}</p><p>{PROSE}</p>{LINKS}</article>", f"{PROSE}\n{PROSE}\nFirst source\nSecond source"),
        (f"<main><h1>T</h1><article><div><p>{PROSE}</p></div>{LINKS}</article></main>{LINKS}", f"T\n{PROSE}\nFirst source\nSecond source"),
    ],
)
def test_blocks_beside_the_paragraphs(page, text):
    assert h.main_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        *[
            (f"<div class='{name}'><article><h1>T</h1><p>{PROSE}</p></article></div>", f"T\n{PROSE}")
            for name in ("container no-sidebar", "layout has-comments", "widget-content", "sidebar", "page header")
        ],
        *[
            (f"<div class='{name}'><p>{PROSE}</p><p>{PROSE}</p></div><div class=ad>Buy, now.</div>", f"{PROSE}\n{PROSE}")
            for name in ("layout with-right-sidebar", "widget-content", "sidebar")
        ],
        (f"<article><h1 class='article-header'>T</h1><p>{PROSE}</p></article>", f"T\n{PROSE}"),
        (f"<article><h1>T</h1><div class=widget-content><p>{PROSE}</p></div></article>", f"T\n{PROSE}"),
        (f"<div aria-hidden=true><main><p>{PROSE}</p></main></div>", PROSE),
        (f"{f'<div class=widget><p>{PROSE}</p></div>' * 3}", f"{PROSE}\n{PROSE}\n{PROSE}"),
        # What is marked stays out where the prose is elsewhere.
        (f"<div class='has-comments sidebar'><article><p>{PROSE}</p></article><div id=comments>{f'<p>{PROSE}</p>' * 9}</div></div>", PROSE),
        (f"<main><article><p>{PROSE}</p></article><div class=related><article><p>{PROSE}</p></article></div></main>", PROSE),
        (f"<div class=sidebar><div class=comments><p>{PROSE}</p></div><main><p>{PROSE}</p></main></div>", PROSE),
        (f"<div class=ad>{PROSE}</div><article><h1>T.</h1><p>Short.</article>", "T.\nShort."),
        (f"<div class=related>{PROSE}</div><article><h1>T.</h1><p>Short.</article>", "T.\nShort."),
        (f"<nav>Home</nav><div class='top ad'>{PROSE}</div>", ""),
        (f"<div hidden><article><p>{PROSE}</p></article></div><p>{PROSE}</p>", PROSE),
    ],
)
def test_marks_around_the_prose(page, text):
    assert h.main_text(page) == text


def test_articles_of_the_given_pages(spark, sf_dir):
    """These pages mark their article, so a plain reading of it is the truth."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r["page_id"]: r for r in h.extract(pages).collect()}
    for row in pages.collect():
        inside = re.search(r"<article>(.*?)(</article>|\Z)", row["html"], re.S)
        pieces = re.split(r"</?(?:p|h1)>", inside[1] if inside else "")
        plain = [" ".join(html.unescape(re.sub(r"<[^>]*(>|\Z)", " " , x)).split()) for x in pieces]
        text = "\n".join(x for x in plain if x)
        assert found[row["page_id"]]["text"] == text
        assert found[row["page_id"]]["n_chars"] == len(text) and found[row["page_id"]]["url"] == row["url"]


def test_any_markup_is_read():
    rng = random.Random(1)
    parts = ["<p>", "</p>", "<div class='ad'>", "</div>", "<b", ">", "<!--", "-->", "text, more.", "&amp;", "<a href='", "<li>", "</", "<script>", "<td>", "<br/>", "é"]
    for _ in range(3000):
        assert isinstance(h.main_text("".join(rng.choices(parts, k=rng.randint(1, 25)))), str)
    assert h.main_text("<div>" * 20_000 + PROSE) == PROSE


def test_odd_tables(spark):
    rows = [(1, "u", None), (None, None, f"<p>{PROSE}"), (2, "u", f"<p>{PROSE}"), (2, "u", f"<p>{PROSE}")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "1 as n_chars")
    found = sorted(map(repr, (tuple(r) for r in h.extract(df).collect())))
    assert found == sorted(map(repr, [(1, "u", "", 0), (None, None, PROSE, len(PROSE)), (2, "u", PROSE, len(PROSE)), (2, "u", PROSE, len(PROSE))]))
    assert h.extract(df.limit(0)).collect() == []


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<div><p>{PROSE}</p><p>{PROSE}</p>{LINKS}</div>{LINKS}", f"{PROSE}\n{PROSE}\nFirst source\nSecond source"),
        (f"<body>{LINKS}<h1>T</h1><p>{PROSE}</p><ul><li>one<li>two</ul><p>{PROSE}</p><h2>More</h2><div>Buy.</div></body>", f"T\n{PROSE}\none\ntwo\n{PROSE}"),
        (f"<article><a title=it's>link</a><p>{PROSE}</p></article>", f"link\n{PROSE}"),
        (f"<p title=a\"b>{PROSE}</p><p data-x = '>'>{PROSE}</p>", f"{PROSE}\n{PROSE}"),
        (f"<header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>{PROSE}</p></article>", f"Title\n{PROSE}"),
    ],
)
def test_nothing_else_is_lost(page, text):
    assert h.main_text(page) == text


def article_of(page):
    inside = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)
    pieces = re.split(r"</?(?:p|h1)>", inside[1] if inside else "")
    plain = [" ".join(html.unescape(re.sub(r"<[^>]*(>|\Z)", " ", x)).split()) for x in pieces]
    return "\n".join(x for x in plain if x)


@pytest.mark.parametrize("tag", ["div", ""])
def test_ratios_decide_without_article_tags_and_class_words(spark, sf_dir, tag, monkeypatch):
    """The given pages with other tags for their article, or none, and no class of the advert."""
    pages = [r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    strip = lambda page: re.sub(
        r"<(/?)article>", rf"<\1{tag}>" if tag else "", re.sub(r' class="[^"]*"', "", page)
    )
    right = sum(h.main_text(strip(page)) == article_of(page) for page in pages)
    # An advert as long as the only paragraph cannot be told from it by ratios.
    assert right >= 0.9 * len(pages)
    monkeypatch.setattr(h, "prose_paths", lambda found: {b.path: float(len(b.text)) for b in found})
    assert sum(h.main_text(strip(page)) == article_of(page) for page in pages) < 0.1 * len(pages)


def test_deep_nesting_takes_time_by_its_depth():
    seconds = {}
    for n in (1000, 10_000, 40_000):
        page = "<div>x" * n + f"<p>{PROSE}" + "</div>" * n
        start = time.perf_counter()
        assert PROSE in h.main_text(page)
        seconds[n] = time.perf_counter() - start
    assert seconds[40_000] < 8 * seconds[10_000] + 0.5
