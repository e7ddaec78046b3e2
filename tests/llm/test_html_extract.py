from __future__ import annotations

import re

import pytest

from tradewind.llm import html_extract as X


def by_hand(html):
    """Main text of the given pages, whose article has no element that is left out."""
    import html as entities

    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", html or "", re.S)
    if not inner:
        return ""
    text = re.sub(r"<[A-Za-z/!][^<>]*\Z", "", inner.group(1))
    text = re.sub(r"</?(?:p|h1)>|<br>", " ", text)
    return " ".join(entities.unescape(re.sub(r"</?b>", "", text)).split())


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, folder):
    from tradewind.llm.queries import op8_html_extraction

    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = op8_html_extraction(spark, folder).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == by_hand(pages[r.page_id].html)
        assert (r.url, r.n_chars) == (pages[r.page_id].url, len(r.text))


LONG = "This is a paragraph with a good number of words, as articles have them, one after the other."
MENU = "<ul>" + "".join(f'<li><a href="/{i}">Item {i}</a></li>' for i in range(6)) + "</ul>"

CASES = {
    "declared": (f"<nav>{MENU}</nav><article><h1>T</h1><p>{LONG}<p>So.</article><footer>F</footer>", f"T {LONG} So."),
    "undeclared": (
        f'<div class="top">Site</div>{MENU}<div><h2>A title of some length here</h2><p>{LONG}</p><p>{LONG}</p></div>'
        f'<div id="sidebar">{LONG}</div>{MENU}',
        f"A title of some length here {LONG} {LONG}",
    ),
    "inside the article": (
        f"<article><p>{LONG}</p><div class='ad box'>{LONG}</div><aside>{LONG}</aside><form>{LONG}</form>"
        f"<section id=comments><p>{LONG}</p></section><p>End.</p></article>",
        f"{LONG} End.",
    ),
    "declared by role": (f"<div class=main-menu>{MENU}</div><div role=main><p>{LONG}</p><p>So.</p></div><div>{LONG}</div>", f"{LONG} So."),
    "header of the article": (f"<header><h1>Site</h1></header><main><article><header><h2>T</h2></header><p>{LONG}</p></article></main>", f"T {LONG}"),
    "scripts": (f"<style>p{{}}</style><main><script>var a='<p>x</p>';</script><p>{LONG}</p><!-- {LONG} --></main>", LONG),
    "inline and blocks": ("<article>a<b>b</b>c<br>d\n\t e<p>f<i>g</i> &amp;&lt;&eacute;&#233;&#x1F600; h&nbsp;i</article>", "abc d e fg &<éé😀 h i"),
    "unclosed": (f"<article><p><b>{LONG}<br><p>More", f"{LONG} More"),
    "cut in a tag": (f"<article><p>{LONG}</p><p cla", LONG),
    "cut in a reference": (f"<article><p>{LONG} &am", f"{LONG} &am"),
    "stray ends": (f"</div></b><article></span><p>{LONG}</i></p></article></article><nav>x", LONG),
    "unclosed skipped": (f"<nav><ul><li>a<li>b</nav><article><p>{LONG}</article>", LONG),
    "hidden": (f"<article><p hidden>x</p><p style='display: none'>y</p><p>{LONG}</p></article>", LONG),
    "comment articles": (f"<article><p>{LONG}</p></article><div class=comments><article><p>{LONG} no</p></article></div>", LONG),
    "plain text": (LONG, LONG),
    "none": ("", ""),
    "only menu": (f"<nav>{MENU}</nav>", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_pages(name):
    html, want = CASES[name]
    assert X.main_text(html) == want
    if name not in ("plain text", "none"):
        whole = f"<!DOCTYPE html><html lang=en><head><title>t</title></head><body>{html}"
        assert X.main_text(whole) == want


def test_smoothing_and_clusters():
    assert X.smoothed(X.np.array([5.0] * 6)) == pytest.approx([5.0] * 6)
    lines = [("menu", 4, 4, -1)] * 6 + [("w" * 300, 1, 0, -1), ("Short.", 1, 0, -1), ("w" * 300, 1, 0, -1)] + [("menu", 4, 4, -1)] * 6
    assert X.content(lines) == ["w" * 300, "Short.", "w" * 300]


def test_odd_rows(spark):
    deep = "<div>" * 30_000 + LONG
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<p>" * 5), (4, "u", f"<article>{LONG}"), (4, "u", f"<article>{LONG}"), (None, None, deep), (6, "u", f"<article>{LONG * 30_000}")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = X.extract(pages.withColumns({"text": pages["page_id"], "n_chars": pages["url"]})).collect()
    want = ["", "", "", LONG, LONG, LONG, LONG * 30_000]
    assert [r.text for r in got] == want
    assert X.extract(pages.limit(0)).count() == 0


WRAPPERS = ("id=page class=site", "class=site-content", "class=no-sidebar", "class=layout-with-sidebar", "id=top", "class='page sidebar'",
            "class=header", "class='ad promo'", "class=search-results")


@pytest.mark.parametrize("attrs", WRAPPERS)
def test_wrappers_keep_the_article(attrs):
    article = f"<article><h1>T</h1><p>{LONG}</p><section id=discussion><p>{LONG}</p></section><div id=related-work>So.</div><p id=responses>End.</p></article>"
    assert X.main_text(f"<body><div {attrs}>{MENU}{article}<div class=sidebar>{LONG}</div></div><footer>{LONG}") == f"T {LONG} {LONG} So. End."
    if "ad" not in attrs.split("'")[-2:][0].split():
        assert X.main_text(f"<body><div {attrs}>{MENU}<p>{LONG}</p><p>{LONG}</p></div><div class=sidebar>{LONG}</div>") == f"{LONG} {LONG}"


def test_forms_and_held_parts():
    assert X.main_text(f"<form id=aspnetForm>{MENU}<main><p>{LONG}</p><div class=widget>x</div></main></form>") == LONG
    assert X.main_text(f"<form>{MENU}<p>{LONG}</p><p>{LONG}</p></form>") == f"{LONG} {LONG}"
    assert X.main_text(f"<article><p>{LONG}</p></article><div class=modal><article><p>{LONG} {LONG}</p></article></div>") == LONG
    assert X.main_text(f"<div><p>{LONG}</p></div><div class=comments><article><p>{LONG} {LONG}</p></article></div>") == LONG


def test_links_within_the_article():
    share = "<p>Share: <a href=/f>Facebook</a> <a href=/t>Twitter</a> <a href=/m>Mail</a></p>"
    one = "<p><a href=/r>See the whole report of the commission here</a></p>"
    table = "<table><tr><th>n<td>1<tr><th>m<td>2</table>"
    page = f"<article><h1>T</h1>{share}<p>{LONG}</p>{one}<p>{LONG}</p>{share}<p>So.</p>{MENU}<p>{LONG}</p>{table}{MENU}{share}</article>"
    want = f"T {LONG} See the whole report of the commission here {LONG} So. {LONG} n 1 m 2"
    assert X.main_text(page) == want
    assert X.main_text(f"<main>{share}</main><div><p>{LONG}</p><p>{LONG}</p></div>{MENU}") == f"{LONG} {LONG}"
    assert X.main_text(f"<article><a href=/x><p>{LONG}</p></a></article>") == LONG
    assert X.main_text(f"<article><a name=x><p>{LONG}</p><p>So.</p></article>") == f"{LONG} So."


def test_short_region_beside_a_dense_one():
    assert X.main_text(f"<article><p>Brief.</p></article><article><p>{LONG * 20}</p><p>{LONG * 20}</p><p>{LONG * 20}</p></article>") == " ".join(["Brief."] + [LONG * 20] * 3)


HOSTILE = ("<div class=sidebar>x", "<a ", "<a>", "<a href=\"", "<a x <", "<div></i>", "<div><li></li>", "<b><hr>", "<b><a href=x>", "<a href=x><div>z</a>")


@pytest.mark.parametrize("unit", HOSTILE)
def test_broken_pages_take_time_in_proportion(unit):
    import time

    begun = time.process_time()
    for end in ("", ">"):
        X.main_text(f"<i>{unit * 50_000}{end}")
    assert time.process_time() - begun < 20


def test_text_after_an_unfinished_tag():
    assert X.main_text(f"<article><p>{LONG}</p><a <a <b c") == LONG
    assert X.main_text(f"<article><p>{LONG} 1 < 2") == f"{LONG} 1 < 2"


def test_ratios_decide_in_a_declared_article(monkeypatch):
    """Short lines after a list of links are no content, dense ones are, with what lies between."""
    short, share = "<p>Printed on paper.</p>", "<p><a href=/f>F</a> <a href=/t>T</a></p>"
    assert X.main_text(f"<article><h1>T</h1>{share}<p>{LONG}</p><p>So.</p>{MENU}{short}</article>") == f"T {LONG} So."
    assert X.main_text(f"<article>{short}{MENU}<h1>T</h1><p>{LONG}</p></article>") == f"T {LONG}"
    between = f"<article><p>{LONG}</p>{MENU}{short}{MENU}<p>{LONG}</p></article>"
    assert X.main_text(between) == f"{LONG} Printed on paper. {LONG}"
    monkeypatch.setattr(X, "dense", lambda ratios: X.np.ones(len(ratios), bool))
    assert X.main_text(f"<article><p>{LONG}</p>{MENU}{short}</article>").endswith("Printed on paper.")
    monkeypatch.setattr(X, "dense", lambda ratios: X.np.zeros(len(ratios), bool))
    assert X.main_text(between) == "" == X.main_text(f"<p>{LONG}</p>")


def test_marks_within_marks():
    inner = f"<div class=widget><div class=sidebar>{LONG}</div><article><p>{LONG}</p><div class=widget>x</div></article></div>"
    assert X.main_text(f"<div class='page sidebar'>{inner}</div><div class=share>{LONG}</div>") == LONG
    two = f"<div class=sidebar><article><p>{LONG}</p></article></div>"
    assert X.main_text(f"{two}<article><p>{LONG} b</p></article>") == f"{LONG} b"
