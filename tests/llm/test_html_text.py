"""HTML extraction against plain statements."""

import html
import re
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from corpuscle.llm import html_text

TABLES = Path("/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def tree(spark):
    return html_text.train(html_text.labelled_blocks(spark))


def _article(page):
    inside = re.split("</article>|<footer>", page.split("<article>", 1)[1])[0] if "<article>" in page else ""
    parts = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>|<[^>]*\Z", "", p))).split()) for p in re.split(r"</?(?:p|h1)>", inside)]
    return "\n\n".join(p for p in parts if p)


def test_given_pages(spark, tree):
    if not TABLES.exists():
        pytest.skip("test tables are not here")
    rows = pq.read_table(TABLES / "pages.parquet").to_pylist()
    got = {r["page_id"]: r for r in html_text.extract(spark.read.parquet(f"{TABLES}/pages.parquet"), tree).collect()}
    assert len(got) == len(rows)
    for row in rows:
        assert got[row["page_id"]]["text"] == _article(row["html"])
        assert got[row["page_id"]]["n_chars"] == len(got[row["page_id"]]["text"])


ROOM = "Here is the text of the article, long enough to look like running text to anyone who reads it."
CASES = [
    (f"<html><body><div class='top-nav'><a href=x>Home</a></div><main><h1>T</h1><p>{ROOM}</main><div id=comments><p>{ROOM}</div>", f"T\n\n{ROOM}"),
    (f"<article><p>a&nbsp;&lt;b&gt; &#233;\n\t c&hellip;</p><p>x<b>y</b>z<br>w</p><form><p>mail</p><input></form></article><aside>{ROOM}</aside>", "a <b> é c…\n\nxyz w"),
    (f"<body><script>var a='<p>no</p>';</script><style>p{{}}</style><!-- <p>no</p> --><article><p>{ROOM}</p><noscript>no</noscript></article>", ROOM),
    (f"<article><p>{ROOM}<p>Yes.<div class='advert'>{ROOM}</div><p>No.</article><footer><p>{ROOM}</footer>", f"{ROOM}\n\nYes.\n\nNo."),
    (f"<body><div id='cookieBanner'>{ROOM}</div><div class='post-content'><p>{ROOM}</p></div><div class=sidebar><p>{ROOM}</p></div>", ROOM),
    (f"<article><div role='alert'>{ROOM}</div><p style='display: none'>hidden</p><p>1 < 2 & 3 > 2</p></article>", "1 < 2 & 3 > 2"),
    (f"<article><h1>A</h1><p>{ROOM}</p><section class='reader-comments'><article><p>{ROOM}</p></article></section></article>", f"A\n\n{ROOM}"),
    ("<article><p>cut &am", "cut &am"),
    ("<article><p>cut <b", "cut"),
    ("<article><p class='lead", ""),
    ("", ""),
    (None, ""),
    ("<nav><a>x</a></nav>", ""),
    (f"<article><p>{'word ' * 200_000}</p></article>", ("word " * 200_000).strip()),
]


def test_cases(spark, tree):
    rows = [(i, None if i == 3 else "u", page, "clash") for i, (page, _) in enumerate(CASES)] + [(None, "u", CASES[0][0], ""), (0, "u", CASES[0][0], "")]
    got = html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string"), tree).collect()
    assert [(r["page_id"], r["url"], r["text"]) for r in got] == [
        *((i, None if i == 3 else "u", text) for i, (_, text) in enumerate(CASES)), (None, "u", CASES[0][1]), (0, "u", CASES[0][1])
    ]
    assert html_text.extract(spark.createDataFrame([], "page_id bigint, url string, html string"), tree).count() == 0


NAMED = [
    (f"<main class='page-with-sidebar'><h1>T</h1><p>{ROOM}</p></main>", f"T\n\n{ROOM}"),
    (f"<body><div class='top-nav'><a>Home</a></div><div id='content' class='has-sidebar'><p>{ROOM}</p></div><div class='sidebar'>{ROOM[:40]}</div>", ROOM),
    (f"<body><article class='post category-notice'><h1>T</h1><p>{ROOM}</p></article><div id='comments'><p>{ROOM} {ROOM}</p></div>", f"T\n\n{ROOM}"),
    (f"<body><article><div class='tabs-content'><p>{ROOM}</p><p>Yes.</p></div></article>", f"{ROOM}\n\nYes."),
    (f"<body><article><div class='post-header'><h1>T</h1></div><p>{ROOM}</p></article>", f"T\n\n{ROOM}"),
    (f"<body><article><header class='header'><h1>T</h1></header><p>{ROOM}</p><div class='post-comments'>{ROOM}</div></article>", f"T\n\n{ROOM}"),
    (f"<body><div class='sidebar'><main><p>{ROOM}</p></main></div><div class='site-footer'>{ROOM} {ROOM}</div>", ROOM),
    (f"<body><div class='widget'><article><p>{ROOM}</p></article></div><div class='comment-list'><article><p>{ROOM} {ROOM}</p></article></div>", ROOM),
    (f"<body><div class='tabs'><p>{ROOM}</p><p>{ROOM}</p></div><div class='cookie-notice'>{ROOM} {ROOM} {ROOM}</div>", f"{ROOM}\n\n{ROOM}"),
    (f"<main><p>{ROOM}</p><article class='promo'><p>{ROOM}</p></article></main>", f"{ROOM}\n\n{ROOM}"),
    (f"<article><p>{ROOM}</p><article class='comment'><p>{ROOM}</p></article><div class='ad'>{ROOM} {ROOM}</div></article>", ROOM),
    (f"<body><div class='related-posts'><article><p>{ROOM}</p></article></div><div class='text'><p>{ROOM} {ROOM}</p></div>", f"{ROOM} {ROOM}"),
]
# Judged by head or first part, in main text too; long footers of short articles stay out.
NAMED += [
    (f"<body><article><p>{ROOM}</p></article><div class='footer-links'>{ROOM} {ROOM}</div>", ROOM),
    (f"<body><div class='tabs'><p>{ROOM} {ROOM}</p></div><div class='related-posts'><article><p>{ROOM}</p></article></div>", f"{ROOM} {ROOM}"),
    (f"<body><p>{ROOM}</p><div class='sidebarWidget'><p>{ROOM}</p></div>", ROOM),
]


def test_names_around_main_text(tree):
    assert [html_text.main_text(page, tree) for page, _ in NAMED] == [text for _, text in NAMED]


def test_quotes_delimit_after_an_equals_sign_only():
    page = "<article><p title=it's>Hello world this is a paragraph.</p><p>I don't go, said the man, and \"stayed\" there.</p></article>"
    assert [b.text for b in html_text.blocks(page)] == ["Hello world this is a paragraph.", "I don't go, said the man, and \"stayed\" there."]
    quoted = "<article><p title = 'a > b' data-x=\"c > 'd\">One.</p></article>"
    assert [b.text for b in html_text.blocks(quoted)] == ["One."]


def test_unclosed_heads_are_read_once():
    assert html_text.blocks("<head>" * 50_000 + "<p>Text.</p>")[0].text == "Text."
