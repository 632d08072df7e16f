"""Main text of HTML pages from flat text blocks.

A page is read once, tag by tag, into a flat list of text blocks. A block has its
number of words, its share of words inside links, those of its neighbours, and
what the tags around it say. A decision tree, trained by Spark ML on a small
labelled table, tells main text from the rest.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession

DEPTH = 6

# Fixed values of HTML: elements whose content is no text, elements without content,
# elements that don't break a line of text, elements that hold blocks.
RAW = frozenset("script style noscript template iframe object embed svg math canvas audio video head title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q s samp small span "
    "strike strong sub sup time tt u var wbr br".split()
)
HOLDERS = frozenset(
    "html body div section article main aside header footer nav form ul ol dl table thead tbody tr td th fieldset "
    "figure details dialog menu address blockquote center button select textarea option".split()
)
MAIN = frozenset(["article", "main"])
BESIDE = frozenset(["nav", "aside", "footer", "form", "dialog", "menu", "button", "select", "textarea", "option", "fieldset"])
BESIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
# Words of class names and ids that sites use for what isn't the article.
BESIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense adslot banner sponsor sponsored promo promotion promoted "
    "cookie cookies consent gdpr privacy notice notices notification alert popup modal overlay dialog toast "
    "sidebar sidebars aside rail widget widgets nav navbar navigation menu menus breadcrumb breadcrumbs toc topbar toolbar tabs "
    "header masthead footer foot bottom copyright legal comment comments commentlist disqus respond reply replies "
    "discussion reader-comments share sharing social follow related recommended recommendations more-articles readmore trending "
    "newsletter subscribe subscription signup login register search searchbox form pagination pager paging tags tagcloud author-box hidden".split()
)
# Of these: names of what readers or advertisers add, so that a large element of such a name is still not the article.
ADDED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense adslot sponsor sponsored cookie cookies consent gdpr "
    "comment comments commentlist disqus respond reply replies reader-comments hidden".split()
)
# Parts of compound names. Some tell of a state, style or subject, not of what the element is; some only
# say that it is a box, so that the part before them is the head; heads that are text, after names of mere layout;
# and what the header of a text is called after.
STATE_PARTS = frozenset("with without has no not non overflow margin padding border long".split())
SUBJECT_PARTS = frozenset("category tag tagged format status type".split())
BOX_PARTS = frozenset("container wrapper wrap inner outer box area list item items links block section left right col column group row".split())
TEXT_PARTS = frozenset("content contents body text main article post entry story page panel pane layout".split())
LAYOUT_PARTS = frozenset(
    "tabs form widget widgets notice notices alert overlay modal dialog header masthead search legal privacy bottom tags share social rail".split()
)
HEADERS = frozenset(["header", "masthead"])
TITLED_PARTS = frozenset("post article entry story content page section single title blog".split())

# What an element's tag and attributes say: nothing, a name of BESIDE_NAMES, one of ADDED_NAMES, or that it is beside for sure.
NOTHING, NAMED, ADDED, SURE = range(4)

FEATURES = (
    "words", "link_density", "previous_words", "previous_link_density", "next_words", "next_link_density",
    "in_main", "beside", "heading", "page_has_main",
)

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)|<[a-zA-Z/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*))|([^\s=/\"'>]+)")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    in_main: bool
    beside: bool
    heading: bool


def _named(name: str, tag: str, in_main: bool) -> int:
    """What one class name or id says. A compound is judged by its head or, failing that, by its first part."""
    parts = [p.lower() for p in _NAME_PARTS.findall(name)]
    if name.lower() in BESIDE_NAMES:
        parts = [name.lower()]
    elif not parts or STATE_PARTS.intersection(parts) or parts[0] in SUBJECT_PARTS or (in_main and tag == "header"):
        return NOTHING
    while len(parts) > 1 and parts[-1] in BOX_PARTS:
        parts.pop()
    first, head = parts[0], parts[-1]
    if head in TEXT_PARTS and first in LAYOUT_PARTS:
        return NOTHING
    if head in HEADERS and (in_main or first in TITLED_PARTS):
        return NOTHING
    if head not in BESIDE_NAMES and first not in BESIDE_NAMES:
        return NOTHING
    if head not in BESIDE_NAMES and first in HEADERS and in_main:
        return NOTHING
    return ADDED if head in ADDED_NAMES or first in ADDED_NAMES else NAMED


def _mark(tag: str, attributes: str, in_main: bool) -> int:
    """What tag and attributes say of an element by themselves."""
    if tag in BESIDE or (tag == "header" and not in_main):
        return SURE
    if not attributes.strip() or tag in ("html", "body"):
        return NOTHING
    said = NOTHING
    for match in _ATTRIBUTE.finditer(attributes):
        name = (match[1] or match[5]).lower()
        value = html.unescape(match[2] or match[3] or match[4] or "")
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return SURE
        if name == "role" and BESIDE_ROLES.intersection(value.lower().split()):
            return SURE
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return SURE
        if name in ("class", "id"):
            for one in value.split():
                said = max(said, _named(one, tag, in_main))
    return said


class _Element:
    """An element that holds blocks: what it says of itself, and what is found in it."""

    __slots__ = ("above", "tag", "outer_main", "in_main", "mark", "own", "words", "holds", "beside")

    def __init__(self, above: _Element | None, tag: str, mark: int):
        self.above, self.tag, self.mark = above, tag, mark
        self.outer_main = above is not None and above.in_main
        self.in_main = self.outer_main or tag in MAIN
        # Words outside links: directly in it, and in all of it. ``holds``: the tags of MAIN in it.
        self.own = self.words = 0
        self.holds: set[str] = set()
        self.beside = False


def _settle(elements: list[_Element]) -> None:
    """Say which elements are beside the main text; ``elements`` has those that hold others first.

    A name does not count where its element holds ``main``; nor, where no main
    text would stand otherwise, if it holds an article that isn't outweighed by
    what no name marks, or most of the page's words outside links. Comments and
    adverts need both, an article and most words.
    """
    # Nothing in what is beside for sure weighs or is held.
    for e in elements:
        e.beside = e.mark == SURE or (e.above is not None and e.above.beside)
    added = 0
    for e in reversed(elements):
        if e.beside:
            continue
        e.words += e.own
        if e.mark and not e.outer_main and "main" in e.holds:
            e.mark = NOTHING
        if e.mark == ADDED:
            added += e.words
        elif e.above is not None:
            e.above.words += e.words
            e.above.holds |= e.holds
            if e.tag in MAIN:
                e.above.holds.add(e.tag)
    total = elements[0].words
    _, standing = _unmarked(elements)
    for e in elements:
        # Where main text stands, what is most of the page outside of it is a long footer, say.
        if e.mark == NAMED and 2 * e.words > total and (e.outer_main or not standing):
            e.mark = NOTHING
    free, standing = _unmarked(elements)
    for e in elements:
        enough = e.mark == NAMED or (e.mark == ADDED and 2 * e.words > total + added)
        if enough and not standing and not e.outer_main and "article" in e.holds and e.words >= free:
            e.mark = NOTHING
    for e in elements:
        e.beside = e.mark != NOTHING or (e.above is not None and e.above.beside)


def _unmarked(elements: list[_Element]) -> tuple[int, int]:
    """Words outside links in what nothing marks, and those of them in main text."""
    marked: set[int] = set()
    words = main = 0
    for e in elements:
        if e.mark or (e.above is not None and id(e.above) in marked):
            marked.add(id(e))
        else:
            words += e.own
            main += e.own if e.in_main else 0
    return words, main


def blocks(page: str | None) -> list[Block]:
    """The text blocks of a page in order: references decoded, each blank run one space."""
    out: list[Block] = []
    # All elements that hold blocks, what is open of them, and the element of each block.
    elements = [_Element(None, "", NOTHING)]
    open_ = elements[:]
    owners: list[_Element] = []
    text: list[str] = []
    links: list[str] = []
    link_depth = 0
    heading = endless_head = False
    at = 0
    page = page or ""

    def flush() -> None:
        nonlocal text, links
        joined = " ".join(html.unescape("".join(text)).split())
        if joined:
            linked = len(html.unescape("".join(links)).split())
            out.append(Block(joined, len(joined.split()), linked, open_[-1].in_main, False, heading))
            owners.append(open_[-1])
            open_[-1].own += max(0, out[-1].words - linked)
        text, links = [], []

    while at < len(page):
        match = _TAG.search(page, at)
        end = match.start() if match else len(page)
        if end > at:
            text.append(page[at:end])
            if link_depth:
                links.append(page[at:end] + " ")
        if not match:
            break
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        closing = match[1] == "/"
        if tag in RAW:
            if tag not in ("svg", "math", "embed"):
                flush()
            if tag == "head" and endless_head:
                continue
            if not closing and tag not in VOID and not match[3].rstrip().endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}\s*>" + (r"|<body\b|</head" if tag in ("head", "title") else ""), re.I).search(page, at)
                # Text after an unclosed element isn't text of the page; a head ends where the body begins.
                if tag == "head" and stop is None:
                    endless_head = True
                    continue
                at = len(page) if stop is None else (stop.start() if stop[0].lower().startswith("<body") else stop.end())
            continue
        if tag == "br" or tag == "wbr":
            text.append(" " if tag == "br" else "")
            continue
        if tag == "a":
            link_depth = max(0, link_depth + (-1 if closing else 1)) if not closing or link_depth else 0
            link_depth = min(link_depth, 1)
            continue
        mark = NOTHING if closing else _mark(tag, match[3], open_[-1].in_main)
        if tag in INLINE and not (not closing and match[3].strip() and mark):
            if tag == "span" and closing and any(e.tag == "span" for e in open_):
                pass
            else:
                continue
        flush()
        if re.fullmatch("h[1-6]", tag):
            heading = not closing
            continue
        if tag in VOID:
            continue
        if closing:
            for i in range(len(open_) - 1, 0, -1):
                if open_[i].tag == tag:
                    # Inline elements and paragraphs don't close what holds them.
                    del open_[i:]
                    link_depth = 0
                    break
        elif tag in HOLDERS or (tag in INLINE) or match[3].strip():
            if tag in ("p", "li", "dt", "dd", "pre") and not mark:
                continue
            if mark in (NAMED, ADDED) and tag in MAIN and not (mark == ADDED and any(e.tag == "article" for e in open_)):
                # Names don't mark main text, but an article within another may be a comment.
                mark = NOTHING
            # Comments and adverts stay outside even where an article element holds them.
            elements.append(_Element(open_[-1], tag, mark))
            open_.append(elements[-1])
    flush()
    _settle(elements)
    out = [b._replace(beside=e.beside) if e.beside else b for b, e in zip(out, owners, strict=True)]
    return out


def features(found: list[Block]) -> list[list[float]]:
    """The features of each block, in the order of ``FEATURES``."""
    density = [b.linked / b.words if b.words else 0.0 for b in found]
    has_main = float(any(b.in_main and not b.beside for b in found))
    rows = []
    for i, b in enumerate(found):
        before, after = (i - 1 if i else None), (i + 1 if i + 1 < len(found) else None)
        rows.append(
            [
                float(b.words), density[i],
                0.0 if before is None else float(found[before].words), 0.0 if before is None else density[before],
                0.0 if after is None else float(found[after].words), 0.0 if after is None else density[after],
                float(b.in_main), float(b.beside), float(b.heading), has_main,
            ]
        )
    return rows


# Pages whose blocks are the labelled table: ``+`` before the main text, ``-`` before the rest.
_LABELLED = (
    """<body><header>-Daily News</header><nav><ul><li><a>-Home</a><li><a>-World and local news</a></ul></nav><main><h1>+A day at the
    coast</h1><p>+The sea was calm when the boats went out that morning and nobody in the village expected the storm.</p><p>+Yes.</p>
    <p>+<a>A link that is the whole paragraph</a></p><div class="ad">-Buy two lamps and get a third one free, this week only in all our shops.</div>
    <p>+In the evening the wind turned.</p></main><aside>-More stories that you may like to read later on, chosen by our editors</aside>
    <footer>-All rights reserved.</footer></body>""",
    """<body><div id="nav"><a>-Start</a> <a>-Archive</a></div><article><header><h1>+Bread</h1></header><p>+Flour, water, salt.</p><p>+Mix all of it and
    let it rest for several hours in a warm place, then fold it twice.</p><section class="comments"><p>-Great recipe, I made it twice
    and everyone in the family asked for more of it on the next day!</p></section></article><div class="footer">-Imprint</div></body>""",
    """<body><div class="menu"><a>-News</a></div><h1>+Old page</h1><p>+A page without any article element still has paragraphs of running text
    that are longer than its menus and that hardly hold a link at all.</p><p>+Short one here.</p><p>+Its second long paragraph tells how the town
    hall was built, by whom it was paid, and why it took ten years to finish.</p><ul><li><a>-First link in a list</a></li><li><a>-Second link
    in a list</a></li><li><a>-Third</a></li></ul><div class="cookie-notice">-We use cookies to make this site better for you, do you agree with
    that or not?</div></body>""",
    """<body><div><a>-One</a> <a>-Two</a></div><div><a>-Read this next: ten ways to mend a bicycle</a></div><p>+Plain text about a bicycle whose chain came
    off on the way down from the pass, and how it was mended with a shoelace.</p><p>+It held.</p><div><a>-Contact</a></div></body>""",
    """<body><form>-Your name <input></form><article><h2>+Notes</h2><p>+One.</p><p>+Two words.</p><ul><li>+An item of a list within the article</li><li><a>+Source
    of the article</a></li></ul><aside>-A box at the side of the article with some more words in it</aside></article></body>""",
    """<body><div class="top-nav"><a>-Start</a> <a>-Topics</a></div><main class="page-with-sidebar"><div class="post-header"><h1>+Clocks</h1></div>
    <div class="tabs-content"><p>+The oldest clock of the town has one hand only, and it is wound by a baker every morning before work.</p><p>+It is
    late.</p></div><div class="sidebar">-Clocks for sale in many sizes, also by mail</div></main><div class="site-footer">-Imprint</div></body>""",
    """<body><div class="main-menu"><a>-Home</a> <a>-Maps</a></div><div id="content" class="has-sidebar"><p>+The path begins behind the mill, follows
    the stream for an hour and then climbs through old woods to the ridge above the lake.</p><p>+From there one sees both valleys, and on clear
    days even the glaciers far in the south of the country.</p></div><div class="sidebar">-Huts nearby, with beds for all</div></body>""",
)


def labelled_blocks(spark: SparkSession) -> DataFrame:
    """The small labelled table: features and ``main`` of about eighty blocks."""
    rows = []
    for page in _LABELLED:
        found = blocks(page)
        bare = [b._replace(text=re.sub("[+-]", "", b.text)) for b in found]
        for block, row in zip(found, features(bare), strict=True):
            rows.append((*row, float(block.text.lstrip().startswith("+"))))
    return spark.createDataFrame(rows, [*FEATURES, "main"])


def train(labelled: DataFrame, depth: int = DEPTH):
    """Fit the tree; nested tuples (feature, threshold, left, right), leaves are booleans."""
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(labelled)
    model = DecisionTreeClassifier(featuresCol="_features", labelCol="main", maxDepth=depth, maxBins=64).fit(assembled)

    def walk(node):
        if node.subtreeDepth() == 0:
            return node.prediction() >= 0.5
        split = node.split()
        return split.featureIndex(), split.threshold(), walk(node.leftChild()), walk(node.rightChild())

    return walk(model._java_obj.rootNode())


def is_main(tree, row: list[float]) -> bool:
    while isinstance(tree, tuple):
        feature, threshold, left, right = tree
        tree = left if row[feature] <= threshold else right
    return tree


def main_text(page: str | None, tree) -> str:
    found = blocks(page)
    return "\n\n".join(b.text for b, row in zip(found, features(found), strict=True) if is_main(tree, row))


def extract(pages: DataFrame, tree=None, *, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars``: main text of whole pages, a row per row.

    Blocks are joined in page order by an empty line. A null or empty page, or
    one without main text, has an empty text; broken or unclosed markup is read
    as far as it goes; repeated rows and null keys are rows of their own; other
    columns are ignored. ``tree``: of ``train``, by default on the own table.
    """
    tree = train(labelled_blocks(pages.sparkSession)) if tree is None else tree

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A few pages at a time: texts of a whole batch may be large.
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(value.as_py(), tree) for value in part.column(2)]
                yield pa.record_batch(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    narrow = pages.selectExpr(f"cast({key} as bigint) as page_id", f"{url} as url", f"{page} as html")
    return narrow.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
