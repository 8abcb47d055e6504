"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into flat text blocks at block-level tags.  A block has a number of words and a link
density (share of its words inside links).  ``FEATURES`` of a block are these two, those of the
blocks before and after it, the words of mostly unlinked text above and below it on the page, and
hints from the markup: how strongly the names of its elements (tag, class, id, role; parts of
hyphenated names too) speak of menus, adverts, comments and the like, whether it stands inside an
article or main element, or outside it though the page has one, and whether it begins as a
copyright line does.  A hint decides nothing by itself: the classifier is a decision tree grown (Gini
impurity) on the small labelled table that ``LABELLED`` pages give.  It runs as a Spark condition
over the array of a page's blocks.

Character references are decoded, white space inside a block becomes one space, blocks that are
kept are joined by an empty line in page order.  Scripts, styles and markup comments are never text.
Null or empty html, or a page without article text: empty text.  Repeated rows give repeated rows.
Pages of any length are cut whole; only page_id, url and html are read, so further columns,
whatever their names, are dropped.  An empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import namedtuple
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[/!?a-zA-Z][^>]*+(?:>|\Z)""", re.DOTALL)
#: HTML's block-level elements, elements whose content is no text, and void elements.
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split())
SILENT = frozenset("canvas embed iframe annotation annotation-xml noembed noframes noscript object script select style svg template textarea title video audio".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no article text, and parts of names that say the same.
ASIDE = frozenset("nav footer aside form menu dialog button fieldset".split())
STRONG = re.compile(r"(?:ads?|adsense|advert\w*|banner|breadcrumbs?|comments?|commentlist|complementary|consent|contentinfo|cookies?|copyright|disqus|footer|gdpr|masthead|menu|modal|nav|navbar|navigation|newsletter|pager|pagination|popup|promo\w*|sidebar|sponsor\w*|subscribe)\Z")
ALONE = frozenset("login notice notification replies respond signup subscription toolbar".split())  # strong alone or beside companions only
WEAK = frozenset("login notice notification related replies respond search share sharing signup social subscription toolbar widget".split())
COMPANION = frozenset("area articles bar block box button buttons container content form icons items link links list panel post posts reader section site stories tools top widget wrap wrapper".split())
NOT = frozenset("free has hide no with without".split())
#: Headings and list items: their ids name a topic.
TOPIC = frozenset("h1 h2 h3 h4 h5 h6 li".split())
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)
LEGAL = re.compile(r"(?:©|\(c\)\s|copyright\b|all rights reserved)", re.IGNORECASE)
#: Of equally good splits the first feature's is taken.
FEATURES = ("links", "words", "links_before", "links_after", "words_before", "words_after", "above", "below", "named", "inside", "outside", "legal")


@lru_cache(maxsize=4096)
def says(names: str) -> tuple[int, int]:
    """How strongly names speak against article text, (whole names, parts of names): 0 not at all, 1 a word
    that may name a topic, 2 such a word alone or beside words like "box" or "links", 3 plainly."""
    whole = part = 0
    for name in names.split():
        parts = [x.lower() for x in re.split(r"[-_:]+|(?<=[a-z])(?=[A-Z])", name) if x]
        if NOT & set(parts):
            continue
        strong = any(STRONG.match(x) for x in parts)
        weak = [x for x in parts if x in WEAK]
        others = [x for x in parts if x not in WEAK and x not in COMPANION]
        level = 3 if strong or weak and not others and ALONE & set(weak) else 2 if weak and not others else 1 if weak else 0
        if len(parts) == 1:
            whole = max(whole, level)
        else:
            part = max(part, level)
    return whole, part


LONG = 10  # words of a block that counts as text above or below another
Block = namedtuple("Block", "text words linked inside named")


def blocks(html: str) -> list[Block]:
    """(text, words, words in links, inside the article, how strongly names speak against it) of each block."""
    out: list[Block] = []
    open_tags: list[tuple[str, tuple[bool, int, int]]] = []  # (tag, the state before it)
    opened: dict[str, int] = {}
    pieces: list[str] = []
    linked: list[str] = []
    state = (False, 0, 0)  # inside an article, level of whole names, level of parts of names
    in_link = False
    at = 0

    def end_block() -> None:
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                n = text.count(" ") + 1
                out.append(Block(text, n, min(n, len(unescape("".join(linked)).split())), state[0], max(state[1:])))
        pieces.clear()
        linked.clear()

    def add(text: str) -> None:
        if text:
            pieces.append(text)
            if in_link:
                linked.append(text)

    n = len(html)
    while at < n:
        m = TAG.search(html, at)
        if m is None:
            add(html[at:])
            break
        add(html[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        closing = bool(m[1])
        if tag == "br":
            add(" ")
        elif tag == "a":
            in_link = not closing
            if closing:
                linked.append(" ")
        elif tag in SILENT and not closing:
            if not m[3].endswith("/") and tag not in VOID:
                over = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE).search(html, at)
                at = over.end() if over else n
            add(" " if tag not in ("script", "style") else "")
        elif closing:
            if tag in BLOCK:
                end_block()
            if opened.get(tag):
                while True:
                    t, state = open_tags.pop()
                    opened[t] -= 1
                    if t == tag:
                        break
        else:
            if tag in BLOCK:
                end_block()
                in_link = in_link and tag == "li"
            if tag not in VOID and tag != "p" and (tag in BLOCK or "=" in m[3]) and not m[3].endswith("/"):
                names = ""
                if "=" in m[3] and tag not in ("body", "html"):
                    names = " ".join(x.strip("\"'") for name, x in NAMES.findall(m[3]) if tag not in TOPIC or name.lower() != "id")
                inside, whole, part = state
                new_whole, new_part = says(names)
                if tag == "section":  # a part of a text, named by its topic
                    new_whole, new_part = (1 if x == 2 else x for x in (new_whole, new_part))
                if tag in ASIDE or not inside and (tag == "header" or {"header", "site-header", "page-header"} & set(names.lower().split())):
                    new_whole = 3
                open_tags.append((tag, state))
                opened[tag] = opened.get(tag, 0) + 1
                if tag in ("article", "main") or names == "main":  # a part of a name around an article is that of a layout
                    state = (True, max(whole, new_whole), new_part)
                else:
                    state = (inside, max(whole, new_whole), max(part, new_part))
    end_block()
    return out


def features(found: list[Block]) -> list[tuple[float, ...]]:
    """``FEATURES`` of each block of a page.  Text above and below counts mostly unlinked blocks that no name speaks against."""
    main = any(b.inside for b in found)
    size = [(float(b.words), b.linked / b.words) for b in found]
    text = [b.words if 2 * b.linked < b.words and b.named < 2 and b.words >= LONG else 0 for b in found]
    total, above = sum(text), 0
    none = (0.0, 0.0)
    around = [none, *size, none]
    out = []
    for i, b in enumerate(found):
        out.append((size[i][1], size[i][0], around[i][1], around[i + 2][1], around[i][0], around[i + 2][0], float(above), float(total - above - text[i]),
                    float(b.named), float(b.inside), float(main and not b.inside), float(b.words <= 25 and LEGAL.match(b.text) is not None)))
        above += text[i]
    return out


def menu(*sizes: int, sign: str = "-") -> str:
    return "<ul>" + "".join(f"<li><a href=x>{sign}{n}</a></li>" for n in sizes) + "</ul>"


def text(*sizes: int) -> str:
    return "".join(f"<p>+{n}</p>" for n in sizes)


#: Labelled pages: ``+9`` stands for a block of nine words of the article, ``-3`` for three words of anything else; ``c`` after it for a copyright line.
LABELLED = (
    # plain pages: no article element, no telling names
    menu(1, 2, 1, 3, 1, 2, 1) + "<h1>+8</h1>" + text(70, 22, 90, 12, 41) + "<div>-5c</div>",
    menu(2, 3, 1, 1, 2) + "<h1>+7</h1>" + text(55, 31) + menu(5, sign="+") + text(64) + menu(6, 3, 2),
    "<div><a href=x>-1</a> <a href=x>-1</a></div>" + "<h1>+9</h1>" + text(38, 120, 4, 75) + "<div><a href=x>-12</a></div>",
    menu(4, 4, 2) + text(90, 11) + "<div>-9c</div>",
    "<div>" + text(42, 6, 21, 37) + "</div>",
    text(60) + menu(6, sign="+") + text(60),
    text(45) + menu(1, 2, 3, 2, 8, sign="+") + text(28) + menu(1, 1, 2),
    text(33, 2, 50) + "<p><a href=x>+3</a></p>" + text(18, 60, 9),
    "<h1>+3</h1>" + text(25) + "<h2>+2</h2>" + menu(9, 7, 12, sign="+") + "<h2>+3</h2>" + text(40, 1),
    menu(1, 1, 1, 2, 2, 14) + "<h1>+2</h1>" + text(16, 11, 13) + menu(2, 2, 1, 1) + "<p>-12c</p>",
    "<div><a href=x>-2</a></div><h1>+5</h1>" + text(28, 35) + "<p>-7c</p>" + menu(1, 2),
    menu(1, 2, 9, 3, 3, 1, 2, 1, 1) + text(200, 3, 15, 80) + menu(10, 8, 12, 7, 9, 2, 1),
    menu(2, 1, 4) + text(60) + menu(1, sign="+") + text(50, 200, 1, 30, 2) + "<div>-3c</div>",
    menu(1, 3, 5, 8) + text(35, 80) + menu(2, sign="+") + text(12, 150, 2) + menu(3, 1, 4),
    menu(3, 6) + "<h1>+1</h1>" + text(300, 40, 2) + menu(1, 4, 2, sign="+") + text(11, 1, 25) + menu(4, 5, 3) + "<p>-4c</p>",
    # named parts around and within plain text
    menu(1, 1, 2) + "<div class='post'><h1>+4</h1>" + text(30, 47) + "</div><div class='comment-list'><p>-4</p><p>-35</p><p>-12</p></div><div class='site-footer'>-16</div>",
    "<div class='main-nav'>-3</div><h1>+6</h1>" + text(52, 15) + "<div class='left-sidebar'><p>-22</p><p>-50</p></div><div class='footer-links'>" + menu(1, 2, 2) + "-4</div>",
    "<div id='header'>-2</div><section><h2>+6</h2>" + text(44, 52) + "</section><div class='newsletter'>-18</div><div class='share-buttons'><a href=x>-2</a></div>",
    "<h1>+2</h1>" + text(75) + "<div class='search'>-3</div><div class='related'><h3>-2</h3>" + menu(6, 7) + "</div>",
    text(64) + "<section class='search'><h2>+1</h2>" + text(50, 30) + "</section><div class='cookie-banner'>-25</div>",
    # an article element
    "<nav>" + menu(1, 2, 1) + "</nav><div class='ad'>-8</div><article><h1>+7</h1>" + text(60, 1, 25) + "</article><footer>-9c</footer>",
    "<header>-4</header><main><h1>+3</h1><p>+80<p>+2<p>+14</main><aside>-30</aside><footer>" + menu(2) + "</footer>",
    "<div class='menu'>" + menu(3, 1) + "</div><article><h2>+5</h2>" + text(1, 2, 3) + "<section class='comments'><p>-20</p><p>-35</p></section></article><div>-12</div>",
    "<article><h1>+6</h1><p><a href=x>+4</a></p><p>+33</p><form>-5</form><p>+48</p><div class='sidebar'>-22</div></article><p>-40</p>",
    "<article><p>+150</p></article><article class='comment'><p>-45</p></article>",
    "<main><article><h1>+5</h1><p>+1</p></article><div class='related'>" + menu(7, 5) + "</div></main>",
    "<nav>" + menu(1) + "</nav><article><h1>+12</h1><p>+2</p></article><div class='sponsored'>-60</div>",
    "<p>-14</p><article><h1>+4</h1>" + text(30, 1) + "</article>",
    "<div>-3</div><div>-50</div><main><h1>+10</h1>" + text(2, 65) + "<ul><li>+3</li><li><a href=x>+2</a></li><li>+1</li></ul></main><div>-6</div><div>-33</div>",
    "<article><h1>+8</h1><p>+1</p><p><a href=x>+1</a></p></article><p>-24</p><p>-2</p><p>-70</p>",
    "<article><p>+3</p><p>+18</p><blockquote>+26</blockquote><p>+2</p></article>",
    "<main><p>+1</p></main><p>-1</p>" + menu(2, 3),
    "<article>" + menu(2, 4, 1, 9, sign="+") + "</article>" + menu(2, 1, 1, 5),
    "<article><h1>+4</h1>" + menu(1, 3, 2, sign="+") + text(20) + menu(6, 11, sign="+") + "</article>",
    menu(1, 2, 1, 1) + "<article><h1>+4</h1><p>+5</p><div class='ad-slot'>-6</div><p>+30</p><section class='search'><h2>+2</h2>" + text(44, 60) + "</section><div class='comment-list'><p>-3</p><p>-40</p></div></article>",
    "<article>" + text(40) + "<section class='share-prices'><h3>+2</h3>" + text(2, 25) + "</section><div class='share-links'><a href=x>-1</a><p>-3</p></div>" + text(30) + "<h2 class='related'>-1</h2></article>",
    "<article>" + text(24) + "<section class='related'><h3>-2</h3>" + menu(7, 5, 6) + "</section><div class='cookie-notice'>-20</div>" + text(3) + "<p>+8c</p>" + text(50, 4) + "</article>",
    "<article><h1>+6c</h1>" + text(200, 1, 50, 2) + "<h2>+2c</h2><p>+3</p><p>+12c</p></article>" + menu(3, 4) + "<div>-10c</div>",
    "<nav>" + menu(1, 1) + "</nav><main><h1>+4</h1><p>+1</p><p>+9c</p><p>+2</p>" + text(120, 90, 1, 2, 1) + "</main><p>-30</p><p>-5c</p>",
    text(30, 40) + "<div class='share'><p>-2</p></div>" + text(25) + "<div class='search-box'><p>-6</p><p>-1</p></div>" + text(80) + "<div class='related'><h3>-1</h3><p>-4</p></div>",
    "<article>" + text(9, 30) + "<div class='related'><p>-5</p><p>-2</p><p>-1</p></div>" + text(6) + "<div class='share'><p>-1</p></div></article>",
    "<article><h1>+3</h1><p>+2c</p>" + text(17, 1) + "</article><p>-30</p>" + menu(4, 5),
    "<article><p>+2c</p></article><p>-4c</p>", "<article><h1>+3</h1><p>+9c</p></article>" + menu(1, 2), "<main><p>+30</p><p>+4c</p><p>+5</p></main><div>-3c</div><div>-2</div>",
    text(60) + "<h2>+4c</h2>" + text(20, 44) + "<p>-8c</p>", text(80, 2) + "<p>-14c</p>" + menu(1, 2),
    "<article>" + text(60, 30) + "<p>+2c</p></article>", "<main><h1>+3</h1>" + text(25, 120) + "<h2>+2c</h2><p>+20c</p></main>" + menu(2, 2), "<article>" + text(15, 45) + "<p>+7c</p></article><div>-5c</div>",
    "<article><p>+5</p><div class='ad'>-3</div>" + text(90) + "<div class='ad-box'>-6</div>" + text(55, 70) + "<div class='promo'>-12</div>" + text(62) + "<div class='comments'><p>-1</p><p>-50</p><p>-4</p><p>-70</p><p>-2</p></div></article>",
    text(75, 120) + "<div>-6c</div>", text(30, 66) + "<p>-3c</p>", text(14, 98) + "<p>-11c</p>" + menu(2, 1), text(20, 60) + "<h3>+3c</h3>" + text(70, 18), text(140) + "<p>+9c</p>" + text(33),
    "<article><section class='search-theory'><h2>+1</h2>" + text(12, 40) + "</section><section class='related'><h2>+3</h2>" + text(8, 25, 2) + "</section><section class='related-posts'><h3>-4</h3>" + menu(8, 3) + "</section></article>",
    text(50, 20) + "<section class='social'><h2>+2</h2>" + text(30, 3, 66) + "</section><section class='share'><h2>-1</h2>" + menu(1, 1, 1) + "</section>",
    "<main><div class='related'><p>-9</p><p>-6</p></div><div class='search'><p>-55</p></div></main>",
)


def labelled_table(pages: tuple[str, ...] = LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """(features, whether it is article) of the blocks of labelled pages."""
    rows, labels = [], []
    for page in pages:
        marked = blocks(page)  # a block's text still begins with its mark
        labels += [b.text.startswith("+") for b in marked]
        filled = re.sub(r"(?<=>)[+-](\d+)(c?)", lambda m: " ".join((["Copyright"] if m[2] else []) + ["word"] * (int(m[1]) - bool(m[2]))), page)
        rows += features(blocks(filled))
    if len(rows) != len(labels):
        raise ValueError("labels and blocks don't agree")
    return np.array(rows), np.array(labels)


def impurity(good: np.ndarray, n: np.ndarray) -> np.ndarray:
    p = good / np.maximum(n, 1)
    return n * 2 * p * (1 - p)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8):
    """A decision tree: (feature, threshold, tree at most it, tree above it), or the class at a leaf."""
    if depth == 0 or y.all() or not y.any():
        return bool(2 * y.sum() >= len(y))
    best, pick = impurity(np.array(y.sum()), np.array(len(y))) - 1e-9, None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= cut
            score = impurity(y[low].sum(), low.sum()) + impurity(y[~low].sum(), (~low).sum())
            if score < best:
                best, pick = score, (f, float(cut), low)
    if pick is None:
        return bool(2 * y.sum() >= len(y))
    f, cut, low = pick
    return f, cut, grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)


def condition(tree, values: dict[str, Column]) -> Column:
    """The tree as a Spark condition over the features."""
    if isinstance(tree, bool):
        return F.lit(tree)
    f, cut, low, high = tree
    return F.when(values[FEATURES[f]] <= cut, condition(low, values)).otherwise(condition(high, values))


FOUND = "array<struct<text:string," + ",".join(f"{f}:double" for f in FEATURES) + ">>"


def page_blocks(html: Column) -> Column:
    """The text blocks of each whole page and their ``FEATURES``."""

    @F.arrow_udf(FOUND)
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("text", pa.string()), *((f, pa.float64()) for f in FEATURES)]))

        def of(html: str) -> list[dict]:
            found = blocks(html)
            return [{"text": b.text, **dict(zip(FEATURES, f))} for b, f in zip(found, features(found))]

        for column in batches:
            for at in range(0, len(column), 512):
                yield pa.array([of(h or "") for h in column.slice(at, 512).to_pylist()], kind)

    return cut(html)


def extract(pages: DataFrame, tree=None) -> DataFrame:
    """page_id, url, text, n_chars, and how many blocks a page has and keeps."""
    tree = grow(*labelled_table()) if tree is None else tree
    cut = pages.select("page_id", "url", page_blocks(F.col("html")).alias("blocks"))
    kept = F.filter("blocks", lambda b: condition(tree, {f: b[f] for f in FEATURES}))
    out = cut.select("page_id", "url", F.size("blocks").cast("long").alias("n_blocks"), F.transform(kept, lambda b: b["text"]).alias("kept"))
    out = out.select("page_id", "url", F.array_join("kept", "\n\n").alias("text"), "n_blocks", F.size("kept").cast("long").alias("n_kept"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_blocks", "n_kept")
