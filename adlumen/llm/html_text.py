"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut into flat blocks of text at block-level tags.  Each block is
described by word count and link density, its neighbours' word counts and link
densities, and one feature each for what encloses it: structure (article,
nothing, furniture), heading, list item.
A decision tree (Gini splits) is grown on the small labelled table below: blocks
of a few hand-made pages, with and without telling elements.  The blocks that
it calls content are joined.

An element is furniture by its tag, or by a class, id or role that consists of
furniture words (``cookie-banner``, ``site-header``; not ``with-sidebar`` or
``share-price``).  That is not believed of an element that holds an h1, article or
main and over half of the page's words outside links, with no article or main
outside it: such a wrapper holds the text.

Defined cases: a null page is empty and its text is empty; scripts, styles,
comments and the head are no blocks; markup that is never closed or cut off at
the end is tolerated; character references are decoded once; repeated rows are
extracted alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import html
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlumen.llm.common import arrow_map

# fixed values: HTML element names
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q ruby rt rp s
samp small span strike strong sub sup time tt u var wbr label""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("""script style noscript template textarea select option svg math iframe object canvas audio video
title head button""".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
BOILER_TAGS = frozenset("nav header footer aside form menu dialog fieldset address".split())
CONTENT_TAGS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# fixed values: words in class, id or role that name page furniture
BOILER_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion
banner cookie cookies consent notice notices alert popup modal overlay newsletter subscribe subscription signup login
nav navbar navigation menu menus breadcrumb breadcrumbs sidebar side aside widget widgets footer header masthead topbar
comment comments disqus reply replies respond discussion share sharing social related recommended recommendations
pagination pager tags tagcloud copyright legal disclaimer toolbar search contentinfo complementary gdpr""".split())
CONTENT_WORDS = frozenset("article post entry story content main body text".split())
# fixed values: words that say nothing more beside a furniture word in one class name
PLAIN_WORDS = frozenset("""site page main top bottom left right primary secondary global box bar list item items block
area section slot unit link links form button buttons icon icons post posts article articles news content container
inner thread count title panel strip row""".split())
HIDDEN = "hidden"

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                    r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(>|\Z)", re.S)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_MAY_HIDE = re.compile(r"hidden|display", re.I)
_EACH_ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s\"'>]+)))?")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b")
_NAME = re.compile(r"[a-z]+")
# furniture tags that some pages put around everything
WRAPPERS = frozenset("form header dialog fieldset".split())


@dataclass
class Block:
    text: str
    words: int
    linked: int
    boiler: bool
    content: bool
    heading: bool
    item: bool
    inside: tuple[int, ...] = ()      # furniture elements around it that may hold the text


def _names(attributes: str) -> list[list[str]]:
    """The words of each class, id and role."""
    out: list[list[str]] = []
    for m in _ATTR.finditer(attributes):
        for name in (m[2] or m[3] or m[4] or "").split():
            out.append(_NAME.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()))
    return out


def _furniture(words: list[str]) -> bool:
    """Whether a class name as a whole names page furniture."""
    return (any(w in BOILER_WORDS for w in words)
            and all(w in BOILER_WORDS or w in PLAIN_WORDS for w in words))


def _hidden(attributes: str) -> bool:
    """Whether an attribute of its own hides the element."""
    if not _MAY_HIDE.search(attributes):
        return False
    for m in _EACH_ATTR.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").strip().lower()
        if (name == "hidden" and value in ("", "hidden", "true") or name == "aria-hidden" and value == "true"
                or name == "style" and _NO_DISPLAY.search(value)):
            return True
    return False


def _kind(tag: str, attributes: str, in_content: bool) -> str:
    """What an element says about its inside: boiler, hidden, content or nothing."""
    if attributes and tag != "body" and tag != "html" and _hidden(attributes):
        return HIDDEN
    names = _names(attributes) if attributes.strip() else []
    if tag in CONTENT_TAGS:
        return "boiler" if any(w in ("comment", "comments", "reply") for n in names for w in n) else "content"
    if tag in BOILER_TAGS and not (tag == "header" and in_content):
        return "boiler"
    if names and tag != "body" and tag != "html":
        if any(map(_furniture, names)):
            return "boiler"
        if tag != "header" and any(n and n[-1] in CONTENT_WORDS and len(n) <= 2 for n in names):
            return "content"
    return ""


def blocks(page: str | None) -> list[Block]:
    """The flat text blocks of a page, in order."""
    page = page or ""
    out: list[Block] = []
    open_tags: list[tuple[str, str, int]] = []      # block elements, what they say, their numbers
    text: list[tuple[str, bool]] = []
    links = boiler = content = headings = items = tags = 0
    inside: list[int] = []                          # open furniture that may yet hold the text
    telling: list[tuple[bool, tuple[int, ...]]] = []  # article, main (True) and h1 (False), and what they are inside
    at, n = 0, len(page)

    def flush():
        if not text:
            return
        words = " ".join(html.unescape("".join(t for t, _ in text)).split())
        if words:
            linked = sum(len(html.unescape(t).split()) for t, a in text if a)
            out.append(Block(words, words.count(" ") + 1, min(linked, words.count(" ") + 1), boiler > 0,
                             content > 0, headings > 0, items > 0, tuple(inside)))
        text.clear()

    def leave(entry):
        nonlocal boiler, content, headings, items
        tag, kind, number = entry
        if inside and inside[-1] == number:
            inside.pop()
        elif kind in ("boiler", HIDDEN):
            boiler -= 1
        content -= kind == "content"
        headings -= tag in HEADINGS
        items -= tag == "li"

    for m in _TOKEN.finditer(page):
        if m.start() < at:
            continue
        if m.start() > at:
            text.append((page[at: m.start()], links > 0))
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                text.append((html.escape(m[0][9:].removesuffix("]]>")), links > 0))
            continue
        if m[1]:
            if tag == "a":
                links = 0
            elif tag not in INLINE:
                flush()
                if any(entry[0] == tag for entry in open_tags):
                    while open_tags:
                        entry = open_tags.pop()
                        leave(entry)
                        if entry[0] == tag:
                            break
            continue
        if tag == "a":
            links = 1
        elif tag in SKIPPED and not m[3].rstrip().endswith("/"):
            if tag not in INLINE:
                flush()
            end = re.compile(rf"</{tag}\s*(?:>|\Z)" if tag != "head" else r"</head\s*>|(?=<body\b)", re.I).search(page, at)
            if end or tag in RAW:
                at = end.end() if end else n
        elif tag in VOID or m[3].rstrip().endswith("/") and tag not in ("p", "div"):
            if tag not in INLINE:
                text.append((" ", False)) if tag in ("br", "img", "input") else flush()
        elif tag not in INLINE:
            flush()
            while tag in ("p", "li") and open_tags and open_tags[-1][0] in (("p",) if tag == "p" else ("p", "li")):
                leave(open_tags.pop())
            kind = _kind(tag, m[3], content > 0)
            tags += 1
            open_tags.append((tag, kind, tags))
            if kind == "boiler" and (tag not in BOILER_TAGS or tag in WRAPPERS) and tag not in CONTENT_TAGS:
                inside.append(tags)
            elif kind in ("boiler", HIDDEN):
                boiler += 1
            content += kind == "content"
            if (tag in CONTENT_TAGS and kind == "content") or tag == "h1":
                telling.append((tag != "h1", tuple(inside)))
            headings += tag in HEADINGS
            items += tag == "li"
            if tag not in ("p", "li"):
                links = 0
    if at < n:
        rest = page[at:]
        cut = re.search(r"<[a-zA-Z/!][^>]*\Z", rest)
        text.append((rest[: cut.start()] if cut else rest, links > 0))
    flush()
    plain = sum(b.words - b.linked for b in out)
    held: dict[int, int] = {}
    for b in out:
        for k in b.inside:
            held[k] = held.get(k, 0) + b.words - b.linked
    for b in out:
        b.boiler = b.boiler or any(not (2 * held[k] > plain and any(k in around for _, around in telling)
                                        and all(k in around for strong, around in telling if strong)) for k in b.inside)
    return out


FEATURES = ("words", "link_density", "words_before", "density_before", "words_after", "density_after",
            "structure", "heading", "item", "page_has_content")


def features(page: list[Block]) -> np.ndarray:
    """Feature rows of a page's blocks; beyond the ends stand empty blocks."""
    n = len(page)
    x = np.zeros((n, len(FEATURES)))
    if not n:
        return x
    words = np.array([0, *(b.words for b in page), 0], dtype=float)
    density = np.array([0, *(b.linked / b.words for b in page), 0])
    for k, v in enumerate((words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:])):
        x[:, k] = v
    has = any(b.content and not b.boiler for b in page)
    for i, b in enumerate(page):
        x[i, 6:] = (-1 if b.boiler else int(b.content), b.heading, b.item, has)
    return x


#: The labelled table: pages as (html, label) fragments; 1 marks content.
LABELLED: tuple[tuple[tuple[str, int], ...], ...] = (
    (("<body><nav><ul><li><a href=x>Home</a></li>", 0), ("<li><a href=x>News of the day</a></li></ul></nav>", 0),
     ("<div class='ad'>Buy one of our fine new cars this very week.</div>", 0),
     ("<article><h1>A title</h1>", 1),
     ("<p>Rain fell on the town for three days, and the river rose until the lower streets stood under water.</p>", 1),
     ("<p>Yes.</p>", 1), ("<p><a href=x>One linked line that belongs to the story</a></p>", 1),
     ("<ul><li>first point</li>", 1), ("<li>second point</li></ul></article>", 1),
     ("<footer>Copyright the town paper, all rights reserved.</footer>", 0)),
    (("<body><header><h1>Site name</h1></header>", 0), ("<main><h2>Head line</h2>", 1),
     ("<p>A short paragraph.</p>", 1),
     ("<aside>Other readers also looked at these long stories about gardens and rivers in spring.</aside>", 0),
     ("<p>The council met on Monday evening to talk about the new bridge, and nobody agreed on its price.</p></main>", 1),
     ("<section class='comments'><p>I think that this is a very good article and I agree with all of it.</p></section>", 0),
     ("<form>Sign up for our letter with your address</form>", 0), ("<footer>Contact</footer>", 0)),
    (("<body><div><a href=x>Start</a> <a href=x>Shop</a> <a href=x>Blog</a></div>", 0),
     ("<h1>How bread is made</h1>", 1),
     ("<div>Flour, water, salt and yeast are all that is needed, but the order and the time decide the loaf.</div>", 1),
     ("<div>Let the dough rest over night in a cold room, fold it twice, and bake it in a very hot oven until brown.</div>", 1),
     ("<div><a href=x>More recipes</a> <a href=x>Write to us</a></div>", 0), ("<div>Page 3</div>", 0)),
    (("<body><div>Menu</div>", 0), ("<div><a href=x>One</a></div>", 0), ("<div><a href=x>Two</a></div>", 0),
     ("<p>On the first day the climbers reached the hut below the ridge and waited there for the storm to pass.</p>", 1),
     ("<p>Then, on the third morning, the sky was clear and they set out with ropes and lamps before sunrise.</p>", 1),
     ("<p>They came back late.</p>", 1),
     ("<p>None of them had slept for two nights, yet all of them said that they would go there again next year.</p>", 1),
     ("<div class='cookie-notice'>We use cookies to make this site better for you and for all our partners.</div>", 0),
     ("<div>Terms</div>", 0)),
    (("<body><div id='sidebar'>Latest posts and many more words about what is new on this page today</div>", 0),
     ("<div class='post-content'><p>Short.</p>", 1), ("<p>Words <a href=x>and a link</a> in them.</p>", 1),
     ("<div class='share'>Share this with all of your friends</div>", 0), ("<p>End.</p></div>", 1),
     ("<div class='related'><a href=x>Another story</a></div>", 0), ("<div>Imprint</div>", 0)),
    (("<body><nav><a href=x>The</a></nav>", 0), ("<article><h1>Only a title</h1></article>", 1),
     ("<footer>&copy; some words of a notice that is as long as a paragraph of the text would be, or longer.</footer>", 0)),
    (("<body><div><a href=x>Front page</a></div>", 0), ("<div>Our shop is open from nine to five on every day of the week.</div>", 0),
     ("<article><h2>A head</h2>", 1), ("<p>The ship came in at noon with grain and timber, and the whole harbour was there to see it.</p>", 1),
     ("<p><a href=x>All about the ship</a></p>", 1), ("<p>Fin.</p></article>", 1), ("<div><a href=x>Next</a></div>", 0),
     ("<div>You are reading the free part of this paper, which is paid for by those who read all of it.</div>", 0),
     ("<div>Back</div>", 0)),
    (("<body><p>A page may have nothing but a single block of text, and then that block is what it has to say.</p>", 1),),
    (("<body><h1>Two blocks</h1>", 1), ("<p>The second is the last block of the page, and it is content because it is long enough.</p>", 1)),
    (("<body><div><a href=x>Log in</a></div>", 0), ("<h2>On maps</h2>", 1),
     ("<p>Maps are made by walking, by counting, and in later times by flying over the land with a camera.</p>", 1),
     ("<p>Old maps show what people believed; new maps show where the roads and the borders are today.</p>", 1)),
    (("<body><main><p>One.</p>", 1), ("<table><tr><td>cell</td>", 1), ("<td>other cell</td></tr></table></main>", 1),
     ("<div>Follow us</div>", 0)),
    (("<body><article><p>The harbour was full of ships from the north when the storm came in from the sea.</p>", 1),
     ("<p><a href=x>A list of all the ships that were lost in the night and of those that came home</a></p>", 1),
     ("<p><a href=x>More</a></p>", 1), ("<p>None was found.</p></article>", 1)),
    (("<body><div><a href=x>Up</a></div>", 0), ("<main><h1>Wells</h1>", 1), ("<ul><li><a href=x>Deep ones</a></li>", 1),
     ("<li>Old ones</li></ul>", 1), ("<p>The end</p></main>", 1)),
    (("<body><p>Closed today.</p>", 1),),
    (("<body><h1>Notice</h1>", 1), ("<p>Closed today.</p>", 1)),
    (("<body><p><a href=x>Go to the start page</a></p>", 0),),
    (("<body><div><a href=x>Home</a> | <a href=x>About us</a> | <a href=x>Write to us</a></div>", 0),
     ("<div>The mayor opened the new library on Saturday, and two hundred people came to see its rooms.</div>", 1),
     ("<div>It rained.</div>", 1),
     ("<div>The shelves hold forty thousand books, and a reading room for children looks out on the river.</div>", 1),
     ("<div><a href=x>Older</a> <a href=x>Newer</a></div>", 0), ("<div>All rights reserved</div>", 0)),
    (("<body><div class='cookie-banner'>We and our partners use cookies to store what you read here and for how long.</div>", 0),
     ("<div><h1>Flood</h1>", 1), ("<p>The river rose for three days, and then the lower streets stood under a foot of water.</p>", 1),
     ("<p>Yes.</p>", 1), ("<p>On the fourth day it fell, and the people of the town went home to see what was left.</p></div>", 1),
     ("<div class='comment-list'><p>I think that all of this is true, for I was there and saw it with my own eyes.</p>", 0),
     ("<p>So did I, and I would like to add that the bridge was never safe and should be closed.</p></div>", 0),
     ("<footer>Written and printed in the town</footer>", 0)),
    (("<body><nav><a href=x>Home</a></nav>", 0), ("<div><h1>Thaw</h1>", 1),
     ("<p>The ice broke up on the lake this morning with a noise that was heard far away.</p></div>", 1),
     ("<div class='comments'>A fine story about the ice, as always, and I hope for more of them from you soon.</div>", 0),
     ("<aside>The shop sells maps of the lake, and of the hills around it, at a fair price all year.</aside>", 0)),
    (("<body><div class='newsletter'>Sign up and get one letter a week with all that is new in the town.</div>", 0),
     ("<div>Home</div>", 0), ("<p>The market opens at seven, and by nine the best of the fish is sold to those who came early.</p>", 1),
     ("<p>Bread and cheese last until noon, when the stalls close and the square is swept and washed.</p>", 1),
     ("<div class='ad'>Buy two pairs of our warm socks this week and pay for only one of the two.</div>", 0),
     ("<p>Nobody comes late twice.</p>", 1),
     ("<p>In winter there is no market, and the square is left to the children and their sledges.</p>", 1),
     ("<div class='related-posts'>What we wrote about markets in the last year, and what our readers made of it</div>", 0),
     ("<div>Privacy</div>", 0)),
    (("<body><div class='layout with-sidebar'><div><a href=x>Home</a> <a href=x>News</a></div>", 0),
     ("<article><h1>Snow</h1>", 1), ("<p>Snow fell in the hills on the last night of the year and stayed until the thaw.</p>", 1),
     ("</article><div class='sidebar'>Short lists of what else is new here and there</div></div>", 0)),
    (("<body><main><p>Alone</p></main>", 1), ("<p>Printed on paper made from old paper, in a town that has a paper mill and a press.</p>", 0)),
)


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    xs, ys = [], []
    for page in LABELLED:
        found = blocks("".join(part for part, _ in page))
        labels = [y for _, y in page]
        assert len(found) == len(labels), [b.text for b in found]
        xs.append(features(found))
        ys.append(labels)
    return np.vstack(xs), np.concatenate(ys)


@dataclass
class Tree:
    """A split (feature, at; left is <= at) or, without children, a leaf's label."""

    label: int
    feature: int = -1
    at: float = 0.0
    left: Tree | None = None
    right: Tree | None = None

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.left is None:
            return np.full(len(x), self.label)
        low = x[:, self.feature] <= self.at
        out = np.empty(len(x), dtype=int)
        out[low], out[~low] = self.left.predict(x[low]), self.right.predict(x[~low])
        return out


def _impurity(y: np.ndarray) -> float:
    p = y.mean() if len(y) else 0.0
    return len(y) * 2 * p * (1 - p)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 10) -> Tree:
    """Gini tree; of equally good splits the one on the earlier feature, words and links, wins."""
    tree = Tree(int(y.mean() > 0.5) if len(y) else 0)
    if depth == 0 or len(set(y.tolist())) < 2:
        return tree
    best = (_impurity(y) - 1e-9, -1, 0.0)
    for k in range(x.shape[1]):
        values = np.unique(x[:, k])
        for at in (values[1:] + values[:-1]) / 2:
            low = x[:, k] <= at
            loss = _impurity(y[low]) + _impurity(y[~low])
            if loss < best[0] - 1e-9:
                best = (loss, k, float(at))
    if best[1] < 0:
        return tree
    low = x[:, best[1]] <= best[2]
    tree.feature, tree.at = best[1], best[2]
    tree.left, tree.right = grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)
    return tree


@functools.lru_cache(maxsize=1)
def trained() -> Tree:
    return grow(*labelled_table())


def main_text(page: str | None, tree: Tree | None = None) -> str:
    found = blocks(page)
    if not found:
        return ""
    keep = (tree or trained()).predict(features(found))
    return " ".join(b.text for b, k in zip(found, keep, strict=True) if k)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    tree = trained()

    def make():
        def step(cols):
            texts = [main_text(h, tree) for h in cols["html"]]
            return {"page_id": cols["page_id"], "url": cols["url"], "text": texts, "n_chars": list(map(len, texts))}

        return step

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return arrow_map(rows, "page_id bigint, url string, text string, n_chars bigint", make, text="html")
