"""Main text of web pages from flat text blocks and a decision tree.

A page becomes a flat list of text blocks in page order. Each block is described by the word count and link density of itself and of
its two neighbours, as in shallow text features for boilerplate detection, and by where it stands: in an article, in a heading, paragraph or list item, in elements or under
names that usually hold no content. Such an element or name is a feature and no verdict: a form or a wrapper with a telling name may hold the whole page, so
what counts is the share of the page's unlinked words that it holds. A small CART tree, trained on the labelled blocks of the pages of ``LABELLED``
when a session first needs it, tells content from boilerplate. Everything a page needs is in its row, so there is no shuffle.

Blocks end at block-level tags; a br is white space. Character references are decoded per block, white space inside becomes
one space, and content blocks are joined by a line break in page order.

Edge cases: null or empty html and pages without content give an empty text; unclosed tags, comments and scripts run to the end
of the page as in browsers, except that an unfinished tag at the very end is dropped; a page without an article element is judged by
the other features; other columns are ignored; repeated rows give repeated results; an empty table gives none.
"""

from __future__ import annotations

import functools
import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The elements and names the parser knows.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td"
    " tfoot th thead title tr ul button label input".split()
)
RAW_TAGS = frozenset("script style textarea title noscript iframe noembed noframes template svg math object canvas video audio".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no content by their nature; those that usually don't, but may hold a whole page; controls of a form.
STRICT_TAGS = frozenset("nav footer aside menu dialog".split())
LOOSE_TAGS = frozenset("form fieldset header".split())
CONTROL_TAGS = frozenset("button select option label legend optgroup head".split())
CONTENT_TAGS = frozenset("article main".split())
_OUTSIDE = (
    r"ads?|advert\w*|banner|sponsor\w*|promo\w*|sidebar|side|nav|navbar|navigation|menu|breadcrumbs?|footer|header|masthead|"
    r"cookies?|consent|notice|alert|popup|modal|newsletter|subscribe|signup|login|share|sharing|social|widgets?|toolbar|pagination|pager|"
    r"copyright|legal|disclaimer"
)
_PLACE = r"wrap|wrapper|container|box|block|area|bar|list|item|items|inner|outer|left|right|top|bottom|slot|unit|col|section|links|layout|panel|text|[0-9]+"
#: A name that ends in one of these words, or goes on with words of layout alone: site-footer, ad-slot, but not side-effects.
OUTSIDE_NAMES = re.compile(rf"(?:^|[\s_-])(?:{_OUTSIDE})(?:[_-](?:{_PLACE}))*(?=$|\s)", re.I)
#: Names of lists whose entries are often articles of their own.
LIST_NAMES = re.compile(rf"(?:^|[\s_-])(?:comments?|replies|reply|respond|disqus|related|recommended)(?:[_-](?:{_PLACE}))*(?=$|[\s])", re.I)

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*(?:>|\Z)|<(?=[a-zA-Z])[^<>]*\Z", re.S
)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Names that tell of a state of the page and not of what the element holds.
_STATES = re.compile(r"(?:^|(?<=\s))(?:has|no|with|without)[_-]\S*", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none", re.I)
_HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
_WORD = re.compile(r"\S+")


class Place(NamedTuple):
    """Where a block stands: flags, and the numbers of the enclosing loose elements and of those with an outside name."""

    article: bool = False
    heading: bool = False
    paragraph: bool = False
    item: bool = False
    strict: bool = False
    listed: bool = False
    control: bool = False
    loose: tuple[int, ...] = ()
    named: tuple[int, ...] = ()


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    place: Place


def enter(place: Place, tag: str, attributes: str, number: int) -> Place:
    """The place inside an element that opens in ``place``."""
    names = _STATES.sub(" ", " ".join(a or b or c for a, b, c in _NAMES.findall(attributes))) if attributes else ""
    content = tag in CONTENT_TAGS
    # the article element of a page may be called anything, one inside another is often a comment
    listed = bool(names) and (not content or place.article) and bool(LIST_NAMES.search(names))
    named = bool(names) and not content and tag not in ("body", "html") and bool(OUTSIDE_NAMES.search(names))
    loose = tag in LOOSE_TAGS and not (tag == "header" and place.article)  # an article's own header holds its title
    hidden = bool(attributes) and bool(_HIDDEN.search(attributes))
    return Place(
        place.article or content,
        place.heading or tag in _HEADINGS,
        tag in ("p", "blockquote", "pre", "td", "dd", "figcaption"),
        tag == "li" or place.item and tag not in ("p", "div"),
        place.strict or tag in STRICT_TAGS,
        place.listed or listed,
        place.control or tag in CONTROL_TAGS or hidden,
        (*place.loose, number) if loose else place.loose,
        (*place.named, number) if named else place.named,
    )


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order."""
    found: list[Block] = []
    stack: list[tuple[str, Place]] = []  # open elements, and the place inside each
    nowhere, number = Place(), 0
    pieces: list[str] = []
    linked, in_link = 0, False

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(pieces)).split()) if pieces else ""
        if text:
            found.append(Block(text, text.count(" ") + 1, linked, stack[-1][1] if stack else nowhere))
        pieces.clear()
        linked = 0

    def take(text: str) -> None:
        nonlocal linked
        if text:
            pieces.append(text)
            if in_link:
                linked += len(_WORD.findall(text))

    at, size = 0, len(page)
    while at < size:
        token = _TOKEN.search(page, at)
        if not token:
            take(page[at:])
            break
        take(page[at : token.start()])
        at = token.end()
        if not token[2]:
            continue
        closing, tag = bool(token[1]), token[2].lower()
        if tag in RAW_TAGS and not closing:
            if tag in BLOCK_TAGS:
                flush()
            if not token[3].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else size
            continue
        if tag == "br":
            pieces.append(" ")
        if tag == "a":
            in_link = not closing
        if tag in BLOCK_TAGS:
            flush()
            in_link = in_link and tag not in ("p", "li", "div")
        if closing:
            if any(open_tag == tag for open_tag, _ in stack):
                while stack.pop()[0] != tag:
                    pass
        elif tag not in VOID_TAGS and (tag in BLOCK_TAGS or tag == "span"):
            if tag in ("p", "li", "td", "th", "dd", "dt", "option") and stack and stack[-1][0] == tag:
                stack.pop()  # its end may be left out
            number += 1
            around = stack[-1][1] if stack else nowhere
            inside = enter(around, tag, token[3], number)
            if tag == "span":  # names count, but a span is no block of its own
                inside = inside._replace(paragraph=around.paragraph, item=around.item)
            stack.append((tag, inside))
    flush()
    return found


FEATURES = (
    "words", "links", "words_before", "links_before", "words_after", "links_after", "article", "heading", "paragraph", "item", "strict", "listed", "control",
    "loose_share", "named_share",
)
#: The share of an element that isn't there: above that of any which is.
_NONE = 2.0


def describe(page: list[Block]) -> np.ndarray:
    """A row of FEATURES per block; what lies beyond the first and last block has no words and no links.

    ``loose_share`` and ``named_share`` are those of the smallest enclosing element of that kind; ``article`` is -1 for what stands beside the article of a page that has one.
    """
    words = np.array([b.words for b in page], float)
    links = np.array([b.linked / b.words for b in page], float)
    flags = np.array([b.place[:7] for b in page], float).reshape(-1, 7)
    prose = np.array([max(0, b.words - b.linked) for b in page], float)
    whole = max(1.0, prose.sum())
    held: dict[int, float] = {}
    for b, w in zip(page, prose):
        for element in b.place.loose + b.place.named:
            held[element] = held.get(element, 0.0) + w / whole
    loose = [min((held[e] for e in b.place.loose), default=_NONE) for b in page]
    named = [min((held[e] for e in b.place.named), default=_NONE) for b in page]
    # -1 beside the article of a page that has one, 0 on a page without
    if any(b.place.article and not (b.place.strict or b.place.listed or b.place.control) for b in page):
        flags[:, 0] = 2 * flags[:, 0] - 1
    before, after = (lambda x: np.r_[0.0, x[:-1]]), (lambda x: np.r_[x[1:], 0.0])
    return np.c_[words, links, before(words), before(links), after(words), after(links), flags, loose, named]


#: Labelled pages of usual shapes, made by hand: +n stands for n words of content, -n for n words of boilerplate.
_MENU = "<nav><ul>" + "<li><a href=/>-1</a></li>" * 6 + "</ul></nav>"
_LINKS = "<ul>" + "<li><a href=/>-5</a></li>" * 4 + "</ul>"
_BODY = "<h1>+6</h1><p>+40</p><p>+3</p><p>+60</p>"
LABELLED = [
    # an article between menu, advert and footer; short articles, long adverts
    f"<title>-6</title>{_MENU}<div class=ad>-9</div><article>{_BODY}</article><footer>-14</footer>",
    f"<title>-6</title>{_MENU}<div class=ad>-30</div><article><h1>+6</h1><p><b>+12<br><p>+2</p></article><footer>-40</footer>",
    "<div class=banner>-60</div><article><p>+1</p></article><div id=cookie-notice>-50</div>",
    f"{_MENU}<article><h1>+3</h1><p>+1</p><p>+1</p></article><p>-30</p><footer>-80</footer>",
    f"<header><h1>-3</h1><p>-8</p></header>{_MENU}<main>{_BODY}<h2>+3</h2><p>+25</p></main><div class=sidebar>-30</div>",
    f"<article><header><h1>+6</h1><p>+4</p></header><p>+50</p><ul><li>+6</li><li>+1</li><li>+9</li></ul><p>+30</p></article>{_LINKS}",
    "<article><h1>+5</h1><p>+20 <a>+6</a></p><p><a>+6</a></p><p>+45</p><blockquote>+20</blockquote><pre>+9</pre><table><tr><td>+2<td>+1</table></article>",
    "<article><p>+30</p><dl><dt>+2<dd>+9</dl><figure><figcaption>+8</figcaption></figure><h3><a>+4</a></h3><p>+30</p><div>+5</div></article><div>-5</div>",
    "<article><h1>+5</h1><p>+30</p><p><a>+3</a></p><p>+9</p><p><a>+12</a></p><p>+40 <a>+8</a></p></article>",
    "<article><p>+25</p><p><a>+2</a> <a>+3</a></p><div>+30</div><p><a>+9</a></p></article>",
    "<main><h1><a>+5</a></h1><p><a>+4</a></p><p>+30</p><ul><li>+6</li><li><a>+4</a> +9</li><li>+3</li></ul></main>",
    "<article><h1>+5</h1><div>+40</div><div>+10</div></article>",
    f"{_MENU}<article><ul><li>+5</li><li>+9</li><li>+2</li></ul></article>",
    "<div class=ad>-12</div><article>+12</article>",
    "<article><h1>+6</h1></article>",
    f"{_MENU}<main><div>+20</div><h2>+3</h2><table><tr><td>+4</td><th>+1</th></tr></table><div>+3</div></main>",
    # what an article holds besides its text
    "<article><h1>+5</h1><div class=share>-3</div><p>+50</p><aside>-20</aside><p>+30</p><div class=ad>-10</div><p>+2</p></article>",
    "<article><h1>+5</h1><div class='notice box'>-30</div><p>+30</p><div class=sidebar>-25</div></article>",
    "<article><p>+60</p><button>-1</button><form><p>-12</p><label>-2</label><button>-1</button></form><p>+30</p><select><option>-1<option>-1</select></article>",
    f"<article><h1>+5</h1><p>+60</p><p>+30</p>{_LINKS}</article>",
    f"<article><p>+60</p><h3>+2</h3><p>+30</p>{_LINKS.replace('-5', '-3')}</article>",
    "<article><section id=side-effects><h2>+2</h2><p>+30</p></section><section class=legal-analysis><p>+25</p><p>+4</p></section><div hidden><p>-20</p></div></article>",
    # forms and names around the whole page
    f"<form>{_MENU}<div id=header>-4</div><article>{_BODY}</article><div class=footer>-10</div></form>",
    "<form><ul class=menu>" + "<li><a>-1</a></li>" * 5 + f"</ul><div id=content>{_BODY}</div><div class=footer>-12</div></form>",
    f"<form><div>{_BODY}</div></form>",
    f"<div class=social><div id=content>{_BODY}</div></div>",
    f"<div class='post-header-wrap content'>{_BODY}</div><div class=sidebar>-25</div>",
    f"<div class=page-header><article>{_BODY}</article><p>-4</p></div>",
    f"<div id=main-menu>{_MENU}<div class=text>{_BODY}</div></div><div class=copyright>-9</div>",
    f"<header><article>{_BODY}</article></header><footer>-10</footer>",
    f"<div class=widget-area><main>{_BODY}<div class=widget>-12</div></main></div>",
    # reader comments and lists of other articles
    f"<article>{_BODY}</article><section class=comments><h3>-2</h3>" + "<div class=comment><p>-30</p></div>" * 3 + "</section>",
    "<article><h1>+4</h1><p>+30</p></article><div id=post-comments>" + "<article><p>-60</p></article>" * 3 + "</div>",
    "<article><h1>+4</h1><p>+30</p><article class=comment><p>-40</p></article><article class=comment><p>-20</p></article></article>",
    f"<article>{_BODY}</article><div class=related><h3>-2</h3><article><p>-30</p></article><article><p>-30</p></article></div>",
    f"<article>{_BODY}</article><aside><article><p>-60</p></article></aside><nav><article><p>-50</p></article></nav>",
    f"<article><p>+30</p></article><form><article><p>-30</p></article></form><div class=popup><form><p>-20</p><button>-1</button></form></div>",
    # pages without an article
    "+40",
    "<h1>+5</h1><div>+30</div><div>+60</div>",
    "<div><div>+30</div><div>+9</div><div>+50</div></div>",
    "<h1>+4</h1><p>+30</p><p>+1</p><p>+50</p><p>+2</p>",
    "<h1>+2</h1><p>+9</p><p>+1</p><h2>+3</h2><p>+1</p><p>+6</p>",
    "<div class=header><a>-2</a> <a>-3</a></div><div class=body><div>+40</div><div>+60</div><div>+7</div><div>+30</div></div><div class=footer>-10</div>",
    "<p><a>-1</a> <a>-1</a> <a>-2</a></p><h1>+6</h1><p>+50 <a>+2</a></p><h2>+3</h2><p>+25</p><p class=copyright>-8</p>",
    f"{_MENU}<div><h1>+4</h1><div>+45</div><p>+30</p><p>+2</p></div><div class=sidebar><h3>-2</h3>{_LINKS}<p>-25</p></div><div id=disclaimer>-30</div>",
    f"<ul>{'<li><a>-2</a></li>' * 5}</ul><div>+35</div><ul><li>+5</li><li>+7</li><li>+4</li></ul><div>+50</div><div><a>-1</a> <a>-1</a></div>",
    "<div>-2 <a>-1</a></div><div><a>-3</a></div><p>+60</p><p>+30</p><form>-2 <button>-1</button></form><div><a>-2</a></div>",
    "<table><tr><td><a>-1</a></td><td><a>-2</a></td></tr><tr><td><p>+40</p><p>+2</p><p>+30</p></td></tr></table><div class=pagination><a>-1</a> <a>-1</a></div>",
    "<div id=cookie-consent><p>-30</p><button>-1</button></div><h1>+5</h1><p>+35</p><p>+45</p><div class=newsletter><h3>-3</h3><p>-15</p></div>",
]
_COUNT = re.compile(r"([+-])(\d+)")


def labelled_blocks(page: str, random: np.random.Generator | None = None) -> tuple[np.ndarray, np.ndarray]:
    """FEATURES and labels of the blocks of a labelled page; with ``random`` each text is a fifth to three times as long, content up to twenty times."""

    def text(m: re.Match) -> str:
        times = 1.0 if random is None else float(np.exp(random.uniform(-1.6, 3.0 if m[1] == "+" else 1.1)))
        return " ".join([m[1]] * max(1, round(int(m[2]) * times)))

    found = blocks(_COUNT.sub(text, page))
    rows, labels = describe(found), np.array([float("+" in b.text) for b in found])
    # by chance boilerplate can hold most of a page; nobody could label such a block
    at = FEATURES.index
    shares = np.where(rows[:, [at("loose_share"), at("named_share")]] < _NONE, rows[:, [at("loose_share"), at("named_share")]], 0.0).max(axis=1)
    unclear = (labels == 0) & (shares > 0.65) & (rows[:, [at("strict"), at("listed"), at("control")]].max(axis=1) == 0)
    unclear |= (labels == 1) & (np.min(rows[:, [at("loose_share"), at("named_share")]], axis=1) < 0.7)
    return rows[~unclear], labels[~unclear]


def training_table(pages: list[str] | None = None, times: int = 12, seed: int = 3) -> np.ndarray:
    """The label and FEATURES of every block of the labelled pages, as they are and ``times`` times with other lengths."""
    random = np.random.default_rng(seed)
    parts = [labelled_blocks(page, random if k else None) for page in (LABELLED if pages is None else pages) for k in range(times + 1)]
    return np.concatenate([np.c_[labels, rows] for rows, labels in parts])


class Split(NamedTuple):
    feature: int
    limit: float
    low: "Split | float"
    high: "Split | float"


def fit_tree(rows: np.ndarray, labels: np.ndarray, depth: int = 12, least: int = 3) -> "Split | float":
    """CART with Gini impurity; ties go to the first feature and the lowest limit, so that training is repeatable."""
    share = float(labels.mean())
    if depth == 0 or share in (0.0, 1.0):
        return share
    best = (np.inf, 0, 0.0)
    for feature in range(rows.shape[1]):
        # all limits of a feature at once: sizes and positives at or below each distinct value
        order = np.argsort(rows[:, feature], kind="stable")
        values, ones = rows[order, feature], np.cumsum(labels[order])
        last = np.flatnonzero(values[1:] != values[:-1])
        if not len(last):
            continue
        size, positives = last + 1.0, ones[last]
        cost = positives * (1 - positives / size) + (ones[-1] - positives) * (1 - (ones[-1] - positives) / (len(labels) - size))
        k = int(cost.argmin())
        if cost[k] < best[0] - 1e-9:
            best = (float(cost[k]), feature, float((values[last[k]] + values[last[k] + 1]) / 2))
    low = rows[:, best[1]] <= best[2]
    if best[0] == np.inf or min(low.sum(), (~low).sum()) < least:
        return share
    return Split(best[1], best[2], fit_tree(rows[low], labels[low], depth - 1, least), fit_tree(rows[~low], labels[~low], depth - 1, least))


def predict(tree: "Split | float", rows: np.ndarray) -> np.ndarray:
    if not isinstance(tree, Split):
        return np.full(len(rows), tree)
    low = rows[:, tree.feature] <= tree.limit
    out = np.empty(len(rows))
    out[low], out[~low] = predict(tree.low, rows[low]), predict(tree.high, rows[~low])
    return out


@functools.cache
def trained() -> "Split | float":
    table = training_table()
    return fit_tree(table[:, 1:], table[:, 0])


def main_text(page: str, tree: "Split | float | None" = None) -> str:
    found = blocks(page)
    if not found:
        return ""
    content = predict(trained() if tree is None else tree, describe(found)) >= 0.5
    return "\n".join(b.text for b, keep in zip(found, content) if keep)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points), one row per page."""
    tree = trained()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            text = [main_text(h, tree) for h in b["html"]]
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": text, "n_chars": [len(t) for t in text]})

    chosen = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html")
    )
    return chosen.mapInPandas(run, "page_id long, url string, text string, n_chars long")
