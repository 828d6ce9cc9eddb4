"""Main-text extraction by composite text density.

Every page's markup is read once into a tree.  Each node gets its characters C, tags T,
link characters LC and link tags LT; its composite text density is

    C / T * log_b(C/LC * T/LT),   b = ln(C * LC / nonLC + LCb/Cb * C + e)

(LCb, Cb: of the body), so few tags and few links per character score high.  A node's
density sum adds its children's densities and the text it holds directly.  The
threshold is the least density on the path from the body to the node of the greatest
sum; in every subtree that reaches the threshold the node of the greatest sum is
content, and the smallest subtree that holds all content is the article.  Blocks at its
beginning and end that are below the threshold and mostly links are left out.  Elements that are never
text (scripts, controls, hidden ones) do not count at all, nor do menus, headers, footers
and asides.  Names of classes, ids and roles (sidebars, adverts, notices, widgets,
comments), comment microdata, articles inside an article and forms only mark what is
likely not the article.  A name whose marks cover most of the page's text outside links is
not heeded on that page (adverts, notices and comments: only if no paragraph is left
without them), nor is the bare name of a control on a part without controls and links.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr param frame".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp plaintext".split())
DROPPED = frozenset(
    "head script style noscript template iframe object embed svg math canvas audio video map select option button "
    "input textarea nav header footer aside menu dialog noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul".split())
# a start tag of the key closes an open element of the value
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"),
    "tfoot": ("tbody", "thead", "tr", "td", "th"),
}
PARTS = frozenset("p li ul ol td th tr tbody dt dd h1 h2 h3 h4 h5 h6 blockquote pre hgroup".split())
SCOPES = frozenset("ul ol dl table body html article section div td th main blockquote".split())
# first or last words of class, id or role names that mark what is not the article
AWAY = re.compile(
    r"ads?|advert\w*|adsense|banners?|sponsor\w*|promo\w*|nav\w*|menus?|breadcrumbs?|sidebars?|aside|footer|header|"
    r"masthead|cookies?|consent|gdpr|notices?|notifications?|alerts?|popup|modal|overlay|newsletter|subscribe|signup|login|"
    r"comments?|disqus|respond|responses?|replies|reply|related|recommend\w*|share|sharing|social|toolbar|pagination|pager|"
    r"skip|widgets?|search|contentinfo|complementary|dialog|hidden", re.I)
# words beside such a first word that leave it what it is (share-buttons, not share-prices)
PLACES = re.compile(
    r"\d+|top|bottom|left|right|upper|lower|main|primary|secondary|site|page|post|box|area|blocks?|list|wrap\w*|container|"
    r"inner|outer|content|section|bar|links?|buttons?|icons?|items?|slot|unit|holder|panel|column|col|row|form|field|text|"
    r"title|body|count|thread|law|policy|info|message|msg|close|toggle|label|posts?|stories|articles?|desktop|mobile", re.I)
FORMS = frozenset(("form", "fieldset"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
# marks of texts of their own, which may well be longer than a short article
APART = re.compile(
    r"ads?|advert\w*|adsense|banners?|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|notifications?|alerts?|popup|"
    r"newsletter|subscribe|comments?|disqus|respond|responses?|replies|reply", re.I)
ABOUT = frozenset("no has with without is".split())
# names of replies beside a word for a place only; alone they may name a chapter
THREADS = re.compile(r"discussion|conversation|feedback|reviews?", re.I)
# bare names of parts that are controls or lists of links
CONTROLS = re.compile(r"share|sharing|social|search|login|signup|toolbar|pagination|pager|skip", re.I)
CONTROL_TAGS = frozenset("a input button select textarea iframe".split())
NESTED = "article in article"
BARE = "="  # begins the mark of an element with such a bare name
PROSE = 140  # characters outside links that make a run of text a paragraph

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
STOP = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
SPACE = re.compile(r"[ \t\n\r\f\v   -     　\x1c-\x1f\x85]+")


class Tags:
    """Reads a page's markup from left to right, each character a bounded number of times
    however broken it is: where no tag ends any more, or a quote was found to lead
    nowhere, is remembered."""

    def __init__(self, html: str):
        self.html, self.last = html, html.rfind(">")
        self.dead: set[int] = set()  # quotes from which no tag's end is reached
        self.near = (0, -1)  # from a place in here on, the next > or quote is at its end

    def end_of_tag(self, at: int) -> int:
        """Where the ``>`` is that ends a tag, quoted values passed over; -1 if nowhere."""
        html, seen = self.html, []
        while at <= self.last:
            if not self.near[0] <= at <= self.near[1]:
                self.near = (at, STOP.search(html, at).start())  # there is a > at least
            stop = self.near[1]
            if html[stop] == ">":
                return stop
            if stop in self.dead:
                break
            seen.append(stop)
            at = html.find(html[stop], stop + 1) + 1
            if not at:
                break
        self.dead.update(seen)
        return -1

    def after(self, at: int):
        """The next piece of markup from ``at`` on: (begin, end, is an end tag, name,
        attributes), the name None for comments and the like; None if there is no more.
        A ``<`` that begins nothing is text."""
        html = self.html
        while (begin := html.find("<", at)) >= 0:
            if html.startswith("<!--", begin):
                end = html.find("-->", begin + 4)
                return begin, end + 3 if end >= 0 else len(html), False, None, ""
            closes = html.startswith("/", begin + 1)
            name = NAME.match(html, begin + 1 + closes)
            if name:
                end = self.end_of_tag(name.end())
                if end >= 0:
                    return begin, end + 1, closes, name[0], html[name.end() : end]
            if html[begin + 1 : begin + 2] in ("!", "?", "/"):
                end = html.find(">", begin) if begin < self.last else -1
                return begin, end + 1 if end >= 0 else len(html), False, None, ""
            at = begin + 1
        return None


class Node:
    __slots__ = ("tag", "parent", "items", "away", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag, parent, away):
        self.tag, self.parent, self.items, self.away = tag, parent, [], away
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def mark(tag: str, attributes: str) -> bool | str:
    """True if an element is never text; the name that marks it as likely not the
    article; False if nothing does."""
    if tag in DROPPED:
        return True
    if tag in ("html", "body"):
        return False
    if attributes and _hidden(attributes):
        return True
    if tag in FORMS:
        return "form"
    if not attributes or tag in HEADINGS:
        return False
    if tag in ("article", "main"):
        return any(n.lower() == "class" and "comment" in v.lower() for n, v in ATTRIBUTE.findall(attributes)) and "comment"
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "itemprop" and value.lower() == "comment" or name == "itemtype" and value.lower().endswith("/comment"):
            return "comment"
        if name not in ("class", "id", "role"):
            continue
        for token in value.split():
            words = re.findall(r"[A-Z]?[a-z]+|[A-Z]+", token)
            if words and not ABOUT.intersection(w.lower() for w in words):
                if len(words) == 1 and CONTROLS.fullmatch(token):
                    return BARE + token.lower()
                if AWAY.fullmatch(words[-1]):
                    return words[-1].lower()
                if AWAY.fullmatch(words[0]) and all(PLACES.fullmatch(w) or AWAY.fullmatch(w) for w in words[1:]):
                    return words[0].lower()
                if len(words) > 1 and THREADS.fullmatch(words[0]) and all(PLACES.fullmatch(w) for w in words[1:]):
                    return "comments"
    return False


def heed_marks(root: Node) -> None:
    """Marks that cover more than half of the page's text outside links are taken back,
    those of adverts, notices and replies if they leave less than a tenth and no
    paragraph; then those below them are judged.  Bare names of controls count only on
    elements that hold a control or a link."""
    # text outside links of every node, of all that may be text
    order, stack = [], [(root, False)]
    while stack:
        node, in_link = stack.pop()
        order.append((node, in_link or node.tag == "a"))
        stack.extend((i, order[-1][1]) for i in node.items if isinstance(i, Node) and i.away is not True)
    if not any(node.away for node, _ in order):
        return
    size: dict[int, int] = {}
    controls: set[int] = set()  # elements that are or hold a control or a link
    for node, in_link in reversed(order):
        size[id(node)] = 0 if in_link else sum(
            text_size(i) if isinstance(i, str) else size.get(id(i), 0) for i in node.items)
        held = any(isinstance(i, Node) and (i.tag in CONTROL_TAGS or id(i) in controls) for i in node.items)
        if held or node.tag in CONTROL_TAGS:
            controls.add(id(node))
        if isinstance(node.away, str) and node.away.startswith(BARE):
            node.away = held and node.away[len(BARE):]
    total = size[id(root)]
    lifted: set[str] = set()
    while True:
        covered: dict[str, int] = {}
        prose = False  # a paragraph outside all marks
        stack = [root]
        while stack:
            node = stack.pop()
            prose = prose or node.tag == "p" and size[id(node)] >= PROSE
            for i in node.items:
                if isinstance(i, Node) and i.away is not True:
                    if i.away and i.away not in lifted:
                        covered[i.away] = covered.get(i.away, 0) + size[id(i)]
                    else:
                        stack.append(i)
        more = {name for name, n in covered.items()
                if (10 * n > 9 * total and not prose if APART.fullmatch(name) else 2 * n > total)}
        if not more:
            break
        lifted |= more
    for node, _ in order:
        node.away = bool(node.away) and node.away not in lifted


def _hidden(attributes: str) -> bool:
    low = attributes.lower()
    return (bool(re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", low)) or bool(re.search(r"display\s*:\s*none", low))
            or bool(re.search(r"aria-hidden\s*=\s*[\"']?true", low)))


def parse(html: str) -> Node:
    """The tree of a page.  End tags close up to their element; unclosed paragraphs,
    list items and cells end where the next begins; a lone ``<`` is text."""
    root = node = Node("html", None, False)
    at, tags, opened = 0, Tags(html), Counter()

    def close(up: Node) -> Node:
        """End every open element up to and with ``up``."""
        inner = node
        while inner is not up.parent:
            opened[inner.tag] -= 1
            inner = inner.parent
        return up.parent

    while (token := tags.after(at)) is not None:
        begin, end, closes, tag, attributes = token
        if begin > at:
            node.items.append(html[at:begin])
        at = end
        if tag is None:
            continue
        tag = tag.lower()
        if closes:
            if opened[tag] <= 0:
                continue
            up = node
            while up.parent is not None and up.tag != tag:
                if tag not in BLOCKS and up.tag in BLOCKS:
                    break  # an inline end tag does not close blocks
                up = up.parent
            if up.tag == tag and up.parent is not None:
                node = close(up)
            continue
        if tag == "html":
            continue
        if tag == "body":
            # the body begins: whatever of the head is still open ends
            node = root
            opened.clear()
        elif tag in BLOCKS:
            if node.tag == "head":
                node = close(node)
            # a block ends an open paragraph; its inline elements end with it
            up = node
            while up.tag not in BLOCKS and up.parent is not None:
                up = up.parent
            if up.tag == "p":
                node = close(up)
            for closed in CLOSES.get(tag, ()):
                if opened[closed] <= 0:
                    continue
                up = node
                while up.parent is not None and up.tag != closed and (up.tag not in SCOPES or up.tag in CLOSES.get(tag, ())):
                    up = up.parent
                if up.tag == closed:
                    node = close(up)
        # the header of an article holds its title
        own = tag == "header" and opened["article"] > 0 and not _hidden(attributes)
        away = False if own else mark(tag, attributes)
        if tag == "article" and opened["article"] > 0 and not away:
            away = NESTED  # by the standard: a comment on the outer one, or the like
        child = Node(tag, node, away)
        node.items.append(child)
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS and tag not in RAW:
            continue
        if tag in RAW:
            ends = re.compile(rf"</{re.escape(tag)}\s*/?>|</{re.escape(tag)}\s", re.I).search(html, at)
            if tag != "plaintext" and ends:
                child.items.append(html[at : ends.start()])
                at = html.find(">", ends.start()) + 1 or len(html)
            else:
                at = len(html)
            continue
        node = child
        opened[tag] += 1
    if at < len(html):
        cut = re.compile(r"<[a-zA-Z!/?]").search(html, max(at, tags.last + 1))  # a tag cut off at the end is no text
        node.items.append(html[at : cut.start() if cut else len(html)])
    return root


def text_size(text: str) -> int:
    """Characters of a run with white space as one and references as one."""
    return len(SPACE.sub(" ", re.sub(r"&#?\w{1,31};", "&", text)).strip()) if text else 0


def measure(root: Node) -> list[Node]:
    """Fill in characters, tags, densities and sums; the nodes that count, in page order."""
    order, stack = [], [(root, False)]
    while stack:
        node, in_link = stack.pop()
        order.append((node, in_link))
        inside = in_link or node.tag == "a"
        for item in reversed(node.items):
            if isinstance(item, Node) and not item.away:
                stack.append((item, inside))
    for node, in_link in reversed(order):
        link = in_link or node.tag == "a"
        for item in node.items:
            if isinstance(item, str):
                n = text_size(item)
                node.chars += n
                if link:
                    node.link_chars += n
            elif not item.away:
                node.chars += item.chars
                node.link_chars += item.link_chars
                node.tags += item.tags + 1
                node.link_tags += item.link_tags + (item.tag == "a")
    body_chars, body_links = max(root.chars, 1), root.link_chars
    for node, _ in reversed(order):
        chars, tags = node.chars, max(node.tags, 1)
        if chars:
            links, link_tags = max(node.link_chars, 1), max(node.link_tags, 1)
            base = log(chars * links / max(chars - node.link_chars, 1) + body_links / body_chars * chars + e)
            node.density = max(0.0, chars / tags * log(max(chars / links * tags / link_tags, 1.0)) / base)
        direct = sum(text_size(i) for i in node.items if isinstance(i, str))
        node.total = sum(i.density for i in node.items if isinstance(i, Node) and not i.away) + direct
    return [node for node, _ in order]


def choose(root: Node) -> tuple[Node | None, float]:
    """The subtree kept and the density threshold."""
    nodes = measure(root)
    core = max(nodes, key=lambda n: n.total)
    if not root.chars:
        return None, 0.0
    threshold, up = core.density, core
    while up is not None:
        threshold = min(threshold, up.density)
        up = up.parent
    # in every subtree that reaches the threshold, the node of the greatest sum is content
    best: dict[int, Node] = {}
    for node in reversed(nodes):
        top = node
        for item in node.items:
            if isinstance(item, Node) and not item.away and best[id(item)].total > top.total:
                top = best[id(item)]
        best[id(node)] = top
    marked = [best[id(root)]]
    stack = [root]
    while stack:
        node = stack.pop()
        if node.density < threshold:
            continue
        if node.tag in BLOCKS and 2 * node.link_chars <= node.chars:
            marked.append(best[id(node)])
        stack.extend(i for i in node.items if isinstance(i, Node) and not i.away)
    # the article is the smallest subtree that holds all content
    shared = _path(marked[0])
    for node in {id(n): n for n in marked}.values():
        own = _path(node)
        k = 0
        while k < min(len(shared), len(own)) and shared[k] is own[k]:
            k += 1
        shared = shared[:k]
    article = shared[-1]
    # a lone paragraph or an inline core is a part of the block that holds it
    while article.parent is not None and (article.tag not in BLOCKS or article.tag in PARTS):
        article = article.parent
    return article, threshold


def _path(node: Node) -> list[Node]:
    out = []
    while node is not None:
        out.append(node)
        node = node.parent
    return out[::-1]


def blocks(root: Node, threshold: float) -> list[str]:
    """The texts of the blocks.  Blocks below the threshold that are mostly links are left
    out where they lead in or out of the article (menus, further reading), not between its
    texts nor right under a heading of it (a list of references)."""
    out: list[tuple[str, str]] = []  # kind (text, heading or links) and text
    parts: list[str] = []
    kinds = ["text"]

    def flush():
        if parts:
            text = SPACE.sub(" ", unescape("".join(parts))).strip()
            parts.clear()
            if text:
                out.append((kinds[-1], text))

    # explicit stack: pages may nest deeper than Python's recursion limit
    stack: list = [root]
    while stack:
        item = stack.pop()
        if item is None:
            flush()
            kinds.pop()
        elif isinstance(item, str):
            parts.append(item)
        elif item.away and item is not root:
            if item.tag in BLOCKS:
                flush()
        elif item.tag in ("br", "wbr", "img"):
            if item.tag == "br":
                parts.append(" ")
        else:
            mostly_links = item is not root and item.tag in BLOCKS and item.chars and item.density < threshold and 2 * item.link_chars > item.chars
            if item.tag in BLOCKS:
                flush()
                kinds.append("links" if mostly_links or kinds[-1] == "links" else "heading" if item.tag in HEADINGS else "text")
                stack.append(None)
            stack.extend(reversed(item.items))
    flush()
    first, last = 0, len(out)
    while first < last and out[first][0] == "links":
        first += 1
    while last > first and out[last - 1][0] == "links":
        last -= 1
    if last > first and out[last - 1][0] == "heading":
        last = len(out)
    return [text for _, text in out[first:last]]


def extract(html: str | None) -> str:
    """The main text of a page: blocks in page order joined by an empty line."""
    if not html:
        return ""
    tree = parse(html)
    heed_marks(tree)
    root, threshold = choose(tree)
    return "\n\n".join(blocks(root, threshold)) if root is not None else ""


def extract_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per input row: id, url, text, n_chars (code points).

    Null and empty pages give an empty text; a page without markup is its own text.
    Repeated rows are treated one by one; an empty table gives an empty result; a table
    without a url column gives null urls; other columns are not read.
    """
    url = F.col("url") if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(F.col(id_col).alias("id"), url.alias("url"), F.col(html_col).alias("html"))

    def run(batches):
        for batch in batches:
            texts = [extract(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                ["id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"id {kinds['id']}, url {kinds['url']}, text string, n_chars long")
