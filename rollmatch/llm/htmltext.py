"""Main text of web pages by tree scoring.

The page is parsed into a tree (unclosed and misnested tags are closed as browsers would).
Parts that are never content go first: scripts, styles, forms, navigation, asides,
footers, page headers, hidden elements, and elements whose class, id or role names them
as menu, advert, notice, sidebar, comments and the like. Then every paragraph (a block
with text of its own) gives points for its length and commas to its parent, half of them
to the grandparent and ever less further up; an element's points are discounted by the
share of its text that stands in links. The best element names the article: the nearest
<article> or <main> around it is kept whole, however long the page is and wherever in it
the best element lies; of a <main> or <article> further out, and without any of them of the
page, all parts beside it are kept of which no more than half the text stands in links.

The text is made of blocks in page order, joined by a blank line; character references
are decoded and white space inside a block becomes one space. NULL and empty pages give
an empty text, pages without any scoring paragraph give the text of <article>, <main>
or <body>, whichever there is. Time and memory are linear in the page.
"""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmatch.llm.common import per_text

#: Element names by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style noscript template head title nav aside footer form button select textarea iframe object svg canvas "
                    "video audio dialog menu".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 "
                   "h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: An opening tag of the first kind closes an open one of the second, unless one of the third stands between.
CLOSES = {
    "li": (("li",), ("ul", "ol")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
#: Words in class, id or role that name something other than the article.
UNLIKELY = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
                     "disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo "
                     "related rail search share sharing sidebar social sponsor sponsored subscribe toolbar widget complementary contentinfo".split())
LIKELY = frozenset("article articlebody body content entry main maincontent post story text".split())
#: Of these words any one in a class tells, inside an article too; words that only say which part of a page it is.
ADVERTS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo cookie cookies gdpr newsletter disqus navbar popup modal".split())
PARTS = frozenset("area article articles bar block bottom box buttons container content entry form inline inner item items left links list main outer "
                  "panel post posts right section signup slot story thread title top unit wrap wrapper".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPH_CHARS = 25


class Node:
    __slots__ = ("tag", "parent", "children", "names", "points", "chars", "link_chars", "dropped")

    def __init__(self, tag: str, parent, names=frozenset(), dropped: bool = False):
        self.tag, self.parent, self.children, self.names = tag, parent, [], names
        self.points, self.chars, self.link_chars, self.dropped = 0.0, 0, 0, dropped


def _tokens(attrs, *keys) -> list[tuple[str, ...]]:
    """The words of each token of the given attributes, in order."""
    return [tuple(w for w in token.replace("_", "-").split("-") if w) for k, v in attrs if k in keys and v for token in v.lower().split()]


def _unlikely(tag: str, attrs, in_article: bool) -> bool:
    """Whether class, id or role name something other than the article.

    Outside an article one such word is enough, unless another token names content. Inside it, where an anchor
    such as ``related-work`` may start with any word, a token counts as a whole: its last word is such a word, or it
    says nothing else but a part (``comment-list``); for adverts one word of a class is enough. Headings
    always stay, an <article> goes only as a comment, and a header of an article stays.
    """
    if tag in HEADINGS:
        return False
    named = _tokens(attrs, "class", "id", "role")
    if tag in ("article", "main"):
        comment = {"comment", "comments"}
        return any(comment & set(t) and set(t) <= comment | PARTS for t in named) and not any(LIKELY & set(t) and not comment & set(t) for t in named)
    if any(LIKELY & set(t) and not UNLIKELY & set(t) for t in named):
        return False
    if not in_article:
        return any(UNLIKELY & set(t) and not ("header" in t and LIKELY & set(t)) for t in named)
    words = UNLIKELY - {"header", "masthead"}
    if any(ADVERTS & set(t) for t in _tokens(attrs, "class")):
        return True
    return any(t and (t[-1] in words or (words & set(t) and set(t) <= words | PARTS)) for t in named)


def _hidden(attrs) -> bool:
    for k, v in attrs:
        if k == "hidden" or (k == "aria-hidden" and v == "true"):
            return True
        if k == "style" and v and "display:none" in v.replace(" ", "").lower():
            return True
    return False


class Tree(HTMLParser):
    """Elements and text pieces of a page; a text piece is a str among a node's children."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.here = Node("html", None)
        self.open = {"html": 1}

    def _pop_to(self, node) -> None:
        while self.here is not node:
            self.open[self.here.tag] -= 1
            self.here = self.here.parent

    def _close(self, tags, until=()) -> None:
        """Closes the innermost open element of ``tags`` if none of ``until`` stands inside it."""
        if not any(self.open.get(t) for t in tags):
            return
        node = self.here
        while node is not None and node.tag not in until:
            if node.tag in tags:
                if node.parent is not None:
                    self._pop_to(node.parent)
                return
            node = node.parent

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            return
        if tag == "br":
            self.here.children.append("\n")
            return
        if tag in BLOCKS:
            self._close(("p",), ("td", "th", "table", "button"))
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        in_article = bool(self.open.get("article") or self.open.get("main"))
        names = frozenset(w for t in _tokens(attrs, "class", "id", "role") for w in t)
        dropped = tag in DROPPED or (tag == "header" and not in_article) or _hidden(attrs) or _unlikely(tag, attrs, in_article)
        node = Node(tag, self.here, names, dropped)
        self.here.children.append(node)
        if tag not in VOID:
            self.here = node
            self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("html", "body") and self.here.tag == tag:
            self._pop_to(self.here.parent)

    def handle_endtag(self, tag):
        if tag in ("html", "body"):
            return
        if tag == "p" and not self.open.get("p"):
            self.here.children.append(Node("p", self.here))
            return
        if self.open.get(tag):
            self._close((tag,), ("table", "td", "th") if tag in ("p", "a", "b", "i", "span", "em", "strong") else ())

    def handle_data(self, data):
        self.here.children.append(data)


def blocks(node: Node):
    """(block text, innermost block element, characters in links) in page order, without dropped parts."""
    out: list = []
    pieces: list = []
    owner = node
    links = 0

    def flush():
        nonlocal pieces, links
        text = " ".join("".join(pieces).split())
        if text:
            out.append((text, owner, links))
        pieces, links = [], 0

    stack = [(node, 0, owner, False)]
    while stack:
        here, k, block, in_link = stack.pop()
        if k == 0 and here.tag in BLOCKS:
            flush()
            block = owner = here
        while k < len(here.children):
            child = here.children[k]
            k += 1
            if isinstance(child, str):
                pieces.append(child)
                if in_link:
                    links += len(child)
            elif child.dropped:
                if child.tag in BLOCKS:
                    flush()
                else:
                    pieces.append(" ")
            else:
                stack.append((here, k, block, in_link))
                stack.append((child, 0, block, in_link or child.tag == "a"))
                break
        else:
            if here.tag in BLOCKS:
                flush()
                owner = stack[-1][2] if stack else node
    flush()
    return out


def best_container(root: Node):
    """The element with the most points after the discount for links, and the blocks of the page."""
    found = blocks(root)
    scored: dict[int, Node] = {}
    for text, owner, links in found:
        owner.chars += len(text)
        owner.link_chars += min(links, len(text))
    order = [root]
    for node in order:  # parents before children; the list grows as it is read
        order.extend(c for c in node.children if isinstance(c, Node))
    for node in reversed(order[1:]):
        node.parent.chars += node.chars
        node.parent.link_chars += node.link_chars
    for text, owner, links in found:
        if len(text) < PARAGRAPH_CHARS or links * 2 > len(text) or owner.tag in HEADINGS:
            continue
        points = 1 + text.count(",") + min(len(text) / 100, 3)
        node, level = owner if owner.tag not in ("p", "pre", "li", "td", "blockquote", "dd") else owner.parent, 0
        while node is not None and level < 5:
            if id(node) not in scored:
                scored[id(node)] = node
                node.points = 25.0 if node.tag in ("article", "main") else 5.0 if node.names & LIKELY else 0.0
            node.points += points if level == 0 else points / (2 * level)
            node, level = node.parent, level + 1
    best, most = None, 0.0
    for node in scored.values():
        value = node.points * (1 - node.link_chars / max(1, node.chars))
        if value > most:
            best, most = node, value
    return best, found


def _prose(node) -> bool:
    return isinstance(node, Node) and not node.dropped and node.chars > 0 and node.link_chars * 2 <= node.chars


def content(best: Node) -> tuple[set, set]:
    """Ids of the elements to keep whole, and of those whose own text blocks are kept, around the best element."""
    trail = [best]
    while trail[-1].parent is not None:
        trail.append(trail[-1].parent)
    marked = [k for k, n in enumerate(trail) if n.tag in ("article", "main")]
    first = marked[0] if marked else 0  # kept whole, with all between it and the best element
    last = marked[-1] if marked else len(trail) - 1
    kept, own = {id(trail[first])}, set()
    for node, parent in zip(trail[first:last], trail[first + 1:last + 1]):
        own.add(id(parent))
        kept.update(id(x) for x in parent.children if x is not node and _prose(x))
    if marked and trail[last].parent is not None:  # an article in several parts
        kept.update(id(x) for x in trail[last].parent.children if x is not trail[last] and x.tag in ("article", "main") and _prose(x))
    return kept, own


def main_text(html: str) -> str:
    tree = Tree()
    tree.feed(html)
    tree.close()
    best, found = best_container(tree.root)
    kept, own = ({id(_first(tree.root, ("article", "main")) or tree.root)}, set()) if best is None else content(best)
    inside: dict[int, bool] = {}
    out = []
    for text, owner, links in found:
        trail, node = [], owner
        while node is not None and id(node) not in inside:
            if id(node) in kept:
                inside[id(node)] = True
                break
            trail.append(node)
            node = node.parent
        verdict = node is not None and inside[id(node)]
        for n in trail:
            inside[id(n)] = verdict
        if verdict or (id(owner) in own and links * 2 <= len(text)):
            out.append(text)
    return "\n\n".join(out)


def _first(root: Node, tags):
    stack = [root]
    while stack:
        node = stack.pop()
        if node.tag in tags and not node.dropped:
            return node
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return None


def extract_pages(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns, ``text`` and ``n_chars`` (its code points) of every page."""
    text = per_text(lambda: lambda h: (main_text(h),), "text string")(F.col(html_col))["text"]
    return pages.select(*keep, text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
