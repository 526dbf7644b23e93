"""Main-text extraction by composite text density (operator 3).

Every page is parsed into a tree of elements. Elements that are never article
text (menus, page headers, footers, sidebars, notices, adverts, forms,
scripts, styles, reader comments) are left out, by element, ARIA role or the
words of their class and id; such words and forms are no reason to leave out
what holds the article (see ``settle``). On what is left, following Sun, Song and Liao
("DOM based content extraction via text density"):

* the density of an element is its characters per tag, damped by the share
  of characters and tags that are links;
* its density sum adds up its children's densities;
* the element with the largest density sum holds the article; the lowest
  density on the path from it up to the body is the page's threshold;
* from the body down, every branch that reaches the threshold contributes
  the element with its largest density sum.

A chosen element is widened to the ``article`` (or else ``main``) element
that holds it, so short paragraphs and titles are not lost; if the page has
its largest density sum in one, text outside such elements is left out. On a
page without them the title (the only ``h1``) and the paragraphs between it
and the main text belong to it (see ``_lead``). Inside, only lists of links
that look like a menu go (see ``_is_menu``). Reader comments are also known by
the heading of their section, and a comment that is never closed ends the
page, as it does in a browser.

Blocks: an element that is not inline starts and ends a block, and so does a
line break. Pages are independent rows, parsed in place without a shuffle.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from curata.llm.hashing import text_slices

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr img body-text "
                   "math semantics mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder munderover mstyle mspace mpadded mphantom "
                   "menclose mtable mtr mtd mmultiscripts mprescripts".split())
LEFT_OUT = frozenset("script style noscript template head title nav footer aside button select option textarea input dialog menu svg "
                     "annotation annotation-xml canvas iframe object embed audio video map area link meta base".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar tablist status".split())
#: Words of a class or id that mark an element as not part of the article.
MARKS = frozenset("ad ads advert adverts advertisement advertising adbox sponsor sponsored promo promotion banner cookie cookies consent gdpr "
                  "notice notices alert popup modal overlay newsletter subscribe subscription signup login paywall nav navbar navigation menu "
                  "menus submenu breadcrumb breadcrumbs pagination pager sidebar aside widget widgets related recommended share sharing social "
                  "footer masthead topbar toolbar rail adsbygoogle comment comments commentlist commentform disqus reply replies respond responses "
                  "discussion feedback copyright skip hidden".split())
#: Of these: reader comments, and words with no other use. The others are everyday words too.
COMMENTS = frozenset("comment comments commentlist commentform disqus".split())
STRONG = frozenset("ad ads advert adverts adbox adsbygoogle gdpr nav navbar submenu breadcrumb breadcrumbs pagination newsletter paywall topbar".split())
#: Words that leave a mark's meaning as it is ("share-buttons").
HELPERS = frozenset("area bar block body bottom box btn button buttons container content form global group header icons inner item items left link "
                    "links list main page panel post posts primary right secondary section site thread top wrap wrapper".split())
#: As an id these may be an article's own section.
TOPICS = frozenset("discussion feedback responses replies notice notices copyright cookie cookies consent subscription advertising navigation "
                   "sharing alert".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Ids of these are often slugs of a title ("ad-hoc-networks").
SLUGGED = HEADINGS | frozenset("section p li dt dd td th tr table figure".split())
LISTS = frozenset("ul ol dl div section table tbody menu".split())
#: Whole classes or ids that do (an article's own header has longer names, like "entry-header").
WHOLE_MARKS = frozenset("header site-header page-header global-header top-header side-bar".split())
#: On these a mark counts only if a whole class or id is that word: themes put words like "comments-open" on them.
WHOLE_PAGE = frozenset("html body main article".split())
#: A class like "has-sidebar" says what stands elsewhere.
NOT_ITSELF = frozenset("has with no without".split())
P_ENDS = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu "
                   "nav ol p pre section table ul".split())
#: An element that opens ends an open one of these before it, up to the nearest of the scope.
SAME_LEVEL = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
              "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
              "option": ({"option"}, {"select"})}
#: An end tag doesn't close elements beyond these.
WALLS = frozenset("html body article aside main nav footer header section div td th table ul ol dl form".split())
_SPACES = re.compile(r"\s+")
#: Headings of reader comments, as a whole, with or without a number.
_COMMENT_HEADING = re.compile(r"(?i)(?:\(?\d+\)?\s*)?(?:(?:reader|user|your|all|add a|post a|leave a|join the|laisser un|tous les|alle|neue|los|deja un)\s+)?"
                              r"(?:comments?|conversation|reply|replies|commentaires?|kommentare?|leserkommentare|comentarios?)(?:\s*\(?\d+\)?)?\s*:?")


class Node:
    __slots__ = ("tag", "parent", "parts", "out", "chars", "link_chars", "tags", "link_tags", "density", "density_sum", "mark", "title", "article")

    def __init__(self, tag: str, parent: Node | None, out: bool = False):
        self.tag, self.parent, self.out = tag, parent, out
        self.parts: list[Node | str] = []
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.density = self.density_sum = 0.0
        self.mark: str | None = None
        self.title = self.article = False

    def children(self):
        return (p for p in self.parts if type(p) is Node)


def _mark(tag: str, attrs: list[tuple[str, str | None]]) -> str | None:
    """``out`` for an element that is left out whatever it holds; else the surest mark of its class and id, if any."""
    found = {"form"} if tag == "form" else set()
    for name, value in attrs:
        value = (value or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            return "out"
        if name == "role" and value in ROLES and not (tag == "form" and value == "form"):
            return "out"
        if name in ("class", "id") and tag not in HEADINGS:
            for word in value.split():
                parts = {x for x in re.split(r"[^a-z]+", word) if x}
                marks = parts & MARKS
                if word in WHOLE_MARKS:
                    found.add("header")
                elif not marks or not NOT_ITSELF.isdisjoint(parts) or tag in WHOLE_PAGE and word not in MARKS:
                    continue
                elif name == "id" and tag in SLUGGED and not parts <= MARKS | HELPERS:
                    continue
                elif marks & COMMENTS:
                    found.add("comment")
                elif marks & STRONG:
                    found.add("strong")
                else:
                    found.add("weak" if parts <= MARKS | HELPERS and not (name == "id" and parts <= TOPICS) else "part")
    return next((m for m in ("comment", "strong", "header", "weak", "form", "part") if m in found), None)


class TreeParser(HTMLParser):
    """The element tree of a page, with the end tags that authors leave out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None)
        self.open: dict[str, int] = {}
        self.marked: list[Node] = []

    def _push(self, tag: str, out: bool, mark: str | None) -> None:
        node = Node(tag, self.at, out)
        if mark and not out:
            node.mark = mark
            self.marked.append(node)
        self.at.parts.append(node)
        self.at = node
        self.open[tag] = self.open.get(tag, 0) + 1

    def _pop_to(self, node: Node) -> None:
        """Close ``node`` and all inside it."""
        while self.at is not node:
            self.open[self.at.tag] -= 1
            self.at = self.at.parent
        self.open[node.tag] -= 1
        self.at = node.parent

    def _nearest(self, tags, walls) -> Node | None:
        if not any(self.open.get(t) for t in tags):
            return None
        node, found = self.at, None
        while node.parent is not None:
            if node.tag in tags:
                found = node
                if len(tags) == 1:
                    return node
            elif node.tag in walls:
                break
            node = node.parent
        return found

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body") and (tag == "html" or self.open.get("body")):
            return
        if tag in P_ENDS and self.open.get("p") and (p := self._nearest({"p"}, WALLS)):
            self._pop_to(p)
        if tag in SAME_LEVEL and (old := self._nearest(*SAME_LEVEL[tag])):
            self._pop_to(old)
        if tag == "body" and self.open.get("head"):
            self._pop_to(self._nearest({"head"}, ()))
        within = self.open.get("article") or self.open.get("main")
        header = tag == "header" and not within
        mark = _mark(tag, attrs)
        if mark == "header" and within:
            mark = None                       # the article's own
        out = tag in LEFT_OUT or header or mark == "out"
        if tag in VOID:
            self.at.parts.append(Node(tag, self.at, out))
        else:
            self._push(tag, out, mark)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)      # a slash closes nothing in HTML

    def handle_endtag(self, tag):
        if tag in VOID or not self.open.get(tag):
            if tag == "br":
                self.handle_starttag("br", [])
            return
        node = self.at
        while node.parent is not None and node.tag != tag:
            if node.tag in WALLS and tag not in WALLS:
                return
            node = node.parent
        if node.parent is not None:
            self._pop_to(node)

    def handle_data(self, data):
        self.at.parts.append(data)


def _without_open_comment(html: str) -> str:
    """The page with comments as the parser knows them, up to one that is never closed (unless a script or style, whose text is none, holds its begin)."""
    if "<!--" not in html:
        return html
    html = re.sub(r"<!---?>", "", html).replace("--!>", "-->")        # empty ones, and the other way to close one
    at = html.find("<!--", max(html.rfind("-->"), -3) + 3)
    if at < 0:
        return html
    before = html[:at].lower()
    if any(before.rfind(f"<{tag}") > before.rfind(f"</{tag}") for tag in ("script", "style", "textarea", "title")):
        return html
    return html[:at]


def parse(html: str) -> tuple[Node, list[Node]]:
    """The page's root and its marked elements, in page order."""
    parser = TreeParser()
    parser.feed(_without_open_comment(html))
    parser.close()
    return parser.root, parser.marked


def _text(node: Node) -> str:
    todo, out = [node], []
    while todo:
        part = todo.pop()
        if type(part) is str:
            out.append(part)
        elif not part.out:
            todo.extend(reversed(part.parts))
    return _SPACES.sub(" ", "".join(out)).strip()


def _empty(part: Node | str) -> bool:
    return not part.strip() if type(part) is str else part.out or not _text(part) if part.tag not in HEADINGS else False


def mark_comments(root: Node, marked: list[Node]) -> list[Node]:
    """``marked`` and the sections that begin with a heading of reader comments."""
    found, todo = [], [root]
    while todo:
        n = todo.pop()
        if n.out:
            continue
        todo.extend(n.children())
        if n.tag in HEADINGS and n.tag != "h1" and _COMMENT_HEADING.fullmatch(_text(n)):
            around = n
            # the section of a heading: what has nothing before it
            while around.parent is not None and around.parent.tag in ("section", "div", "aside", "header") and _first(around):
                around = around.parent
            if around is not n and around.mark != "comment":
                around.mark = "comment"
                found.append(around)
    return marked + found


def _first(node: Node) -> bool:
    """Whether nothing with text stands before a node in its parent."""
    for part in node.parent.parts:
        if part is node:
            return True
        if not _empty(part):
            return False
    return False


def _postorder(root: Node) -> list[Node]:
    """Elements that are not left out, children before parents (iterative: pages may be nested deeply)."""
    todo, order = [root], []
    while todo:
        node = todo.pop()
        if not node.out:
            order.append(node)
            todo.extend(node.children())
    order.reverse()
    return order


def settle(body: Node, marked: list[Node]) -> None:
    """Leave out the marked elements that don't hold the article.

    An element with the ``h1`` stays, unless it is a page header. So does one
    with nine tenths of the text outside links and, if its mark is an everyday
    word or it is a form, one with most of it (on pages with an ``article`` or
    ``main``: only if it holds or is part of one). Everyday words that are
    part of a longer class or id count for lists of links alone.
    """
    if not marked:
        return
    order = _postorder(body)
    for n in order:
        kept = [c for c in n.children() if not c.out]
        n.chars = sum(len("".join(p.split())) for p in n.parts if type(p) is str) + sum(c.chars for c in kept)
        n.link_tags = sum(c.link_tags + (c.tag == "a") for c in kept)
        n.link_chars = n.chars if n.tag == "a" else sum(c.link_chars for c in kept)
        n.title = n.tag == "h1" or any(c.title for c in kept)
        n.article = n.tag in ("article", "main") and n.chars > 0 or any(c.article for c in kept)
    all_plain = total = body.chars - body.link_chars
    for comments in (True, False):
        todo = [(body, body.tag in ("article", "main"))]
        while todo:                                   # in page order; nothing below what is left out
            n, inside = todo.pop()
            if n.mark and n is not body and (n.mark == "comment") is comments:
                plain = n.chars - n.link_chars
                most = 2 * plain > total and (n.article or inside or not body.article)
                heavy = n.link_tags >= 3 and 2 * n.link_chars > n.chars
                if n.title and n.mark != "header":
                    n.out = False
                elif n.mark in ("comment", "strong"):
                    n.out = 10 * plain <= 9 * all_plain
                else:
                    n.out = not most and (n.mark != "part" or heavy)
                if n.out and comments:
                    total -= plain
            if not n.out:
                within = inside or n.tag in ("article", "main")
                todo.extend((c, within) for c in reversed(list(n.children())) if not c.out)


def measure(body: Node) -> list[Node]:
    """Fill in counts, densities and density sums below ``body``; returns its elements, children first."""
    order = _postorder(body)
    for n in order:
        kept = [c for c in n.children() if not c.out]
        n.chars = sum(len("".join(p.split())) for p in n.parts if type(p) is str) + sum(c.chars for c in kept)
        n.tags = sum(c.tags + 1 for c in kept)
        n.link_tags = sum(c.link_tags + (c.tag == "a") for c in kept)
        n.link_chars = n.chars if n.tag == "a" else sum(c.link_chars for c in kept)
    share = body.link_chars / body.chars if body.chars else 0.0
    for n in order:
        if n.chars:
            plain = n.chars - n.link_chars
            base = math.log(n.chars / max(plain, 1) * n.link_chars + share * n.chars + math.e)
            ratio = n.chars / max(n.link_chars, 1) * max(n.tags, 1) / max(n.link_tags, 1)
            n.density = n.chars / max(n.tags, 1) * max(math.log(max(ratio, 1.0)) / base, 0.0)
        n.density_sum = sum(c.density for c in n.children() if not c.out)
    return order


def _choose(body: Node, order: list[Node]) -> tuple[list[Node], float]:
    """The elements that hold the main text, and the page's threshold."""
    texts = [n for n in order if n.chars]
    if not texts:
        return [], 0.0
    best = max(reversed(texts), key=lambda n: n.density_sum)
    if not best.density_sum:
        return [body], 0.0                    # text with no element around it
    threshold, n = best.density, best
    while n is not body and n.parent is not None:
        n = n.parent
        if n.chars:
            threshold = min(threshold, n.density)
    largest: dict[int, Node] = {}             # of every branch: its element with the largest density sum
    for n in order:
        top = n
        for c in n.children():
            if not c.out and largest[id(c)].density_sum > top.density_sum:
                top = largest[id(c)]
        largest[id(n)] = top
    chosen, todo = [], [body]
    while todo:
        n = todo.pop()
        if n.out:
            continue
        if n.chars and n.density >= threshold:
            top = largest[id(n)]
            chosen.append(top if top.density_sum else n)
        todo.extend(n.children())
    around = _articles(body)
    if around.get(id(best)) is None:          # the main text stands in no article element, whatever teasers do
        chosen = [best, *(n for n in chosen if around.get(id(n)) is None)]
        if best is not body:
            chosen += _lead(body, best)
        return chosen, threshold
    return [a for n in chosen if (a := around.get(id(n))) is not None], threshold


def _articles(body: Node) -> dict[int, Node]:
    """Of every element in one: the outermost ``article`` around it, or else the outermost ``main``."""
    out: dict[int, Node] = {}
    todo: list[tuple[Node, Node | None, Node | None]] = [(body, None, None)]
    while todo:
        n, article, main = todo.pop()
        article = article or (n if n.tag == "article" else None)
        main = main or (n if n.tag == "main" else None)
        if article or main:
            out[id(n)] = article or main
        todo.extend((c, article, main) for c in n.children())
    return out


def _lead(body: Node, best: Node) -> list[Node]:
    """The page's only ``h1``, if it stands before the main text, and the blocks between them that are no lists of links."""
    titles, todo = [], [body]
    while todo:
        n = todo.pop()
        if not n.out:
            if n.tag == "h1" and n.chars:
                titles.append(n)
            todo.extend(n.children())
    if len(titles) != 1:
        return []
    path = {id(best)}
    n = best
    while n.parent is not None:
        n = n.parent
        path.add(id(n))
    out, n = [titles[0]], titles[0]
    while id(n) not in path:                  # up to the element that holds both
        parts = n.parent.parts
        begin = next(k for k, x in enumerate(parts) if x is n)
        for part in parts[begin + 1:]:
            if type(part) is Node and id(part) in path:
                return out
            if type(part) is Node and not part.out and part.chars and 2 * part.link_chars <= part.chars and part.tag not in INLINE:
                out.append(part)
        n = n.parent
    return []                                 # the title stands inside the main text or behind it




def _is_menu(node: Node) -> bool:
    """Three or more short links and no words beside them, without heading or paragraph, and not introduced by one.

    A list right below a heading, or after text that ends in a colon, belongs
    to the article, like references and long link texts (25 characters or more
    on average).
    """
    if node.tag not in LISTS or node.link_tags < 3 or node.chars - node.link_chars > 2 * node.link_tags or node.link_chars >= 25 * node.link_tags:
        return False
    todo = [node]
    while todo:
        n = todo.pop()
        if n.tag in HEADINGS or n.tag == "p":
            return False
        todo.extend(c for c in n.children() if not c.out)
    while True:
        parts = node.parent.parts
        before = next((k for k, x in enumerate(parts) if x is node), 0) - 1
        while before >= 0 and (parts[before].out or not parts[before].chars if type(parts[before]) is Node else not parts[before].strip()):
            before -= 1
        if before >= 0:
            last = parts[before]
            break
        node = node.parent                       # the first of its parent: what stands before that introduces it
        if node.parent is None or node.tag in ("article", "main", "body"):
            return True
    while type(last) is Node:
        if last.tag in HEADINGS:
            return False
        last = next((x for x in reversed(last.parts) if (not x.out and x.chars if type(x) is Node else x.strip())), "")
    return not last.rstrip().endswith((":", "："))


def main_text(html: str | None) -> str:
    """The article of a page: one line for each block of text; empty for null and for pages without text."""
    if not html:
        return ""
    root, marked = parse(html)
    body, todo = root, [root]
    while todo:
        n = todo.pop()
        if n.tag == "body":
            body = n
            break
        todo.extend(n.children())
    body.out = False
    settle(body, mark_comments(root, marked))
    order = measure(body)
    chosen, threshold = _choose(body, order)
    keep = {id(x) for x in chosen}
    lines: list[str] = []
    words: list[str] = []

    def end_block():
        line = _SPACES.sub(" ", "".join(words)).strip()
        if line:
            lines.append(line)
        words.clear()

    # depth first in page order; a marker after an element's parts ends its block
    stack: list = [(body, id(body) in keep)]
    while stack:
        part, inside = stack.pop()
        if part is None:
            end_block()
        elif type(part) is str:
            if inside:
                words.append(part)
        elif part.tag == "br":
            end_block()
        elif not part.out:
            now = inside or id(part) in keep
            if inside and part.link_tags and part.density < threshold and _is_menu(part):
                end_block()
                continue
            if part.tag not in INLINE:
                end_block()
                stack.append((None, now))
            stack.extend((p, now) for p in reversed(part.parts))
        elif part.tag not in INLINE:
            end_block()
    end_block()
    return "\n".join(lines)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text and n_chars (its code points).

    Null html gives an empty text. Repeated rows give repeated rows; an empty
    table gives none; other columns are ignored.
    """
    src = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"))
    schema = src.select("page_id", "url", F.col("html").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    kinds = [to_arrow_type(f.dataType) for f in schema.fields]

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for lo, hi in text_slices(b.column(2)):
                part = b.slice(lo, hi - lo)
                texts = [main_text(h) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, kinds[2]), pa.array(map(len, texts), kinds[3])], schema.names)

    return src.mapInArrow(run, schema)
