"""HTML extraction: the main text of a page by tree scoring.

The markup becomes a tree as browsers nest it: comments, declarations and raw text apart, void elements,
paragraphs and list items closed by what follows them, end tags without a start left out. Branches that are not
the article by what they are (menus, footers, asides, forms, scripts, embedded media), by role, by a class or id
(adverts, notices, sidebars, reader comments) or because they are hidden are cut. Every paragraph, that is a
``p`` or the like, or text that stands in a container directly, is worth 1 point, 1 for each comma and 1 for
each 100 characters up to 3 (a heading a tenth of a point); its container gets them whole, the one above a half, the n-th above that 1/(3n),
for ``LEVELS`` containers. A container's score is its points times the share of its text that is not in links. The
best container is kept, widened to the ``article`` or ``main`` it lies in, with those siblings that score a fifth of it
at least, that are sentences with few links, or that are headings before it. A ``header`` is cut unless it holds
the headline inside an article.

The text kept is whole: character references are decoded, white space (as Unicode has it) inside a block
becomes one space, blocks are joined in page order by one space.

Scale: a narrow step without shuffle, linear in the page; tasks hold a few megabytes of pages at a time,
or one page.

Defined results: null or empty html, or html without text outside of what is cut, gives empty text; repeated
rows are rows of their own; an empty table gives no rows; other columns are passed over.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import text_slices

#: Containers above a paragraph that share in its points.
LEVELS = 5
#: Share of the best score from which a sibling of the best container is kept.
SIBLING_SHARE = 0.2

# Elements by their kind.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li listing main menu nav ol p pre search section
    summary table tbody td tfoot th thead tr ul""".split())
PARAGRAPHS = set("p pre blockquote h1 h2 h3 h4 h5 h6 figcaption dt dd".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Elements inside which an end or a new item cannot close what is open outside.
SCOPES = set("html body table td th caption button object template".split())
#: What the start of an element closes, if open nearer than one of the given boundaries.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "body": ({"head"}, set()),
}
CUT = set("""head script style noscript template iframe object embed svg canvas audio video map nav aside footer menu
    dialog button select textarea input datalist output progress meter noembed noframes search""".split())
CUT_ROLES = set("""navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar
    tablist form status tooltip""".split())
#: Words of a class or id that name something beside the article.
CUT_WORDS = set("""ad ads advert adverts advertisement advertisements advertising adsense adslot adbox adunit banner
    sponsor sponsored sponsors promo promotion promoted nav navbar navigation menu menubar submenu breadcrumb breadcrumbs
    pagination pager header masthead topbar footer sidebar sidebars aside rail notice notices cookie cookies consent gdpr
    alert alerts popup modal overlay newsletter subscribe subscription signup login paywall form comment comments
    commentlist commentform disqus respond replies discussion share sharing social related recommended recommendations
    widget widgets toolbar skip skiplink hidden""".split())
#: Words that name the article itself: a class or id of these alone outweighs the others.
OWN_WORDS = set("article content main body text post entry story page".split())
#: First words of a class that tells something of its surroundings.
LAYOUT_WORDS = {"with", "has", "no", "without"}
#: Elements that are never cut for their names.
WHOLE = {"html", "body", "main"}
NO_NAMES: frozenset[str] = frozenset()

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*+)(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
COMMA = re.compile("[,،、，﹐]")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "parent", "children", "names", "cut", "points", "chars", "link_chars")

    def __init__(self, tag: str, parent: Node | None, attributes: str = ""):
        self.tag, self.parent, self.children = tag, parent, []
        self.points, self.chars, self.link_chars = 0.0, 0, 0
        self.cut, self.names = tag in CUT, NO_NAMES
        if parent is not None:
            parent.children.append(self)
        if attributes and not attributes.isspace():
            self._look(attributes)

    def _look(self, attributes: str) -> None:
        for name, value in ATTRIBUTE.findall(attributes):
            name = name.lower()
            value = unescape(value.strip("\"'")) if value else ""
            if name in ("class", "id") and self.tag not in WHOLE:
                self.names |= named(value)
            elif name == "role":
                self.cut = self.cut or value.lower() in CUT_ROLES
            elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (
                    name == "style" and UNSEEN.search(value)):
                self.cut = self.tag not in WHOLE
        if "" in self.names:  # a name of the article
            self.names = NO_NAMES


def named(value: str) -> set[str]:
    """The words of a class or id that name something beside the article; "" if one names the article itself."""
    found: set[str] = set()
    for name in value.split():
        words = [w.lower() for w in NAME_WORD.findall(name)]
        if words and words[0] not in LAYOUT_WORDS:
            found |= CUT_WORDS.intersection(words) or ({""} if OWN_WORDS.issuperset(words) else set())
    return found


def tree(html: str) -> Node:
    root = node = Node("html", None)
    opened: Counter[str] = Counter()
    at = 0

    def close(tags: set[str], bounds: set[str]) -> None:
        """Ends the nearest open element of ``tags``, unless one of ``bounds`` is nearer."""
        nonlocal node
        if not any(opened[t] for t in tags):
            return
        found = node
        while found is not root and found.tag not in tags:
            if found.tag in bounds:
                return
            found = found.parent
        if found is not root:
            while node is not found:
                opened[node.tag] -= 1
                node = node.parent
            opened[found.tag] -= 1
            node = found.parent

    while m := TOKEN.search(html, at):
        if m.start() > at:
            node.children.append(html[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            close({tag}, SCOPES - {tag} if tag in BLOCKS else BLOCKS | SCOPES)
            continue
        if tag == "html":
            continue
        if tag in BLOCKS:
            close({"p"}, SCOPES)
        if tag in CLOSES:
            close(*CLOSES[tag])
        new = Node(tag, node, m[3])
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            stop = end.start() if end else len(html)
            new.children.append(html[at:stop])
            at = stop
            new.cut = True
        elif tag not in VOID:
            node = new
            opened[tag] += 1
    if at < len(html):
        node.children.append(html[at:])
    return root


def in_page_order(root: Node) -> list[Node]:
    """The nodes, parents before their children."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(c for c in reversed(node.children) if type(c) is Node)
    return out


def prune(root: Node) -> list[Node]:
    """Marks what is not the article, and returns the nodes that stay, in page order."""
    nodes = in_page_order(root)
    articles: set[int] = set()  # nodes that hold an article of no other kind
    headed: set[int] = set()
    for n in reversed(nodes):
        if (n.tag in ("article", "main") and not n.names and not n.cut) or id(n) in articles:
            articles.add(id(n.parent))
        if n.tag in HEADINGS or (id(n) in headed and n.tag not in ("article", "section")):
            headed.add(id(n.parent))
    inside: set[int] = set()
    kept, todo = [], [root]
    while todo:
        n = todo.pop()
        if n.tag == "article" or n.tag == "main" or (n.parent is not None and id(n.parent) in inside):
            inside.add(id(n))
        if n.tag == "header" or (n.names and n.names == {"header"}):
            n.cut = n.cut or not (id(n) in inside and id(n) in headed)
        elif n.names and id(n) not in articles:
            n.cut = True
        elif n.tag == "form" and id(n) not in articles and not _wraps(n):
            n.cut = True
        if not n.cut:
            kept.append(n)
            todo.extend(c for c in reversed(n.children) if type(c) is Node)
    return kept


def _wraps(form: Node) -> bool:
    """Whether a form is only wrapped around a page: it holds three paragraphs or more."""
    return sum(n.tag == "p" for n in in_page_order(form)) >= 3


def score(kept: list[Node]) -> None:
    """Points and text lengths of the nodes that stay."""
    paragraph: dict[int, list] = {}  # paragraph or container -> [node, text length, commas]
    where: dict[int, Node] = {}  # node -> the nearest block it is in
    linked: set[int] = set()
    for n in kept:
        up = n.parent
        block = n if n.tag in BLOCKS or up is None else where[id(up)]
        where[id(n)] = block
        if n.tag == "a" or (up is not None and id(up) in linked):
            linked.add(id(n))
        for c in n.children:
            if type(c) is str and (size := len(c.strip())):
                n.chars += size
                n.link_chars += size * (id(n) in linked)
                held = paragraph.setdefault(id(block), [block, 0, 0])
                held[1] += size
                held[2] += len(COMMA.findall(c))
    for n in reversed(kept):
        if n.parent is not None:
            n.parent.chars += n.chars
            n.parent.link_chars += n.link_chars
    for block, size, commas in paragraph.values():
        points = 0.1 if block.tag in HEADINGS else 1 + commas + min(size / 100, 3)
        holder = block.parent if block.tag in PARAGRAPHS and block.parent is not None else block
        for level in range(LEVELS):
            if holder is None:
                break
            holder.points += points / (1, 2, 6, 9, 12)[level]
            holder = holder.parent


def value(n: Node) -> float:
    return n.points * (1 - n.link_chars / n.chars) if n.chars else 0.0


def best_parts(kept: list[Node]) -> list[Node]:
    """The best container and the siblings that belong to it, in page order."""
    best = max(kept, key=value)
    most = value(best)
    if most <= 0:
        return []
    up = best
    while up is not None:  # the article that the best container lies in
        if up.tag in ("article", "main"):
            best = up
            if up.tag == "article":
                break
        up = up.parent
    if best.parent is None or best.tag == "body":
        return [best]
    parts, before = [], True
    for c in best.parent.children:
        if c is best:
            parts.append(c)
            before = False
        elif type(c) is Node and not c.cut and c.chars:
            links = c.link_chars / c.chars
            sentence = c.tag == "p" and links < 0.25 and (c.chars > 80 or (not links and _text([c])[-1:] in ".!?。"))
            if value(c) >= most * SIBLING_SHARE or sentence or (before and c.tag in HEADINGS and not links):
                parts.append(c)
    return parts


def _text(parts: list[Node]) -> str:
    pieces: list[str] = []
    todo: list[Node | str] = list(reversed(parts))
    while todo:
        n = todo.pop()
        if type(n) is str:
            pieces.append(unescape(n) if "&" in n else n)
        elif not n.cut:
            gap = n.tag in BLOCKS or n.tag == "br"
            if gap:
                pieces.append(" ")
                todo.append(" ")
            todo.extend(reversed(n.children))
    return " ".join("".join(pieces).split())


def main_text(html: str) -> str:
    """The page's main text."""
    kept = prune(tree(html))
    score(kept)
    return _text(best_parts(kept))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: ``page_id, url, text, n_chars``."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in text_slices(batch, 2):
                texts = [main_text(h) for h in some.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url string, text string, n_chars long")
