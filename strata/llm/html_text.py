"""Main text of web pages by tree scoring.

A page is read into a tree of block elements. Every paragraph gives points
for its length and commas to its parent, half to the grandparent and less to
ancestors above, discounted by its link density. The container with the best
score is the article, or the ``article`` or ``main`` element around it, which
is taken whole. Siblings with few links are kept if they hold text of some
length or a sentence, and so are headings, lists and other pieces between or
next to kept ones. Menus, page headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments don't enter the tree. What is furniture
by a name only, or is a form, must have less text than the article: if it holds
the container that scores best without it, it stays. Lists of links in ``main``
go with their headings.

Defined results
* Null and empty pages, and pages without text, give the empty text.
* Cut-off pages, unclosed and stray tags are read as far as they go.
* Character references are decoded once. White space inside a block becomes
  one blank; blocks are joined in page order by one line end.
* Repeated rows are separate rows; an empty table gives no rows. Other columns
  are carried along, and ``main_text`` replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strata.llm.common import slices, with_fields

# fixed values: element names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
PARAGRAPH = frozenset("p pre blockquote li dd dt td th h1 h2 h3 h4 h5 h6 figcaption caption summary".split())
DROPPED = frozenset("nav footer aside script style noscript template iframe object svg math button select textarea dialog menu title head video audio canvas map".split())
LISTS = frozenset("ul ol dl table".split())
CLOSED_BY_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6".split())
# fixed values: the implied ends of HTML, for what is open inside furniture
CLOSES_P = frozenset("address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
                     "li main menu nav ol p pre search section summary table ul".split())
_HEADINGS, _ROWS = CLOSED_BY_BLOCK - {"p"}, frozenset("tr td th".split())
CLOSES = ({h: _HEADINGS for h in _HEADINGS} | {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": _ROWS}
          | {t: _ROWS | {"tbody", "thead", "tfoot"} for t in ("tbody", "thead", "tfoot")})
TABLE_PARTS = frozenset("table tbody thead tfoot tr td th caption".split())
TABLE_SCOPE = ("table", "template")  # end tags of elements around these don't reach out of them
SCOPE = ("table", "caption", "td", "th", "object", "template", "select", "math", "svg")
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg")
# fixed values: words that name page furniture in class and id attributes, and roles that do
FURNITURE = re.compile(
    r"(?:ads?|advert\w*|banner|breadcrumbs?|byline|comments?|commentlist|consent|cookies?|disqus|footer|gdpr|masthead|menu|modal|nav|navbar|navigation|navi|navmenu|"
    r"newsletter|notices?|overlay|paywall|popup|promo\w*|recommended|related|replies|respond|share|sharing|sidebar|signup|skip|social|sponsor\w*|"
    r"subscribe|tags|toolbar|widget)")
# fixed values: those that name reader comments and consent, however long their text is
NEVER_TEXT = frozenset("comment comments commentlist consent cookie cookies disqus gdpr replies respond".split())
# fixed values: words that say a wrapper has furniture or in which state it is; plain names of boxes; where a box stands
MODIFIERS = frozenset("has have with without no non not is are show hide open opened closed enabled disabled active visible layout".split())
BOXES = frozenset("area articles bar block box button buttons container content field form group icon icons inner item items link links list media news panel posts section "
                  "slot stories text title unit".split())
PLACES = frozenset("article bottom desktop entry fixed global left main mobile page post primary right secondary site sticky sub top wp".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar toolbar".split())
KEEP = frozenset("html body article main".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<(" + "|".join(RAW) + r")(?=[\s/>])[^>]*(?<!/)>.*?(?:</\1\s*>|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S | re.I)
# one attribute, its value with it, so that a value is never read as names
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?|["']""")


_UNQUOTED = re.compile(r"=\s*[^\s\"'>]+/$")  # a slash that ends a value, not the tag


def _self_closed(attributes: str | None) -> bool:
    return bool(attributes) and attributes.endswith("/") and not _UNQUOTED.search(attributes)


@lru_cache(maxsize=1 << 14)
def _names_furniture(value: str) -> str:
    """The furniture word of a class or id: a token that is one, beside plain
    names of boxes and places only. Other words beside it (``share-prices``)
    speak of something else; a modifier (``has-sidebar``) tells of a wrapper."""
    for token in value.lower().split():
        words = [w for w in re.split(r"[_-]+", token) if w and not w.isdigit()]
        named = [w for w in words if FURNITURE.fullmatch(w)] or (["header"] if words[:2] == ["site", "header"] else [])
        if FURNITURE.fullmatch(token) or named and all(w in named or w in BOXES or w in PLACES for w in words) and MODIFIERS.isdisjoint(words):
            return next(iter(named), token)
    return ""


SOME_TEXT = 100  # characters; what is named furniture and has less says nothing against a short text beside it


class Node:
    __slots__ = ("tag", "parent", "score", "order", "at", "named")

    def __init__(self, tag: str, parent: Node | None, at: int) -> None:
        self.tag, self.parent, self.score, self.at, self.named = tag, parent, 0.0, at, False  # at: where in the page it starts
        self.order: list = []  # nodes and blocks in page order


class Block:
    """A run of text without block elements inside."""

    __slots__ = ("parts", "linked", "paragraph")

    def __init__(self, paragraph: bool) -> None:
        self.parts: list[str] = []
        self.linked, self.paragraph = 0, paragraph

    def text(self) -> str:
        return " ".join(unescape("".join(self.parts)).split())


def _furniture(tag: str, attributes: str, inside_article: bool, parent: str) -> str:
    """"sure" (by its element, role or hiding, or comments), "named" (by a
    class, an id, or as a form: text that is longer than all else says
    otherwise) or "" (text)."""
    if tag in DROPPED or tag == "header" and not inside_article and parent in ("", "html", "body"):
        return "sure"
    named = "named" if tag == "form" else ""
    if not attributes or tag in KEEP:
        return named
    for found in _ATTRIBUTE.finditer(attributes):
        name, value = (found[1] or "").lower(), (found[2] or "").strip("\"'")
        if name == "role" and value.lower() in ROLES or name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return "sure"
        if name in ("class", "id") and (word := _names_furniture(value)):
            if word in NEVER_TEXT:
                return "sure"
            named = "named"
    return named


def parse(html: str, spared: frozenset[int] | None = frozenset()) -> tuple[Node, list[tuple[Node, Block]], int]:
    """The tree of a page, its blocks with the nodes that hold them, and how much
    text was left out in named furniture. Elements that start at ``spared``
    places (None: all) stay though they are named so."""
    root = here = Node("", None, 0)
    left_out, named_depth = 0, 0  # the depth in dropped furniture at which a named one began
    blocks: list[tuple[Node, Block]] = []
    block: Block | None = None
    dropped: list[str] = []  # open elements inside dropped furniture
    is_open, is_dropped = Counter(), Counter()  # so that stray end tags cost no search
    link, position, articles = 0, 0, 0

    def leave() -> None:
        nonlocal here
        is_open[here.tag] -= 1
        here = here.parent

    def drop(tag: str, attributes: str | None) -> None:
        if not _self_closed(attributes):
            dropped.append(tag)
            is_dropped[tag] += 1

    def undrop(n: int) -> None:
        for last in dropped[len(dropped) - n:]:
            is_dropped[last] -= 1
        del dropped[len(dropped) - n:]

    def imply_ends(tag: str) -> None:
        """Ends inside furniture, and of it, that the start of ``tag`` implies."""
        if tag in CLOSES_P and is_dropped["p"]:
            n = 1
            while n < len(dropped) and dropped[-n] in INLINE:
                n += 1
            if dropped[-n] == "p":
                undrop(n)
        closes = CLOSES.get(tag, ())
        while dropped and dropped[-1] in closes:
            undrop(1)

    def words(text: str) -> None:
        nonlocal block, left_out
        if dropped or not text:
            if dropped and named_depth:
                left_out += len(text.strip())
            return
        if block is None:
            if text.isspace():
                return
            block = Block(here.tag in PARAGRAPH)
            blocks.append((here, block))
            here.order.append(block)
        block.parts.append(text)
        if link:
            block.linked += len(text.strip())

    for token in _TOKEN.finditer(html):
        words(html[position:token.start()])
        position = token.end()
        closing, tag, attributes = token.group(2), token.group(3), token.group(4)
        if tag is None:
            continue
        tag = tag.lower()
        if dropped and not closing and tag not in INLINE:
            imply_ends(tag)
        if dropped:
            if closing:
                if is_dropped[tag]:
                    n = 1
                    while dropped[-n] != tag:
                        n += 1
                    undrop(n)
                    continue
                if not is_open[tag] or any(is_dropped[t] for t in (TABLE_SCOPE if tag in TABLE_PARTS else SCOPE)):
                    continue
                undrop(len(dropped))  # an element around the furniture ends, and the furniture with it
            else:
                if tag not in VOID:
                    drop(tag, attributes)
                continue
        if tag in ("br", "hr", "wbr", "img"):
            words("" if tag == "wbr" else " ")
            if tag == "hr":
                block = None
            continue
        if tag in VOID:
            continue
        if tag in INLINE:
            if tag == "a":
                link = 0 if closing else 1
            if not closing and (kind := _furniture(tag, attributes, articles > 0, here.tag)) and not (kind == "named" and (spared is None or token.start() in spared)):
                named_depth = kind == "named"
                drop(tag, attributes)
            continue
        block, link = None, 0
        if closing:
            if is_open[tag]:
                while here.tag != tag:
                    leave()
                leave()
                articles -= tag in ("article", "main")
            continue
        closes = CLOSES.get(tag, ())
        if here.tag in CLOSED_BY_BLOCK:
            leave()
        while here.tag in closes:
            leave()
        kind = _furniture(tag, attributes, articles > 0, here.tag)
        if kind and not (kind == "named" and (spared is None or token.start() in spared)):
            named_depth = kind == "named"
            drop(tag, attributes)
            continue
        node = Node(tag, here, token.start())
        node.named = kind == "named"
        here.order.append(node)
        here = node
        is_open[tag] += 1
        articles += tag in ("article", "main")
    rest = html[position:]
    if "<" in rest:  # a tag that the page breaks off in
        rest = rest[:rest.rindex("<")] if re.match(r"<[a-zA-Z/!]", rest[rest.rindex("<"):]) else rest
    words(rest)
    return root, blocks, left_out


def _gather(node: Node, out: list[str]) -> None:
    todo = [iter(node.order)]
    while todo:
        for item in todo[-1]:
            if isinstance(item, Block):
                if text := item.text():
                    out.append(text)
            else:
                todo.append(iter(item.order))
                break
        else:
            todo.pop()


def _joined(items: list[tuple]) -> list:
    """Of siblings marked as text, piece, other and links: the texts, what has
    few links between two of them, and the pieces right before and after."""
    marks = [mark for _, mark in items]
    first, last = marks.index("text"), len(marks) - 1 - marks[::-1].index("text")
    start, stop = first, last + 1
    while start and marks[start - 1] == "piece":
        start -= 1
    while stop < len(marks) and marks[stop] == "piece":
        stop += 1
    return [item for item, mark in items[start:stop] if mark != "links"]


def _points(text: str, linked: int) -> tuple[float, float]:
    density = min(1.0, linked / max(1, len(text)))
    return (0.5 + text.count(",") + min(3.0, len(text) / 100)) * (1 - density), density


def _score(root: Node, blocks: list[tuple[Node, Block]]) -> tuple[Node, dict[Node, list]]:
    """The container with the best score, and per node the characters and linked characters right in it."""
    sizes: dict[Node, list] = {}
    for node, block in blocks:
        text = block.text()
        if not text:
            continue
        points, _ = _points(text, block.linked)
        # a paragraph's container is its parent; text right inside a container counts for it
        holder = node.parent if block.paragraph and node.parent is not None else node
        holder.score += points
        own = sizes.setdefault(node, [0, 0])
        own[0] += len(text)
        own[1] += block.linked
    nodes = _below(root)
    passed: dict[Node, float] = {}  # what a container has from below its own paragraphs
    for node in reversed(nodes):  # children come before their parent
        below = passed.get(node, 0.0)
        if node.parent is not None:
            passed[node.parent] = passed.get(node.parent, 0.0) + node.score / 2 + below / 3
        node.score += below
    best = root
    for node in nodes:
        if node.score > best.score:
            best = node
    around = best
    while around is not None and around.tag not in ("article", "main"):
        around = around.parent
    return around or best, sizes


def _below(root: Node) -> list[Node]:
    """``root`` and all nodes in it, in page order."""
    nodes, todo = [], [root]
    while todo:
        nodes.append(todo.pop())
        todo += [x for x in reversed(nodes[-1].order) if isinstance(x, Node)]
    return nodes


def _kept(best: Node, sizes: dict[Node, list]) -> list[str]:
    """The container's blocks, and those of its siblings that are text."""
    def sized(item) -> tuple[int, int, str]:
        out: list[str] = []
        if isinstance(item, Block):
            text = item.text()
            return len(text), item.linked, text[-1:]
        _gather(item, out)
        return sum(map(len, out)) + max(0, len(out) - 1), sum(sizes.get(node, (0, 0))[1] for node in _below(item)), out[-1][-1:] if out else ""

    if best.tag == "main":
        _drop_link_lists(best, sizes)
    if best.parent is None:
        kept: list = [best]
    else:
        kept = []
        for item in best.parent.order:
            chars, linked, last = sized(item)
            density = min(1.0, linked / max(1, chars))
            if isinstance(item, Node) and item.tag == "header" and item is not best and best.tag not in ("article", "main"):
                continue  # of what is around the text
            if item is best or chars and (density < 0.25 and chars > 80 or density == 0 and last in ".!?"):
                kept.append((item, "text"))
            elif chars and density < 0.5:
                kept.append((item, "piece" if isinstance(item, Block) or item.tag in PARAGRAPH or item.tag in LISTS else "other"))
            elif chars:
                kept.append((item, "links"))
        kept = _joined(kept)
    out: list[str] = []
    for item in kept:
        if isinstance(item, Block):
            out.append(item.text())
        else:
            _gather(item, out)
    return out


def _drop_link_lists(main: Node, sizes: dict[Node, list]) -> None:
    """Take lists of links, each with its heading, out of a page's ``main``:
    unlike an ``article`` it may hold more than the text."""
    totals: dict[Node, list] = {}
    nodes = _below(main)
    for node in reversed(nodes):
        own = list(sizes.get(node, (0, 0)))
        for child in node.order:
            if isinstance(child, Node):
                own[0] += totals[child][0]
                own[1] += totals[child][1]
        totals[node] = own

    def links(item) -> bool:
        return isinstance(item, Node) and item.tag not in INLINE | CLOSED_BY_BLOCK and totals[item][1] > 0 and totals[item][1] >= 0.5 * totals[item][0]

    gone: set[int] = set()
    for node in nodes:
        if id(node) in gone:
            gone.update(id(x) for x in node.order)
            continue
        kept: list = []
        for item in node.order:
            if links(item):
                gone.add(id(item))
                if kept and isinstance(kept[-1], Node) and kept[-1].tag in _HEADINGS:
                    gone.add(id(kept.pop()))
            else:
                kept.append(item)
        node.order = kept


def main_text(html: str | None) -> str:
    """The article's blocks, joined by line ends."""
    if not html:
        return ""
    root, blocks, left_out = parse(html)
    out = _kept(*_score(root, blocks))
    if left_out > sum(map(len, out)):
        # named furniture held more than the text: does what is named so hold the article?
        best, sizes = _score(*parse(html, None)[:2])
        spared, node = set(), best
        while node is not None:
            if node.named:
                spared.add(node.at)
            node = node.parent
        held = [sizes.get(x, (0, 0)) for x in _below(best)]
        if spared and sum(n - linked for n, linked in held) > max(2 * sum(map(len, out)), SOME_TEXT if out else 0):
            out = _kept(*_score(*parse(html, frozenset(spared))[:2]))
    return "\n".join(out)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``main_text``."""
    src = pages.drop("main_text")
    schema = with_fields(src, ("main_text", T.StringType()))

    def run(batches):
        for batch in batches:
            for part in slices(batch, html_col):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(list(map(main_text, part.column(html_col).to_pylist())), pa.string())], names=schema.names)

    return src.mapInArrow(run, schema)
