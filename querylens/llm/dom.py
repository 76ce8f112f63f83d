"""A page's blocks of text and the shape of its tree of block elements.

Elements inside a line of text are dissolved; a block is the text between two
borders of block elements. The tags of real pages nest badly, so end tags are
implied, and stray ones ignored, as browsers do. One pass over the page, with
work in proportion to its length.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Names of elements, as the HTML standard groups them (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside audio blockquote body button canvas caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav noscript "
    "object ol optgroup option p pre search section select summary svg table tbody td template tfoot th thead tr ul video".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
IN_HEAD = frozenset("noscript template".split())
TABLE = frozenset("table tbody thead tfoot tr td th caption html body".split())
# What a start tag ends, and the elements beyond which it ends nothing.
IMPLIED = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})),
    "dd": (frozenset({"dd", "dt"}), frozenset({"dl"})),
    "dt": (frozenset({"dd", "dt"}), frozenset({"dl"})),
    "tr": (frozenset({"tr"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "tbody": (frozenset({"tbody", "thead", "tfoot", "caption"}), frozenset({"table"})),
    "tfoot": (frozenset({"tbody", "thead", "tfoot", "caption"}), frozenset({"table"})),
    "option": (frozenset({"option"}), frozenset({"select"})),
}
SCOPE = frozenset("td th caption template object button html".split())
# Browsers nest no deeper either; what is deeper belongs to the last element.
DEPTH = 512

# Elements, roles and words of class names that mark what isn't the article.
DROPPED = frozenset(
    "head nav header footer aside noscript template button select option optgroup dialog menu search svg object audio video "
    "canvas".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split()
)
DROPPED_WORDS = frozenset(
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager header masthead topbar footer sidebar "
    "sidebars aside rail notice notices cookie cookies consent gdpr banner alert popup modal overlay newsletter subscribe "
    "subscription signup ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion comment "
    "comments commentlist reply replies respond disqus share sharing social related recommended widget toolbar login "
    "search".split()
)
# Some sites put the whole page into a form.
DROPPED_UNLESS_AROUND = frozenset("form fieldset".split())
# A class such as "with-sidebar" or "page-header-wrapper" names what is around the article too.
AROUND_WORDS = frozenset("has with no without wrapper wrap container layout page body main content article entry post".split())

_ATTRS = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+"""
_RAW = "script|style|title|textarea|iframe|noembed|noframes|xmp"
_TAG = re.compile(
    rf"<!--(?:-?>|.*?(?:--!?>|\Z))"
    rf"|<({_RAW})(?=[\s/>]){_ATTRS}(?:>|\Z)(?:[^<]++|<(?!/\1[\s/>]))*+(?:</\1[^>]*+(?:>|\Z))?"
    rf"|<(/?)([a-z][^\s/>]*+)({_ATTRS})(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_NAMED = re.compile(r"""(?<![^\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_UNSAFE = re.compile(r"[^a-z_-]+")


@dataclass
class Page:
    """``texts`` with the folded node, the region and the number of characters inside links of each; see ``parse``."""

    shape: str = ""
    texts: list[str] = field(default_factory=list)
    nodes: list[int] = field(default_factory=list)
    regions: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)


NO_REGION, MAIN, ARTICLE = 0, 1, 2


def _names(attrs: str) -> tuple[list[str], str]:
    """Words of class and id, and the role."""
    words, role = [], ""
    for kind, *values in _NAMED.findall(attrs):
        value = "".join(values)
        if kind.lower() == "role":
            role = value.strip().lower()
        else:
            words += value.split()
    return words, role


def _marked(words: list[str]) -> bool:
    for word in words:
        parts = {p.lower() for p in _WORDS.findall(word)}
        if parts & DROPPED_WORDS and not parts & AROUND_WORDS:
            return True
    return False


class _Tree:
    """Elements in the order they begin, and the blocks of text in them."""

    def __init__(self):
        self.names = ["#"]
        self.labels = ["#"]
        self.parents = [-1]
        self.drops = [False]  # by element or role
        self.marks = [False]  # by class, or as a form, unless the article is inside
        self.kinds = [NO_REGION]
        self.stack = [0]
        self.owners: list[int] = []
        self.pieces: list[str] = []  # of the block at hand
        self.linked = 0
        self.links = 0  # open ones
        self.texts: list[str] = []
        self.link_chars: list[int] = []
        self.inline: dict[str, list[bool]] = {}
        self.open_now: dict[str, int] = {}  # open elements of each name

    def add_text(self, text: str) -> None:
        self.pieces.append(text)
        if self.links:
            self.linked += len(text)

    def border(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.texts.append(text)
                self.owners.append(self.stack[-1])
                self.link_chars.append(min(self.linked, len(text)))
            self.pieces = []
            self.linked = 0

    def close(self, ends: frozenset[str], beyond: frozenset[str]) -> None:
        """End the innermost element of ``ends`` and all in it, unless one of ``beyond`` is reached before."""
        names, stack, open_now = self.names, self.stack, self.open_now
        if not any(open_now.get(name) for name in ends):
            return
        for at in range(len(stack) - 1, 0, -1):
            name = names[stack[at]]
            if name in ends:
                self.border()
                for i in stack[at:]:
                    open_now[names[i]] -= 1
                del stack[at:]
                return
            if name in beyond:
                return

    def open(self, name: str, attrs: str, block: bool) -> bool:
        """Start an element; False if it is dissolved in the text."""
        words, role, marked = [], "", False
        if attrs and "=" in attrs:
            words, role = _names(attrs)
            marked = bool(words) and _marked(words)
        if not block and not marked:
            return False
        self.border()
        if block:
            if name not in IN_HEAD and (name == "body" or self.names[self.stack[-1]] == "head"):
                self.close(_HEAD, frozenset())
            if name in CLOSES_P:
                self.close(_P, SCOPE)
            if name in IMPLIED:
                self.close(*IMPLIED[name])
        if len(self.stack) >= DEPTH:
            return False
        kept = sorted({_UNSAFE.sub("", w.lower()) for w in words} - {""})
        self.names.append(name)
        self.labels.append(".".join([name if block else "span", *kept]))
        self.parents.append(self.stack[-1])
        self.drops.append(name in DROPPED or role in DROPPED_ROLES)
        self.marks.append(marked and name not in ("html", "body") or name in DROPPED_UNLESS_AROUND)
        kind = ARTICLE if name == "article" or role == "article" else MAIN if name == "main" or role == "main" else NO_REGION
        self.kinds.append(kind)
        self.stack.append(len(self.names) - 1)
        self.open_now[name] = self.open_now.get(name, 0) + 1
        return True


_P, _HEAD, _A = frozenset({"p"}), frozenset({"head"}), "a"


def _read(text: str) -> _Tree:
    tree = _Tree()
    at = 0
    for m in _TAG.finditer(text):
        if m.start() > at:
            piece = text[at : m.start()]
            tree.add_text(html.unescape(piece) if "&" in piece else piece)
        at = m.end()
        name = m[3]
        if name is None:
            continue
        name = name.lower()
        if m[2]:
            if name in BLOCK:
                tree.close(frozenset({name}), frozenset() if name in TABLE else SCOPE - {name})
                continue
            if name == _A:
                tree.links = max(0, tree.links - 1)
            opened = tree.inline.get(name)
            if opened and opened.pop():
                tree.close(frozenset({name}), BLOCK)
        elif name == "br":
            tree.add_text(" ")
        elif name == "hr":
            tree.border()
            tree.close(_P, SCOPE)
        elif name not in VOID:
            block = name in BLOCK
            element = tree.open(name, m[4], block)
            if not block:
                tree.inline.setdefault(name, []).append(element)
                if name == _A:
                    tree.links += 1
    if at < len(text):
        piece = text[at:]
        tree.add_text(html.unescape(piece) if "&" in piece else piece)
    tree.border()
    return tree


def _folded(tree: _Tree) -> tuple[str, list[int]]:
    """The shape of the tree with equal siblings folded into one, and each element's node in it.

    Siblings are equal if they have the same label and equal children, of each
    kind one or more. Nodes are numbered in the order of the shape's text.
    """
    n = len(tree.names)
    children: list[dict[int, None]] = [{} for _ in range(n)]
    kinds: dict[tuple, int] = {}
    shapes: list[str] = []
    sizes: list[int] = []
    offsets: list[dict[int, int]] = []
    of = [0] * n
    for i in range(n - 1, -1, -1):  # children begin after their parents
        inner = tuple(reversed(children[i]))
        key = (tree.labels[i], inner)
        kind = kinds.get(key)
        if kind is None:
            kind = kinds[key] = len(shapes)
            shapes.append(tree.labels[i] + (f"({','.join([shapes[k] for k in inner])})" if inner else ""))
            place, where = 1, {}
            for k in inner:
                where[k] = place
                place += sizes[k]
            offsets.append(where)
            sizes.append(place)
        of[i] = kind
        if i:
            first = children[tree.parents[i]]
            first.pop(kind, None)  # the one that begins first decides the order
            first[kind] = None
    nodes = [0] * n
    for i in range(1, n):
        parent = tree.parents[i]
        nodes[i] = nodes[parent] + offsets[of[parent]][of[i]]
    return shapes[of[0]], nodes


def parse(text: str | None) -> Page:
    """The blocks of a page that aren't in a menu, header, footer, sidebar, notice, advert, form, script or comment.

    A block's region says whether an article, or else a main element, is
    around it. An empty page, or NULL, has no blocks.
    """
    if not text:
        return Page()
    tree = _read(text)
    n = len(tree.names)
    holds = [kind != NO_REGION for kind in tree.kinds]  # the article, or an element around it
    for i in range(n - 1, 0, -1):
        if holds[i] and not tree.drops[i]:
            holds[tree.parents[i]] = True
    gone, region = [False] * n, [NO_REGION] * n
    for i in range(1, n):
        parent = tree.parents[i]
        inside = region[parent] != NO_REGION  # of several articles, those of comments and teasers are marked
        gone[i] = gone[parent] or tree.drops[i] or tree.marks[i] and (inside or not holds[i])
        region[i] = max(region[parent], tree.kinds[i])
    shape, nodes = _folded(tree)
    page = Page(shape)
    for text, owner, linked in zip(tree.texts, tree.owners, tree.link_chars):
        if not gone[owner]:
            page.texts.append(text)
            page.nodes.append(nodes[owner])
            page.regions.append(region[owner])
            page.linked.append(linked)
    return page
