"""A small HTML tree for extraction: tolerant tokenizer, tree builder, text blocks."""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes plaintext".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: A start tag of the key closes an open element of the values, within its container.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "tbody": {"table"}, "tfoot": {"table"}}

#: Elements and class, id and role words that are never main text.
DROP_TAGS = frozenset("nav header footer aside form script style noscript template iframe object svg canvas button select textarea input label dialog menu audio video math head title".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_NOISE = "ad ads advert adverts advertisement advertising adbox adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay nav navbar navigation menu menubar breadcrumb breadcrumbs header footer sidebar sidebars aside widget widgets comment comments commentlist disqus respond replies reply share sharing social related recommended subscribe newsletter signup login search pagination pager toolbar masthead copyright legal disclaimer skip"
DROP_WORDS = frozenset(_NOISE.split())
#: A page may name its main part with one of these words in class or id.
MAIN_WORDS = frozenset("article main post entry content story".split())

_NAME = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_STOP = re.compile("[>\"']")
#: Tags up to this length are matched at once; the rest are scanned for.
_SHORT = 400
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Node:
    """An element; ``kids`` holds elements and text runs in page order."""

    tag: str
    label: str
    words: frozenset = frozenset()
    role: str = ""
    hidden: bool = False
    kids: list = field(default_factory=list)


def _attributes(raw: str) -> tuple[str, frozenset, str, bool]:
    label, words, role, hidden = "", set(), "", False
    for m in _ATTR.finditer(raw):
        name, value = m[1].lower(), m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
        if name in ("class", "id"):
            spaced = re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()
            words.update(_WORDS.findall(spaced))
            label += f" {name}={re.sub(r'[0-9]+', '0', value)}"
        elif name == "role":
            role = value.strip().lower()
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value, re.I)):
            hidden = True
    return label, frozenset(words), role, hidden


_seen = lru_cache(4096)(_attributes)


class Scanner:
    """Finds where tags end, in time that grows with the page alone.

    A tag ends at the first ``>`` outside quotes.  Where a scan ran into the page's end,
    every scan that comes by one of its places does so, too; they are remembered."""

    def __init__(self, page: str):
        self.page, self.hopeless = page, set()

    @cached_property
    def stops(self) -> list[int]:
        return [m.start() for m in _STOP.finditer(self.page)]

    def end(self, at: int) -> int:
        """Place of the ``>`` that ends the tag whose name ends at ``at``; -1 if there is none."""
        passed: list[int] = []
        while (k := bisect_left(self.stops, at)) < len(self.stops) and (stop := self.stops[k]) not in self.hopeless:
            if self.page[stop] == ">":
                return stop
            passed.append(stop)
            at = self.page.find(self.page[stop], stop + 1) + 1
            if not at:
                break
        self.hopeless.update(passed)
        return -1

    def token(self, at: int) -> tuple[str, str, str, int] | None:
        """What begins with the ``<`` at a place, if it has an end: ``/`` for an end tag, the name,
        the rest of the tag, and where it ends.  Comments and declarations have no name, a
        marked text has the rest alone."""
        page, n = self.page, len(self.page)
        if m := _TAG.match(page, at, at + _SHORT):
            return m[1], m[2].lower(), m[3], m.end()
        if m := _NAME.match(page, at):
            close = self.end(m.end())
            return (m[1], m[2].lower(), page[m.end() : close], close + 1) if close >= 0 else None
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            return "", "", "", end + 3 if end >= 0 else n
        if page.startswith("<![CDATA[", at):
            end = page.find("]]>", at + 9)
            return "", "", page[at + 9 : end if end >= 0 else n], end + 3 if end >= 0 else n
        if page.startswith(("<!", "<?"), at):
            end = page.find(">", at + 2)
            return "", "", "", end + 1 if end >= 0 else n
        return None


class Stack:
    """Open elements, with the places of each tag and of the nearest block."""

    def __init__(self, root: Node):
        self.nodes, self.places, self.blocks = [root], {}, [0]

    def push(self, node: Node) -> None:
        at = len(self.nodes)
        self.places.setdefault(node.tag, []).append(at)
        self.blocks.append(at if node.tag in BLOCK else self.blocks[-1])
        self.nodes.append(node)

    def last(self, *tags: str) -> int:
        """Place of the innermost open element with one of the tags; 0 if there is none."""
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=0)

    def close(self, at: int) -> None:
        """Close the element at a place and all inside it."""
        for x in self.nodes[at:]:
            self.places[x.tag].pop()
        del self.nodes[at:], self.blocks[at:]


def tree(page: str) -> Node:
    """The element tree of a page; never fails, unclosed elements end with their parent, and the
    time grows with the page's length.  What looks like a tag but has no end is text."""
    root = Node("#root", "#root")
    stack, scanner = Stack(root), Scanner(page)
    at, found, n = 0, page.find("<"), len(page)
    while found >= 0:
        token = scanner.token(found)
        if not token:
            found = page.find("<", found + 1)
            continue
        if found > at:
            stack.nodes[-1].kids.append(page[at:found])
        slash, tag, raw, at = token
        if not tag:
            if raw:
                stack.nodes[-1].kids.append(raw)
        elif slash:
            if place := stack.last(tag):
                stack.close(place)
            elif tag in ("p", "br"):
                stack.nodes[-1].kids.append(Node(tag, tag))
        else:
            if tag in BLOCK and stack.nodes[stack.blocks[-1]].tag == "p":
                stack.close(stack.blocks[-1])
            if tag in CLOSES and (place := stack.last(*CLOSES[tag])) > stack.last(*SCOPE.get(tag, ())):
                stack.close(place)
            label, words, role, hidden = (_seen if len(raw) <= _SHORT else _attributes)(raw) if raw.strip(" /") else ("", frozenset(), "", False)
            node = Node(tag, tag + label, words, role, hidden)
            stack.nodes[-1].kids.append(node)
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                node.kids.append(page[at : end.start() if end else n])
                at = end.end() if end else n
            elif tag not in VOID and not raw.endswith("/"):
                stack.push(node)
        found = page.find("<", at)
    if at < n:
        stack.nodes[-1].kids.append(page[at:])
    return root


def dropped(node: Node) -> bool:
    return node.hidden or node.tag in DROP_TAGS or node.role in DROP_ROLES or (bool(node.words & DROP_WORDS) and not (node.tag in ("article", "main", "body", "html") or node.words & MAIN_WORDS and not node.words & {"ad", "ads", "comment", "comments", "sidebar", "footer", "header", "nav", "related"}))


def main_part(root: Node) -> list[Node]:
    """The page's ``article`` or ``main`` elements outside dropped parts, outermost first, else its root."""
    articles: list[Node] = []
    mains: list[tuple[Node, int]] = []  # with the place of the main around it
    full: set[int] = set()  # places of mains that hold an article
    todo = [(k, -1) for k in reversed(root.kids) if not isinstance(k, str)]
    while todo:
        k, around = todo.pop()
        if dropped(k):
            continue
        if k.tag == "article" or k.role == "article":
            articles.append(k)
            while around >= 0 and around not in full:
                full.add(around)
                around = mains[around][1]
            continue
        if k.tag == "main" or k.role == "main":
            mains.append((k, around))
            around = len(mains) - 1
        todo += [(x, around) for x in reversed(k.kids) if not isinstance(x, str)]
    alone = [m for i, (m, _) in enumerate(mains) if i not in full]
    return articles + alone if articles and not alone else articles or alone or [root]


def clean(runs: list[str]) -> str:
    """Runs of one block: references decoded, white space turned into single spaces, trimmed."""
    return _SPACE.sub(" ", "".join([html.unescape(r) if "&" in r else r for r in runs])).strip()
