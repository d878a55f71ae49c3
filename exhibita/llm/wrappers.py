"""Main text of web pages by wrappers inferred for each host.

A page becomes a stream of block tags and text slots; inline markup belongs to the text. Neighbouring elements of one
shape fold into repeated groups, and the streams of a host are aligned one after the other, level by level so that
groups stay balanced: what only one side has becomes optional, what follows itself becomes repeated, texts become a
slot. The outcome is a union-free regular expression over tags, the host's wrapper. It is inferred from the distinct
folded streams only, in groups of bounded size whose wrappers are aligned in turn, so a host with a third of all pages
is no heavier than its number of different layouts.

Every page is then matched against its host's wrapper, which says to which slot each of its texts belongs. What a slot
holds over all pages of the host decides: the article is where most of the text stands that changes and is not in links.
Names only hint. Elements that cannot hold an article (navigation, footers, comments, adverts, scripts, what is hidden)
are left out at once. Others that sound like surroundings (a form, ``social``, ``widget``) are marked and stay in the
stream; a marked element counts as content if it outweighs the text outside marks, see ``_opened``. Inside the article
nothing else is dropped. Where no element is named as the article, text that is the same on several different pages and
lists of links are the template's, if most of their container's text changes.
"""

from __future__ import annotations

import functools
import html
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import named, spare, table, with_made, without, written

#: Streams or partial wrappers that one task aligns at once.
GROUP = 500
#: Bytes of wrappers up to which they are broadcast.
BROADCAST_BYTES = 8 << 20
#: Blocks nested more deeply than this are aligned as part of their ancestor at this depth; their text is not lost.
DEPTH = 60
#: Pairs of siblings that are compared at most to align two levels; longer ones are aligned by their labels alone.
PAIRS = 100_000
#: Different pages of a host that must have a slot before text that never changes there is the template's. Pages that
#: repeat count once.
LEAST_PAGES = 5
#: How many times the unmarked text a marked element must weigh to count as content: where it sounds like an article too,
#: or is a form, and where it does not; first without, then with an article or main element that has text outside marks.
OPENS = {"^": (1, 5), "-": (3, 10)}
#: The share of the text that a container must hold to be followed, and of link text that makes a list a menu.
MOST, LINKS = 0.75, 0.9
#: How much text that never changes weighs beside text that does.
FIXED_WEIGHT = 0.1

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
#: Attributes that say what an element is for.
_NAMES = frozenset(("class", "id", "role", "itemprop"))
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: A name such as ``with-sidebar`` says what stands beside an element, not what it is.
_BESIDE = re.compile(r"\b(?:has|with|without|no|hide)[-_][\w-]+", re.I)

#: Elements without an end tag.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
_RAW = frozenset("script style textarea title noscript template iframe svg math object".split())
#: Elements that bound blocks of text.
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
#: What an opening tag ends without an end tag of its own.
_ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "body": ("head",),
}
#: Elements that an implied end does not reach across.
_WALL = frozenset("article aside body div footer form header html main nav ol section table td th ul dl blockquote".split())
#: Elements, and words in class, id or role, of what is no article whatever it holds.
_AROUND_TAGS = frozenset("nav footer aside head menu dialog button select option input label".split()) | _RAW
_AROUND_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies dialog discussion disqus footer gdpr menu nav navbar navigation replies respond sidebar".split()
)
#: Elements and words that are only marked.
_MARKED_TAGS = frozenset(("form", "fieldset"))
_MARKED_WORDS = frozenset(
    "alert banner form login masthead modal newsletter notice notices notification overlay pager pagination popup promo "
    "promotion recommended related search share sharing signup social sponsor sponsored subscribe subscription toolbar "
    "widget".split()
)
_ARTICLE_WORDS = frozenset("article articlebody content entry main post story".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks of running text, which are no container.
_CONTAINERS = frozenset(("div", "section", "main*", *(f"{x}{mark}" for x in ("div", "section", "form") for mark in "*^-")))
#: Elements of which neighbours are one repeated group, whatever they hold.
_REPEATED = frozenset(("#", "p", "li", "tr", "td", "th", "dt", "dd", "option"))
_TEXTUAL = frozenset(("#", "p", "li", "pre", "td", "dd", "dt", "blockquote", *_HEADING))


def _label(tag: str, attributes: str) -> str:
    """The element's name with a mark: ``!`` for what is no article, ``-`` for what sounds like surroundings, ``^`` for what
    sounds like both or is a form, ``~`` for a page or article header, ``*`` for a likely article."""
    words: set[str] = set()
    for name, a, b, c in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), a or b or c
        if name in _NAMES:
            words.update(w.lower() for w in _WORD.findall(_BESIDE.sub("", value)))
        elif name == "hidden" and value.lower() != "until-found" or name == "aria-hidden" and value.lower() == "true":
            words.add("dialog")
    whole = tag in ("html", "body", "article", "main")
    if tag in _AROUND_TAGS or words & _AROUND_WORDS and not whole:
        return f"{tag}!"
    if tag == "article" and words & {"comment", "comments", "related", "promo", "ad", "sponsored", "teaser"}:
        return f"{tag}!"
    if tag in _MARKED_TAGS or words & _MARKED_WORDS and not whole:
        return f"{tag}^" if tag in _MARKED_TAGS or words & _ARTICLE_WORDS else f"{tag}-"
    if tag == "header" or "header" in words:
        return f"{tag}~"
    if tag not in ("html", "body") and (tag in ("article", "main") or words & _ARTICLE_WORDS):
        return f"{tag}*"
    return tag


_remembered = functools.lru_cache(10_000)(_label)


class Node:
    """An element of a stream, or a text slot (``#``), or a group of siblings (``()``), with what it holds.

    ``items`` are pairs of a node and its quantifier: ``1``, ``?``, ``+`` or ``*``. ``lines`` are a page's texts in a slot.
    """

    __slots__ = ("label", "items", "lines", "_shape", "_below")

    def __init__(self, label: str, items: list | None = None, lines: list[int] | None = None):
        self.label, self.items, self.lines = label, items if items is not None else [], lines or []
        self._shape = self._below = None

    def shape(self) -> int:
        """Equal for nodes that differ in how often things are repeated alone."""
        if self._shape is None:
            own, last = [], None
            for x, _ in self.items:
                if x.shape() != last:
                    own.append(last := x.shape())
            self._shape = hash((self.label, *own))
        return self._shape

    def below(self) -> frozenset[str]:
        """The labels of children and grandchildren."""
        if self._below is None:
            self._below = frozenset([x.label for x, _ in self.items] + [f"{x.label}/{y.label}" for x, _ in self.items for y, _ in x.items])
        return self._below

    def plain(self) -> list:
        """For JSON."""
        return [self.label, [[x.plain(), q] for x, q in self.items]]


def node_of(plain: list) -> Node:
    """A node from its JSON form."""
    return Node(plain[0], [(node_of(x), q) for x, q in plain[1]])


def parse(source: str) -> tuple[Node, list[tuple[str, int]]]:
    """The blocks of a page that may belong to an article, and its texts: each line with its characters in links.

    What is no article, hidden elements and elements without markup give nothing; marked elements are kept with their
    marks; of a header within an article its headings count. White space inside a line is one space, character references are decoded.
    """
    root = Node("")
    stack: list[tuple] = []  # tag, node, surroundings, header, heading, article, link
    opened: Counter = Counter()
    lines: list[tuple[str, int]] = []
    pieces: list[tuple[str, bool]] = []
    node, depth, around, header, heading, article, link = root, 0, False, False, False, False, False
    at, end = 0, len(source)

    def flush() -> None:
        text = " ".join("".join(x for x, _ in pieces).split())
        if text:
            linked = sum(len(x.strip()) for x, own in pieces if own)
            node.items.append((Node("#", lines=[len(lines)]), "1"))
            lines.append((text, min(linked, len(text))))
        pieces.clear()

    def pop(to: int) -> None:
        nonlocal node, depth, around, header, heading, article, link
        while len(stack) > to:
            if pieces and stack[-1][0] in _BLOCK:
                flush()
            tag, node, depth, around, header, heading, article, link = stack.pop()
            opened[tag] -= 1

    while at < end:
        m = _TOKEN.search(source, at)
        start = m.start() if m else end
        if start > at and not around and (not header or heading):
            text = source[at:start]
            if pieces or not text.isspace():
                pieces.append((html.unescape(text), link))
        if not m:
            break
        at = m.end()
        close, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag in _BLOCK and pieces:
            flush()
        if close:
            if opened[tag]:
                k = len(stack) - 1
                while stack[k][0] != tag:
                    k -= 1
                pop(k)
            continue
        if tag in _VOID:
            continue
        if tag in _RAW:
            ends = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, at)
            at = ends.end() if ends else (end if tag in ("script", "style") else at)
            continue
        implied = _ENDS.get(tag, ("p",) if tag in _BLOCK else ())
        if any(opened[x] for x in implied):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in implied:
                    pop(k)
                    break
                if stack[k][0] in _WALL:
                    break
        name = _remembered(tag, attributes) if len(attributes) < 300 else _label(tag, attributes)
        stack.append((tag, node, depth, around, header, heading, article, link))
        opened[tag] += 1
        mark = name[-1]
        # a mark can only be weighed on a block; inline it takes the text out
        around = around or mark == "!" or mark == "-" and tag not in _BLOCK
        link, heading = link or tag == "a", heading or tag in _HEADING
        header = header or mark == "~"
        if header and not article:
            around = True
        article = article or name in ("article*", "main*")
        if tag in _BLOCK and not around and depth < DEPTH:
            inner = Node(name)
            node.items.append((inner, "1"))
            node, depth = inner, depth + 1
    pop(0)
    flush()
    return _folded(root), lines


def _folded(node: Node) -> Node:
    """The node with its levels folded, from the inside out; blocks without text are left out."""
    items = [(x if x.label == "#" else _folded(x), q) for x, q in node.items]
    return Node(node.label, _fold([(x, q) for x, q in items if x.label == "#" or x.items]))


# ---- alignment ----


def _optional(q: str) -> str:
    return {"1": "?", "+": "*"}.get(q, q)


def _both(a: str, b: str) -> str:
    return a if a == b else ("*" if "*" in (a, b) or "+" in (a, b) and "?" in (a, b) else "+" if "+" in (a, b) else "?")


def _merged(nodes: list[Node]) -> Node:
    """Nodes of one label as one, two by two, so that long runs are not copied again and again."""
    while len(nodes) > 1:
        nodes = [merge(*nodes[k : k + 2]) if k + 1 < len(nodes) else nodes[k] for k in range(0, len(nodes), 2)]
    return nodes[0]


def _kind(node: Node) -> int | str:
    """What neighbours must share to be one repeated group: the label of list items and the like, else the shape."""
    return node.label if node.label in _REPEATED else node.shape()


def _fold(items: list[tuple[Node, str]]) -> list[tuple[Node, str]]:
    """Siblings of one kind that follow one another become one repeated child; so do groups of two to four.

    Containers that hold a line of text each stay apart: what they have in common says nothing.
    """
    out: list[tuple[Node, str]] = []
    i = 0
    while i < len(items):
        node, j = items[i][0], i + 1
        if not (node.label in _CONTAINERS and node.below() == {"#"}):
            while j < len(items) and items[j][0].label == node.label and _kind(items[j][0]) == _kind(node):
                j += 1
        if j > i + 1:
            some = any(_optional(q) != q for _, q in items[i:j])
            out.append((_merged([x for x, _ in items[i:j]]), "+" if some else "*"))
        else:
            out.append(items[i])
        i = j
    for size in (2, 3, 4):
        i = 0
        while i + 2 * size <= len(out):
            if any(x.label in _CONTAINERS or x.label == "()" for x, _ in out[i : i + size]):
                i += 1
                continue
            kinds, j = [_kind(x) for x, _ in out[i : i + size]], i + size
            while [_kind(x) for x, _ in out[j : j + size]] == kinds:
                j += size
            if j > i + size:
                own = [out[i + k : j : size] for k in range(size)]
                quantifiers = [functools.reduce(_both, (q for _, q in x)) for x in own]
                group = Node("()", [(_merged([y for y, _ in x]), q) for x, q in zip(own, quantifiers, strict=True)])
                out[i:j] = [(group, "+")]
            i += 1
    return out


def _grouped(items: list[tuple[Node, str]], other: list[tuple[Node, str]]) -> list[tuple[Node, str]]:
    """``items`` with siblings that stand for one of ``other``'s groups taken together as that group."""
    for names in dict.fromkeys(tuple(y.label for y, _ in x.items) for x, _ in other if x.label == "()"):
        out, i = [], 0
        while i < len(items):
            if tuple(x.label for x, _ in items[i : i + len(names)]) == names:
                out.append((Node("()", items[i : i + len(names)]), "1"))
                i += len(names)
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


def _likeness(a: Node, b: Node) -> float:
    if a.label != b.label:
        return 0.0
    if a.label == "#":
        return 1.0
    x, y = a.below(), b.below()
    return (1 + len(x & y)) / (1 + len(x | y))


def pairs(left: list[tuple[Node, str]], right: list[tuple[Node, str]]) -> Iterator[tuple]:
    """Both levels in order, like with like: ``(item, item)``, or None on the side that lacks it."""
    a, b = [x for x, _ in left], [y for y, _ in right]
    if len(a) == len(b) and all(x.label == y.label and x.below() == y.below() for x, y in zip(a, b, strict=True)):
        yield from zip(left, right, strict=True)
        return
    if len(a) * len(b) > PAIRS:
        for kind, i, j, k, n in SequenceMatcher(None, [x.label for x in a], [y.label for y in b], autojunk=False).get_opcodes():
            if kind == "equal":
                yield from zip(left[i:j], right[k:n], strict=True)
            else:
                yield from ((x, None) for x in left[i:j])
                yield from ((None, y) for y in right[k:n])
        return
    best = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    same = [[_likeness(x, y) for y in b] for x in a]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1], same[i][j] and best[i + 1][j + 1] + same[i][j])
    i = j = 0
    while i < len(a) and j < len(b):
        if same[i][j] and best[i][j] == best[i + 1][j + 1] + same[i][j]:
            yield left[i], right[j]
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            yield left[i], None
            i += 1
        else:
            yield None, right[j]
            j += 1
    yield from ((x, None) for x in left[i:])
    yield from ((None, y) for y in right[j:])


def merge(a: Node, b: Node) -> Node:
    """The wrapper that covers two nodes with one label."""
    if a.label == "#":
        return Node("#", lines=a.lines + b.lines)
    out = []
    for x, y in pairs(_grouped(a.items, b.items), _grouped(b.items, a.items)):
        if x is None or y is None:
            node, q = x or y
            out.append((node, _optional(q)))
        else:
            out.append((merge(x[0], y[0]), _both(x[1], y[1])))
    return Node(a.label, _fold(out))


def expression(node: Node) -> str:
    """A wrapper as a regular expression over tags, for people to read."""
    if node.label == "#":
        return "TEXT"
    inner = " ".join(f"({expression(x)}){q}" if q != "1" else expression(x) for x, q in node.items)
    return inner if node.label in ("", "()") else f"<{node.label}> {inner} </{node.label}>"


def numbered(wrapper: Node) -> dict[int, int]:
    """The wrapper's text slots, numbered in order: ``id(node) -> number``."""
    found: dict[int, int] = {}
    stack = [wrapper]
    while stack:
        node = stack.pop()
        if node.label == "#":
            found[id(node)] = len(found)
        stack.extend(x for x, _ in reversed(node.items))
    return found


def matched(page: Node, wrapper: Node) -> dict[int, int]:
    """A page held against its host's wrapper: the slot of each of the page's texts, ``id(node) -> number``.

    A text that the wrapper has no place for is left out.
    """
    numbers, found, stack = numbered(wrapper), {}, [(page, wrapper)]
    while stack:
        a, b = stack.pop()
        for x, y in pairs(_grouped(a.items, b.items), _grouped(b.items, a.items)):
            if x is not None and y is not None:
                if x[0].label == "#":
                    found[id(x[0])] = numbers[id(y[0])]
                else:
                    stack.append((x[0], y[0]))
    return found


# ---- slots ----


#: What is known of a slot over all pages of a host: pages, characters, those in links, whether it always holds the same
#: text, and how many different pages have it (counted to ``LEAST_PAGES``).
Slot = tuple[int, int, int, bool, int]


def _is_marked(node: Node) -> bool:
    return node.label[-1:] in OPENS


def _opened(page: Node, weight: Callable[[Node], float]) -> set[int]:
    """The marked elements that count as content, as ``id``s.

    The heaviest is opened as long as it weighs enough beside all text outside marks, or there is no such text. What is
    inside it and not marked again is then outside marks itself.
    """
    opened: set[int] = set()
    while True:
        free, named_, marked, stack = 0.0, 0.0, [], [(page, False)]
        while stack:
            node, article = stack.pop()
            if _is_marked(node) and id(node) not in opened:
                marked.append(node)
                continue
            article = article or node.label in ("article*", "main*")
            if node.label == "#":
                free += weight(node)
                named_ += weight(node) * article
            stack.extend((x, article) for x, _ in node.items)
        best, most = None, 0.0
        for node in marked:
            own = sum(weight(x) for x in leaves(node))
            if own > most and own > OPENS[node.label[-1]][named_ > 0] * free:
                best, most = node, own
        if best is None:
            return opened
        opened.add(id(best))


def article_texts(page: Node, slot_of: dict[int, int], slots: dict[int, Slot]) -> set[int]:
    """The texts of a page's article, as ``id``s of its nodes.

    A slot weighs as much as a page has in it on average, outside links, and little where the text never changes. Marked
    elements that are not opened count nothing. From the root the child that holds most of the weight is followed, up to
    an ``article``, or to a block with a heading of its own that changes from page to page. If articles further inside
    hold most of the weight, they are the article. An element that is named as an article gives all its texts. Of any
    other the texts that are the same on ``LEAST_PAGES`` different pages or more, but for headings, and lists of links
    are left out, if the texts that change outweigh them.
    """
    weights: dict[int, float] = {}
    dull: set[int] = set()

    def of(node: Node) -> Slot:
        return slots.get(slot_of.get(id(node), -1), (0, 0, 0, False, 0))

    def fixed(node: Node) -> bool:
        own = of(node)
        return own[3] and own[4] >= LEAST_PAGES

    def text_in(node: Node) -> float:
        pages, chars, linked, _, _ = of(node)
        return (chars - linked) / max(pages, 1)

    opened = _opened(page, text_in)

    def inside_of(node: Node) -> list[Node]:
        return [x for x, _ in node.items if not _is_marked(x) or id(x) in opened]

    def weigh(node: Node, listed: bool, headed: bool) -> float:
        total = 0.0
        if node.label == "#":
            _, chars, linked, _, seen = of(node)
            total = text_in(node) * (FIXED_WEIGHT if fixed(node) else 1.0)
            if fixed(node) and not headed or seen >= LEAST_PAGES and listed and linked >= LINKS * chars:
                dull.add(id(node))
        for x in inside_of(node):
            total += weigh(x, listed or x.label.rstrip("*") in ("ul", "ol", "menu", "dl"), headed or x.label.rstrip("*") in _HEADING)
        weights[id(node)] = total
        return total

    def spread(node: Node) -> list[Node]:
        """Its children, those of groups included."""
        return [y for x in inside_of(node) for y in (spread(x) if x.label == "()" else [x])]

    def changes(node: Node) -> bool:
        return any(not fixed(x) for x in spread(node) if x.label == "#")

    weigh(page, False, False)
    at, headed = page, False
    while at.label != "article*":
        own = spread(at)
        headed = any(x.label.rstrip("*") in _HEADING and changes(x) for x in own)
        if headed:
            break
        best = max(own, key=lambda x: weights[id(x)], default=None)
        if best is None or best.label.rstrip("*") in _TEXTUAL or weights[id(best)] < MOST * weights[id(at)] or not weights[id(at)]:
            break
        at = best
    inside, stack = [], [at]
    while stack:  # the outermost articles
        node = stack.pop()
        if node.label == "article*":
            inside.append(node)
        else:
            stack.extend(inside_of(node))
    if not inside or sum(weights[id(x)] for x in inside) <= 0.5 * weights[id(at)]:
        inside = [at] if headed or at.label[-1:] == "*" else _marked(at, weights, inside_of)
    found = set()
    for top in inside:
        texts, stack = [], [top]
        while stack:
            node = stack.pop()
            if node.label == "#":
                texts.append(node)
            stack.extend(inside_of(node))
        # a named article, or one that is mostly the same on all pages, loses nothing
        named_ = top.label[-1:] == "*" or id(top) in opened and top.label[-1:] == "^"
        same = sum(text_in(x) for x in texts if fixed(x))
        drop = not named_ and 2 * same < sum(text_in(x) for x in texts)
        found.update(id(x) for x in texts if not drop or id(x) not in dull)
    return found


def _marked(at: Node, weights: dict[int, float], inside_of: Callable[[Node], list[Node]]) -> list[Node]:
    """Where no article stands out: the outermost containers with a telling name, if they hold most of the text."""
    inside, stack = [], inside_of(at)
    while stack:
        node = stack.pop()
        if node.label[-1:] == "*":
            inside.append(node)
        else:
            stack.extend(inside_of(node))
    best = max(inside, key=lambda x: weights[id(x)], default=None)
    return [best] if best is not None and weights[id(best)] > 0.5 * weights[id(at)] else [at]


SLOTS = "host string, slot int, pages long, chars long, linked long, low long, high long, least array<long>"
_SLOTS = ("host", "slot", "pages", "chars", "linked", "low", "high", "least")


def _trees_of(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        seen = {(h.as_py(), json.dumps(parse(p.as_py() or "")[0].plain())) for h, p in zip(batch.column("host"), batch.column("html"), strict=True)}
        columns = [[h for h, _ in seen], [w for _, w in seen]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["host", "wrapper"])


def _align(group: pa.Table) -> pa.Table:
    """One wrapper for all streams or wrappers of a group."""
    sources = sorted((w.as_py() for w in group["wrapper"]), key=lambda w: (len(w), w))
    out = node_of(json.loads(sources[0]))
    for w in sources[1:]:
        out = merge(out, node_of(json.loads(w)))
    return pa.table({"host": pa.array([group["host"][0].as_py()], pa.string()), "wrapper": pa.array([json.dumps(out.plain())], pa.string())})


def infer_wrappers(pages: DataFrame, host: str = "host", source: str = "html") -> DataFrame:
    """``(host, wrapper)``: each host's union-free expression as JSON, see ``expression``.

    The folded streams are made distinct for each host before any are aligned. They are then aligned in groups of about
    ``GROUP``, and the groups' wrappers again, until each host has one.
    """
    rows = pages.select(named(host).alias("host"), named(source).alias("html"))
    found = written(rows.mapInArrow(_trees_of, "host string, wrapper string").distinct())
    while True:
        most = found.groupBy("host").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
        if most == 1:
            return found
        if most <= GROUP:
            return written(found.groupBy("host").applyInArrow(_align, "host string, wrapper string"))
        dealt = found.withColumn("salt", F.expr(f"pmod(xxhash64(wrapper), {-(-most // GROUP)})"))
        found = written(dealt.groupBy("host", "salt").applyInArrow(_align, "host string, wrapper string").distinct())


class _Known:
    """What a task remembers of wrappers and of pages' streams under them."""

    def __init__(self) -> None:
        self.wrappers: dict[str, Node] = {}
        self.found: dict[tuple, object] = {}

    def wrapper(self, source: str | None) -> Node:
        if source not in self.wrappers:
            if len(self.wrappers) > 200:
                self.wrappers.clear()
            self.wrappers[source] = node_of(json.loads(source)) if source else Node("")
        return self.wrappers[source]

    def of(self, key: tuple, make):
        if key not in self.found:
            if len(self.found) > 5000:
                self.found.clear()
            self.found[key] = make()
        return self.found[key]


def leaves(page: Node) -> list[Node]:
    """A stream's texts in order."""
    found, stack = [], [page]
    while stack:
        node = stack.pop()
        if node.label == "#":
            found.append(node)
        stack.extend(x for x, _ in reversed(node.items))
    return found


def _slots_of(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each host and slot of a batch of pages: pages, characters, characters in links, least and greatest hash
    of a page's text in it, and the least hashes of different pages that have it."""
    known = _Known()
    for batch in stream:
        sums: dict[tuple[str, int], list[int]] = {}
        for host, page, wrapper in zip(batch.column("host"), batch.column("html"), batch.column("wrapper"), strict=True):
            source = page.as_py() or ""
            tree, lines = parse(source)
            host, wrapper, own = host.as_py(), wrapper.as_py(), leaves(tree)
            whole = xxhash.xxh64_intdigest(source.encode("utf-8", "replace")) >> 1

            def slots(tree=tree, own=own, wrapper=wrapper) -> list[int | None]:
                met = matched(tree, known.wrapper(wrapper))
                return [met.get(id(x)) for x in own]

            texts: dict[int, list[int]] = {}
            for x, slot in zip(own, known.of((host, json.dumps(tree.plain())), slots), strict=True):
                if slot is not None:
                    texts.setdefault(slot, []).extend(x.lines)
            for slot, at in texts.items():
                h = xxhash.xxh64_intdigest("\n".join(lines[k][0] for k in at).encode("utf-8", "replace")) >> 1
                n, linked = sum(len(lines[k][0]) for k in at), sum(lines[k][1] for k in at)
                x = sums.setdefault((host, slot), [0, 0, 0, h, h, []])
                least = x[5] if whole in x[5] else sorted([*x[5], whole])[:LEAST_PAGES]
                sums[host, slot] = [x[0] + 1, x[1] + n, x[2] + linked, min(x[3], h), max(x[4], h), least]
        columns = [[h for h, _ in sums], [k for _, k in sums], *([x[i] for x in sums.values()] for i in range(6))]
        kinds = (pa.string(), pa.int32(), *[pa.int64()] * 5, pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(_SLOTS))


def extract(source: str | None, wrapper: Node, slots: dict[int, Slot]) -> str:
    """The text of one page's article, a line for each block."""
    tree, lines = parse(source or "")
    chosen = article_texts(tree, matched(tree, wrapper), slots)
    kept = sorted(k for x in leaves(tree) if id(x) in chosen for k in x.lines)
    return "\n".join(lines[k][0] for k in kept)


def slot_table(rows) -> dict[int, Slot]:
    """Slots as ``article_texts`` takes them, from rows ``(slot, pages, chars, linked, low, high, seen)``."""
    return {k: (pages, chars, linked, low == high, seen) for k, pages, chars, linked, low, high, seen in rows}


def _bounded(df: DataFrame) -> DataFrame:
    """``df``, marked for a broadcast if its texts are small enough."""
    size = df.agg(F.coalesce(F.sum(sum(F.length(c) for c in df.columns)), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def main_text(pages: DataFrame, url: str = "url", source: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``pages`` with ``text``, the article of each page, and ``n_chars``, its code points.

    Null and empty pages have the empty text. A page without a host in its URL, or without a URL, belongs to the host
    ''. Repeated rows give equal rows and count once as a page. A page of any size is taken whole, one nested however deeply too. An empty table
    stays empty; input columns with one of the two names are replaced.
    """
    base = without(pages, "text", "n_chars")
    kept = [c for c in base.columns if keep is None or c in keep]
    own_host, own_html, own_wrapper, own_slots = spare(base, "_host", "_html", "_wrapper", "_slots")
    host = F.coalesce(F.lower(F.regexp_extract(named(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    hosted = base.select(*map(named, kept), host.alias(own_host), named(source).alias(own_html))
    plain = hosted.select(named(own_host).alias("host"), named(own_html).alias("html"))
    wrappers = infer_wrappers(plain)
    seen = plain.join(_bounded(wrappers), "host")
    counted = written(seen.mapInArrow(_slots_of, SLOTS))
    sizes = counted.groupBy("host", "slot")
    sizes = sizes.agg(*[F.sum(c).alias(c) for c in ("pages", "chars", "linked")], F.min("low").alias("low"), F.max("high").alias("high"))
    # each batch gives a few of its pages, so these are enough to see that there are ``LEAST_PAGES`` of them
    different = counted.select("host", "slot", F.explode("least").alias("page")).distinct().groupBy("host", "slot").agg(F.count("*").alias("seen"))
    sizes = sizes.join(different, ["host", "slot"])
    # as many entries as the host's wrapper has slots
    slots = F.to_json(F.collect_list(F.array(F.col("slot").cast("long"), "pages", "chars", "linked", "low", "high", "seen"))).alias("slots")
    chosen = written(wrappers.join(sizes.groupBy("host").agg(slots), "host", "left").select("host", "wrapper", F.coalesce("slots", F.lit("[]")).alias("slots")))
    chosen = _bounded(chosen).select(F.col("host").alias(own_host), F.col("wrapper").alias(own_wrapper), F.col("slots").alias(own_slots))
    joined = hosted.join(chosen, own_host, "left")

    def make():
        known = _Known()

        def texts(pages: pa.Array, wrappers: pa.Array, slots: pa.Array) -> list[list[str]]:
            out = []
            for page, wrapper, own in zip(pages, wrappers, slots, strict=True):
                tree, lines = parse(page.as_py() or "")
                wrapper, own, at = wrapper.as_py(), own.as_py(), leaves(tree)

                def choose(tree=tree, wrapper=wrapper, own=own, at=at) -> list[bool]:
                    found = article_texts(tree, matched(tree, known.wrapper(wrapper)), slot_table(json.loads(own or "[]")))
                    return [id(x) in found for x in at]

                good = known.of((wrapper, own, json.dumps(tree.plain())), choose)
                kept = sorted(k for x, yes in zip(at, good, strict=True) if yes for k in x.lines)
                out.append("\n".join(lines[k][0] for k in kept))
            return [out]

        return texts

    found = with_made(joined, kept, [named(own_html), named(own_wrapper), named(own_slots)], {"text": T.StringType()}, make)
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op8_main_text(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


#: For the layout of the driver's pages: blocks of the one article element.
ORACLE = r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(regexp_replace(coalesce(html, ''), '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', '', 'g'),
         '(?is)<article[^>]*>(.*?)</article>', 1) AS body FROM pages
), b AS (
  SELECT page_id, url, list_filter(list_transform(string_split(regexp_replace(regexp_replace(body, '</?(?:p|h1|br)\b[^>]*>', chr(30), 'g'), '<[^>]*>', '', 'g'), chr(30)),
         lambda x: trim(regexp_replace(replace(replace(replace(replace(x, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g'))),
         lambda x: x <> '') AS blocks FROM a
)
SELECT page_id, url, array_to_string(blocks, chr(10)) AS text, length(array_to_string(blocks, chr(10))) AS n_chars FROM b
"""
