"""Web pages as small trees of blocks, and the alignment of such trees.

A tree has the elements that make blocks; elements inside a line of text only
pass their text on. Neighbours of one label are one node, so that a list of any
length has one shape.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from math import isqrt

import numpy as np
import xxhash

#: Elements of HTML that make blocks, that have no content, and whose content is not markup.
BLOCKS = frozenset(
    "html body article section main div p ul ol li dl dt dd h1 h2 h3 h4 h5 h6 blockquote pre table thead tbody tfoot tr "
    "caption figure figcaption header footer nav aside form fieldset address hgroup details summary menu dialog search "
    "center hr option select datalist optgroup legend".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp plaintext".split())
#: Passed over with all they hold, if they are closed.
SKIPPED = frozenset("noscript template svg math object button audio video canvas map".split())
#: Words of class, id and role names that tell furniture and main parts.
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo promoted promotion "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidebars aside widget widgets complementary related "
    "recommended recommendations share sharing social cookie cookies consent gdpr notice notices notification alert popup "
    "modal overlay dialog newsletter subscribe subscription signup login comment comments commentary reply replies disqus "
    "discussion respond footer header masthead contentinfo toolbar pagination pager copyright disclaimer legal search skip "
    "tags hidden".split()
)
MAIN_WORDS = frozenset("article content main post entry story text body".split())
#: Elements that end an open paragraph, and those that end an open one of their own kind.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"},
          "thead": {"thead", "tbody", "tfoot", "tr"}, "tbody": {"thead", "tbody", "tfoot", "tr"}, "tfoot": {"thead", "tbody", "tr"}}
KEEPS_OPEN = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "option": {"select", "datalist"},
              "thead": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}

MARKUP = re.compile(
    r"<!--(?:>|->|(?s:.*?)(?:--!?>|\Z))"
    r"|<(?P<name>/?[A-Za-z][^\s/>\x00]*)(?P<attributes>(?:[^>\"'=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|=|[\"'])*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)"
)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
WANTED = ("class", "id", "role", "hidden", "aria-hidden", "style", "itemprop")
ENDS = {name: re.compile(f"</{name}(?=[\\s/>]|\\Z)[^>]*>?", re.I | re.A) for name in RAW | SKIPPED}
#: Parts of names that say what an element is for, lower and camel case alike.
TELLING = FURNITURE_WORDS | MAIN_WORDS
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass(slots=True)
class Node:
    """An element: its label, its children (elements, and texts as lists of (text, inside a link))."""

    label: str
    children: list = field(default_factory=list)


def label_of(name: str, attributes: str) -> str:
    """The element's name, with words of its names in brackets, and ``!`` if it is not shown.

    Ids are often a page's own: only words that tell something are taken from them.
    """
    if not attributes or attributes.isspace():
        return name
    found = {}
    for key, *values in ATTRIBUTE.findall(attributes):
        if (key := key.lower()) in WANTED:
            found.setdefault(key, next(filter(None, values), ""))
    words = dict.fromkeys(
        w.lower() for key in ("role", "itemprop", "class", "id") for w in NAME_PART.findall(unescape(found.get(key, "")))
        if key != "id" or w.lower() in TELLING
    )
    style = found.get("style", "").replace(" ", "").lower()
    gone = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in style
    return f"{name}[{' '.join(words)}]{'!' * gone}" if words or gone else name


def parsed(html: str) -> Node:
    """The tree of a page, whole or broken off; markup that is not closed or not opened is passed over."""
    root = Node("page")
    stack, link, text = [root], 0, []
    names, opened, open_ended = [""], Counter(), set()

    def add(piece: str) -> None:
        if piece:
            text.append((piece, link > 0))

    def flush() -> None:
        if text:
            stack[-1].children.append(list(text))
            text.clear()

    def close(above: int) -> None:
        """Ends the open elements from this place in the stack on."""
        opened.subtract(names[above:])
        del names[above:], stack[above:]

    def nearest(name: str) -> int:
        above = len(names) - 1
        while names[above] != name:
            above -= 1
        return above

    at = 0
    while (tag := MARKUP.search(html, at)) is not None:
        add(html[at : tag.start()])
        at = tag.end()
        name = tag["name"]
        if name is None:
            continue
        name = name.lower()
        if name[0] == "/":
            name = name[1:]
            if name == "a":
                link = max(0, link - 1)
            elif name in BLOCKS and opened[name]:
                flush()
                close(nearest(name))
                link = 0
            elif name == "p" or name == "br":
                add(" ")
            continue
        if name in ENDS:
            end = None if name in open_ended else ENDS[name].search(html, at)
            if end is not None:
                at = end.end()
            elif name in RAW:
                at = len(html)
            open_ended.update([] if end else [name])
            continue
        if name == "a":
            link = 1
        elif name not in BLOCKS:
            if name in VOID or name in ("td", "th"):
                add(" ")
        else:
            flush()
            link = 0
            if opened["p"] and name != "option":
                close(nearest("p"))
            ends, keeps = CLOSES.get(name, ()), KEEPS_OPEN.get(name, ())
            while any(opened[x] for x in ends):
                above = len(names) - 1
                while above and names[above] not in ends and names[above] not in keeps:
                    above -= 1
                if not above or names[above] in keeps:
                    break
                close(above)
            if name == "hr":
                continue
            node = Node(label_of(name, tag["attributes"]))
            stack[-1].children.append(node)
            stack.append(node)
            names.append(name)
            opened[name] += 1
    add(html[at:])
    flush()
    return root


def line(pieces: list[tuple[str, bool]]) -> str:
    """The text of a block: references decoded, white space as one space."""
    return " ".join(unescape("".join([p for p, _ in pieces])).split())


def text_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1


@dataclass(slots=True)
class Shape:
    """A node of an alignable tree: a label, its children, and the texts right in it, in page order as (place, text, link share)."""

    label: str
    children: list["Shape"] = field(default_factory=list)
    texts: list[tuple[int, str, float]] = field(default_factory=list)


def shape_of(root: Node) -> Shape:
    """The page's nodes that hold text, neighbours of one label folded into one."""
    place = 0
    shape = Shape(root.label)
    # Nodes whose children are being read, of any depth: the shape they go to, its parent if it is new there, what is left.
    open_nodes = [(shape, None, iter(root.children))]
    while open_nodes:
        into, parent, children = open_nodes[-1]
        child = next(children, None)
        if child is None:
            open_nodes.pop()
            if parent is not None and (into.texts or into.children):
                parent.children.append(into)
        elif isinstance(child, list):
            text = line(child)
            if text:
                linked = sum(len(p) for p, link in child if link)
                into.texts.append((place, text, linked / sum(len(p) for p, _ in child)))
                place += 1
        else:
            last = into.children[-1] if into.children else None
            if last is None or last.label != child.label:
                open_nodes.append((Shape(child.label), into, iter(child.children)))
            else:
                open_nodes.append((last, None, iter(child.children)))
    return shape


def preorder(node) -> Iterator:
    """A tree's nodes, each before its children."""
    stack = [node]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(reversed(node.children))


def skeleton(shape: Shape) -> str:
    """Labels and nesting, which two pages of one layout share."""
    out, stack = [], [shape]
    while stack:
        part = stack.pop()
        if isinstance(part, str):
            out.append(part)
        elif part.children:
            out += [part.label, "("]
            stack.append(")")
            for n, child in enumerate(reversed(part.children)):
                stack += [",", child] if n else [child]
        else:
            out.append(part.label)
    return "".join(out)


#: Counts of matched nodes that a matching remembers; they can be found anew.
REMEMBERED = 1_000_000


class Matching:
    """Simple tree matching of two trees of any width and depth.

    How many nodes of two subtrees match depends on their skeletons alone, which are numbered (``kind``).
    """

    def __init__(self, one, other):
        self.kind: dict[int, int] = {}
        self.nodes: dict[int, int] = {}  # of a subtree of this kind
        self.known: dict[tuple[int, int], int] = {}
        numbers: dict[tuple, int] = {}
        for root in (one, other):
            for node in reversed(list(preorder(root))):
                own = node.label, *[self.kind[id(c)] for c in node.children]
                kind = self.kind[id(node)] = numbers.setdefault(own, len(numbers))
                self.nodes[kind] = 1 + sum(self.nodes[k] for k in own[1:])

    def run(self, steps):
        """The result of a generator that asks for counts of matched nodes of two subtrees."""
        stack, value = [steps], None
        while stack:
            try:
                a, b = stack[-1].send(value)
            except StopIteration as done:
                stack.pop()
                value = done.value
                continue
            value = self.known.get((self.kind[id(a)], self.kind[id(b)]))
            if value is None:
                stack.append(self.counted(a, b))
        return value

    def counted(self, a, b):
        kinds = self.kind[id(a)], self.kind[id(b)]
        if kinds[0] == kinds[1]:
            total = self.nodes[kinds[0]]
        else:
            total = 1 + (yield from self.aligned(a.children, b.children, False))
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        self.known[kinds] = total
        return total

    def pairs(self, one, other) -> list[tuple]:
        out, stack = [], [(one, other)]
        while stack:
            a, b = stack.pop()
            if self.kind[id(a)] == self.kind[id(b)]:
                out += zip(preorder(a), preorder(b))
            else:
                out.append((a, b))
                stack.extend(reversed(self.run(self.aligned(a.children, b.children, True))))
        return out

    def aligned(self, ones: list, others: list, paired: bool):
        """The pairs of children, in order, whose subtrees have the most matched nodes in all, or how many these are."""
        if [x.label for x in ones] == [x.label for x in others] and len({x.label for x in ones}) == len(ones):
            if paired:
                return list(zip(ones, others))
            total = 0
            for a, b in zip(ones, others):
                total += yield a, b
            return total
        rows, columns = ({self.kind[id(x)]: x for x in xs} for xs in (ones, others))
        number = {k: n for n, k in enumerate(columns)}
        column = np.array([number[self.kind[id(x)]] for x in others], np.int64)
        gains = {}
        for k, a in rows.items():
            own = gains[k] = np.zeros(len(columns), np.int32)
            for n, b in enumerate(columns.values()):
                if a.label == b.label:
                    own[n] = yield a, b

        def following(best, a):
            gain = gains[self.kind[id(a)]][column]
            return np.append(0, np.maximum.accumulate(np.maximum(best[1:], np.where(gain > 0, best[:-1] + gain, 0))))

        # Some rows are kept and those between them computed again, so that lists of any length need little memory.
        step = isqrt(len(ones)) + 1
        best = np.zeros(len(others) + 1, np.int64)
        kept = [best]
        for i, a in enumerate(ones):
            best = following(best, a)
            if (i + 1) % step == 0:
                kept.append(best)
        if not paired:
            return int(best[-1])
        out, j = [], len(others)
        for first in range((len(ones) - 1) // step * step, -1, -step):
            some = [kept[first // step]]
            for a in ones[first : first + step]:
                some.append(following(some[-1], a))
            i = len(some) - 1
            while i and j:
                if some[i][j] == some[i - 1][j]:
                    i -= 1
                elif some[i][j] == some[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    out.append((ones[first + i], others[j]))
        return out[::-1]


def matched(one, other) -> tuple[int, list[tuple]]:
    """Simple tree matching of two trees whose roots have one label: (matched nodes, pairs of matched nodes).

    Matched nodes have one label and matched parents, and keep their order.
    """
    pairs = Matching(one, other).pairs(one, other)
    return len(pairs), pairs
