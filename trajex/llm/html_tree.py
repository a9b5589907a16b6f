"""From HTML text to a tree of block elements and text blocks.

A tolerant reader: tags may be unclosed, crossed or cut off at the end of the
page.  Inline elements make no nodes; their text belongs to the block around
them.  Every start or end of a block element ends the text block before it.
"""

from __future__ import annotations

import html
import re

TAG = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
#: The rest of a tag; quoted values may hold a >.
REST = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|style|data-y)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)

#: Elements of the HTML standard, by how they nest and close.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset(("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
                   "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav noscript "
                   "object ol optgroup option p pre search section select summary svg table tbody td template tfoot th thead tr ul video").split())
CLOSES_P = BLOCK - frozenset("button label option optgroup select legend tbody tfoot thead tr td th caption object svg video html head body".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Start tags that end an open element, unless one of the limits is in between.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"tbody", "thead", "tfoot", "tr"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot", "tr"}, {"table"}),
        "body": ({"head"}, {"html"})}
P_SCOPE = frozenset("table td th caption object button template html".split())
#: Elements whose text is never shown as text.
SILENT = frozenset("head noscript template svg object select option video".split())

TEXT = "#text"


class Tree:
    """Nodes in page order.  ``tag`` is TEXT for text blocks; ``end`` is the
    index after a node's last descendant; ``text`` of elements is empty;
    ``links`` counts characters inside a elements, ``inner`` inline tags."""

    __slots__ = ("tag", "parent", "end", "attributes", "text", "links", "inner", "depth")

    def __init__(self):
        self.tag, self.parent, self.end, self.attributes = ["#page"], [-1], [0], [""]
        self.text, self.links, self.inner, self.depth = [""], [0], [0], [0]

    def add(self, tag: str, parent: int, attributes: str = "", text: str = "", links: int = 0, inner: int = 0) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.end.append(0)
        self.attributes.append(attributes)
        self.text.append(text)
        self.links.append(links)
        self.inner.append(inner)
        self.depth.append(self.depth[parent] + 1)
        return len(self.tag) - 1


class Open:
    """The open elements of a page.  Block elements form a stack of (tag, node);
    the places of each tag are kept, so looking one up takes no walk.  Inline
    elements are told by the block they were opened in and end with it; those
    that ended so are dropped when their name is next looked up."""

    def __init__(self):
        self.stack = [("#page", 0)]
        self.places: dict[str, list[int]] = {}
        self.inline: dict[str, list[tuple[int, int]]] = {}
        self.loose, self.linked = [0], [0]  # inline elements and links opened in each block and still open
        self.silent = self.links = 0

    def push(self, tag: str, node: int) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, node))
        self.loose.append(0)
        self.linked.append(0)
        self.silent += tag in SILENT

    def pop(self) -> int:
        tag, node = self.stack.pop()
        self.places[tag].pop()
        self.loose.pop()
        self.links -= self.linked.pop()
        self.silent -= tag in SILENT
        return node

    def last(self, tags) -> int:
        """The place of the innermost open block of these tags; 0 if none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def within(self, tags, limits) -> int:
        """That place, if none of the limits is open inside it."""
        place = self.last(tags)
        return place if place > self.last(limits) else 0

    def start(self, name: str) -> None:
        self.inline.setdefault(name, []).append((len(self.stack) - 1, self.stack[-1][1]))
        self.loose[-1] += 1
        if name == "a":
            self.linked[-1] += 1
            self.links += 1

    def end(self, name: str) -> None:
        """Ends the inline element of this name that was opened last."""
        held = self.inline.get(name)
        while held:
            place, node = held.pop()
            if place < len(self.stack) and self.stack[place][1] == node:
                self.loose[place] -= 1
                if name == "a":
                    self.linked[place] -= 1
                    self.links -= 1
                return


def parse(page: str) -> Tree:
    tree, opened = Tree(), Open()
    run: list[str] = []
    linked = inner = 0

    def flush():
        nonlocal run, linked, inner
        if run:
            words = "".join(run).split()
            if words and not opened.silent:
                tree.add(TEXT, opened.stack[-1][1], "", " ".join(words), linked, inner)
            run = []
        linked = inner = 0

    def close(place: int):
        """Ends the open blocks from this place of the stack on."""
        flush()
        while len(opened.stack) > place:
            tree.end[opened.pop()] = len(tree.tag)

    def say(piece: str):
        nonlocal linked
        if piece:
            piece = html.unescape(piece) if "&" in piece else piece
            run.append(piece)
            if opened.links:
                linked += len(piece.strip())

    at, size = 0, len(page)
    while at < size:
        tag = TAG.search(page, at)
        if not tag:
            say(page[at:])
            break
        say(page[at:tag.start()])
        at = tag.end()
        if tag[1]:
            stop = page.find("-->", at)
            at = size if stop < 0 else stop + 3
            continue
        if tag[2]:
            stop = page.find(">", at)
            at = size if stop < 0 else stop + 1
            continue
        rest = REST.match(page, at)
        if rest:
            begin, at = at, rest.end()
        else:  # an open quote or a tag cut off
            stop = page.find(">", at)
            if stop < 0:
                break
            begin, at = at, stop + 1
        name = tag[4].lower()
        if tag[3]:
            if name in ("body", "html"):
                continue
            if name in BLOCK:
                k = opened.last((name,) if name not in HEADINGS else HEADINGS)
                if k:
                    close(k)
                else:
                    flush()
            else:
                opened.end(name)
            continue
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}(?![a-zA-Z0-9])[^>]*>?", re.I).search(page, at)
            at = stop.end() if stop else size
            continue
        if name == "br":
            run.append("\n")
            continue
        if name in BLOCK:
            if name in CLOSES_P and (k := opened.within(("p",), P_SCOPE)):
                close(k)
            if opened.stack[-1][0] in HEADINGS and name in HEADINGS and not opened.loose[-1]:
                close(len(opened.stack) - 1)
            if name in ENDS:
                while k := opened.within(*ENDS[name]):
                    close(k)
            flush()
            if name in VOID:
                continue
            kept = " ".join(f"{m[1].lower()}={m[2] or m[3] or m[4] or ''}" for m in ATTRIBUTE.finditer(page, begin, at - 1)) if at - begin > 3 else ""
            opened.push(name, tree.add(name, opened.stack[-1][1], kept))
        elif name not in VOID:
            if name == "a" and opened.links:
                opened.end(name)
            opened.start(name)
            inner += 1
    close(1)
    flush()
    tree.end[0] = len(tree.tag)
    for k, tag in enumerate(tree.tag):
        if tag == TEXT:
            tree.end[k] = k + 1
    return tree
