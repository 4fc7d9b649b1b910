"""A tree of a web page: tags, class words and text, from one pass over the markup."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>?|<[!?][^>]*>?""",
    re.S,
)
_NAMES = re.compile(r"""(?:^|[\s"'])(class|id|role|data-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_UNSEEN = re.compile(
    r"""(?:^|[\s"'])(?:hidden(?=[\s=/>]|$)|style\s*=\s*(?:"[^"]*|'[^']*|[^\s"']*)display\s*:\s*none)""", re.I
)
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])|[^A-Za-z]+")

# How elements of the markup behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
HIDDEN = RAW | frozenset("head svg object canvas select option datalist audio video map math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr img button".split()
)
_ENDS = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
_FENCES = frozenset("ul ol dl table select article section div main body td".split())
_CLOSERS = {t: re.compile(rf"</{t}\s*>?", re.I) for t in RAW}


@dataclass
class Tree:
    """Nodes in page order; a parent stands before its children.

    ``text`` holds the decoded text of a text node and None for an element; ``block``
    numbers the run of inline content that a text belongs to.
    """

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    words: list[tuple[str, ...]] = field(default_factory=list)
    label: list[str] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    block: list[int] = field(default_factory=list)

    def add(self, parent: int, tag: str, words=(), label="", text=None, block=0) -> int:
        for cells, value in zip(
            (self.parent, self.tag, self.words, self.label, self.text, self.block),
            (parent, tag, words, label, text, block),
        ):
            cells.append(value)
        return len(self.tag) - 1


def _class_words(attributes: str) -> tuple[tuple[str, ...], str]:
    words, label = [], ""
    for m in _NAMES.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() == "data-label":
            label = value
        else:
            words += [w.lower() for w in _HUMP.split(value) if w]
    return tuple(words), label


def parse(page: str) -> Tree:
    """The tree of a page; what browsers do not show is left out.

    Unclosed and stray tags are put right the way browsers do in the plain cases: a block
    ends an open paragraph, an item the item before it, an end tag all within its element.
    """
    tree = Tree()
    root = tree.add(-1, "html")
    stack, open_tags = [root], {"html": 1}
    hidden = 0  # open elements whose content is not shown
    unseen: set[int] = set()  # those of them that say so in an attribute
    block, at, end = 0, 0, len(page)

    def close(to: int) -> None:
        nonlocal hidden, block
        while len(stack) > to:
            node = stack.pop()
            tag = tree.tag[node]
            open_tags[tag] -= 1
            hidden -= tag in HIDDEN or node in unseen
            block += tag not in INLINE

    def open_body() -> None:
        """What stands outside of any element is the body's."""
        stack.append(tree.add(root, "body", block=block))
        open_tags["body"] = open_tags.get("body", 0) + 1

    def put(text: str) -> None:
        if text and not hidden:
            if len(stack) == 1 and text.strip():
                open_body()
            tree.add(stack[-1], "#text", text=html.unescape(text), block=block)

    while at < end:
        m = _MARKUP.search(page, at)
        if m is None:
            put(page[at:])
            break
        put(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue  # a comment or declaration
        tag = m[2].lower()
        if m[1]:
            if open_tags.get(tag, 0) and tag != "html":
                depth = len(stack) - 1
                while tree.tag[stack[depth]] != tag:
                    depth -= 1
                close(depth)
            elif tag == "p":
                block += 1
            continue
        if tag == "html":
            continue
        if tag in RAW:
            found = _CLOSERS[tag].search(page, at)
            at = found.end() if found else end
            continue
        if tag == "body" and open_tags.get("head", 0):
            close(next(i for i, n in enumerate(stack) if tree.tag[n] == "head"))
        inline = tag in INLINE
        if not inline:
            block += 1
            if open_tags.get("p", 0) and tag not in VOID - {"hr"} and tag not in HIDDEN:
                depth = len(stack) - 1
                while depth > 0 and tree.tag[stack[depth]] != "p" and tree.tag[stack[depth]] not in _FENCES:
                    depth -= 1
                if tree.tag[stack[depth]] == "p":
                    close(depth)
            if tag in _ENDS:
                depth = len(stack) - 1
                while depth > 0 and tree.tag[stack[depth]] not in _ENDS[tag]:
                    if tree.tag[stack[depth]] in _FENCES and not (tag == "tr" and tree.tag[stack[depth]] == "td"):
                        depth = 0
                        break
                    depth -= 1
                if depth:
                    close(depth)
        if tag in VOID:
            continue
        if len(stack) == 1 and tag not in ("head", "body"):
            open_body()
        words, label = _class_words(m[3]) if m[3] else ((), "")
        stack.append(tree.add(stack[-1], tag, words, label, block=block))
        open_tags[tag] = open_tags.get(tag, 0) + 1
        if m[3] and _UNSEEN.search(m[3]):
            unseen.add(stack[-1])
        hidden += tag in HIDDEN or stack[-1] in unseen
        if m[3] and m[3].rstrip().endswith("/") and tag in ("svg", "path"):
            close(len(stack) - 1)
    return tree


def shown(tree: Tree, keep) -> str:
    """The kept text nodes: blocks with single blanks, joined in page order by one."""
    blocks: dict[int, list[str]] = {}
    for i, text in enumerate(tree.text):
        if text is not None and keep[i]:
            blocks.setdefault(tree.block[i], []).append(text)
    return " ".join(t for t in (" ".join("".join(b).split()) for b in blocks.values()) if t)
