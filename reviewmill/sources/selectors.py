"""Selectors over parsed pages: many selectors, one walk.

Supported are tags and ``*``, ids, classes, attributes (present, ``=``, ``^=``, ``$=``, ``*=``), descendants, children
and lists. Anything else (pseudo-classes, siblings, ``~=``, ``|=``) raises UnsupportedSelector: a test that is left out would
match more, not less.

All compounds of all selectors are numbered, a compound's number following that of the one it stands under. A node has two
sets of numbers as bits: which compounds it is itself the end of, and which its ancestors are. What can be next on a node is
then two shifts: of the parent's own set for children, of the ancestors' set for descendants. So a node is tested only against compounds
that its place allows, whatever the number of selectors, and a descendant may stand under any fitting ancestor.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator


class UnsupportedSelector(ValueError):
    """A selector beyond the supported part of CSS."""


_NAME = r"[\w-]+"
_SCAN = re.compile(rf"""
    (?P<space>\s+) | (?P<child>>) | (?P<list>,)
  | (?P<tag>\*|[A-Za-z]{_NAME}|[A-Za-z]) | [#](?P<id>{_NAME}) | [.](?P<class>{_NAME})
  | \[\s*(?P<attr>{_NAME})\s*(?:(?P<op>[\^$*]?=)\s*(?:"(?P<double>[^"]*)"|'(?P<single>[^']*)'|(?P<bare>[^\]"']*?))\s*)?\]
""", re.X)
_TESTS: dict[str, Callable[[str, str], bool]] = {
    "=": str.__eq__,
    "^=": lambda have, want: want != "" and have.startswith(want),
    "$=": lambda have, want: want != "" and have.endswith(want),
    "*=": lambda have, want: want != "" and want in have,
}


class Compound:
    """What one element must be."""

    __slots__ = ("tag", "id", "classes", "attributes", "child", "empty")

    def __init__(self, child: bool = False):
        self.tag, self.id, self.classes, self.attributes, self.child, self.empty = None, None, set(), [], child, True

    def add(self, found: re.Match) -> None:
        kind = found.lastgroup if found.lastgroup in ("tag", "id", "class") else "attr"
        if kind == "tag":
            if not self.empty:
                raise UnsupportedSelector(f"a tag must come first: {found[0]}")
            self.tag = None if found["tag"] == "*" else found["tag"].lower()
        elif kind == "id":
            self.id = self.id or found["id"]
        elif kind == "class":
            self.classes.add(found["class"])
        else:
            value = next((v for v in (found["double"], found["single"], found["bare"]) if v is not None), "")
            self.attributes.append((found["attr"], _TESTS[found["op"]] if found["op"] else None, value))
        self.empty = False

    def fits(self, tag: str, attrs: dict[str, str]) -> bool:
        if self.tag and self.tag != tag or self.id is not None and attrs.get("id") != self.id:
            return False
        if self.classes and not self.classes <= set(attrs.get("class", "").split()):
            return False
        return all(name in attrs and (test is None or test(attrs[name], value)) for name, test, value in self.attributes)


def parse(selector: str) -> list[list[Compound]]:
    """The alternatives of a selector, each a chain of compounds from the outermost in."""
    chains, chain, now, at = [], [], Compound(), 0
    text = (selector or "").strip()

    def close() -> None:
        if not chain and now.empty or now.child and now.empty:
            raise UnsupportedSelector(f"an empty part: {selector!r}")
        if not now.empty:
            chain.append(now)

    while at < len(text):
        found = _SCAN.match(text, at)
        if not found:
            raise UnsupportedSelector(f"{text[at:]!r} in {selector!r}")
        at = found.end()
        if found.lastgroup == "space":
            if not now.empty:
                chain.append(now)
                now = Compound()
        elif found.lastgroup == "child":
            if not now.empty:
                chain.append(now)
            elif not chain or now.child:
                raise UnsupportedSelector(f"nothing before '>': {selector!r}")
            now = Compound(child=True)
        elif found.lastgroup == "list":
            close()
            chains.append(chain)
            chain, now = [], Compound()
        else:
            now.add(found)
    close()
    return [*chains, chain]


class Selectors:
    """Selectors compiled together."""

    def __init__(self, selectors: Iterable[str]):
        self.compounds: list[Compound] = []
        self.first = self.children = 0
        self.ends: list[int] = []  # by selector: the numbers that complete it
        self.known: dict[str, int] = {}
        for s in selectors:
            if s in self.known:
                continue
            end = 0
            for chain in parse(s):
                self.first |= 1 << len(self.compounds)
                for c in chain:
                    self.children |= c.child << len(self.compounds)
                    self.compounds.append(c)
                end |= 1 << (len(self.compounds) - 1)
            self.known[s] = len(self.ends)
            self.ends.append(end)
        self.below = ((1 << len(self.compounds)) - 1) & ~self.children & ~self.first  # what may stand under any ancestor

    def _own(self, node, parent: int, above: int) -> int:
        """Which compounds end at this node."""
        may = self.first | (parent << 1) & self.children | (above << 1) & self.below
        own = 0
        while may:
            bit = may & -may
            may ^= bit
            if self.compounds[bit.bit_length() - 1].fits(node.tag, node.attrs):
                own |= bit
        return own

    def find(self, root, without=None) -> dict[str, list]:
        """By selector, the elements under root (never root itself, which may stand above) in page order, without one subtree."""
        found: list[list] = [[] for _ in self.ends]
        top = self._own(root, 0, 0)
        todo = [(c, top, top) for c in reversed(root.children) if not isinstance(c, str)]
        while todo:
            node, parent, above = todo.pop()
            if node is without:
                continue
            own = self._own(node, parent, above)
            for k, end in enumerate(self.ends):
                if own & end:
                    found[k].append(node)
            todo.extend((c, own, above | own) for c in reversed(node.children) if not isinstance(c, str))
        return {s: found[k] for s, k in self.known.items()}


def select(root, selector: str, without=None) -> Iterator:
    """Elements under root that a selector matches, in page order."""
    yield from Selectors([selector]).find(root, without)[selector]
