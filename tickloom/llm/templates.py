"""Templates of hosts: the trees of their pages, aligned and merged by simple tree matching.

A page's shape is the tree of its block elements' names (tag and class, digits as 0), in which neighbours of one kind
stand once. A template is what shapes give when each is aligned with those before it: aligned elements fall together,
others are put in beside their neighbours. Slots are the template's nodes; neighbours of one name are one slot, as are
their equal parts, so that items of a list share theirs.
"""

from __future__ import annotations

import re
from itertools import groupby

from .dom import RAW, Matching, Node, matched

DIGITS = re.compile(r"\d+")
#: Kinds of subtrees that a template's matching keeps between pages, and shapes whose alignment it keeps.
MOST_KINDS, MOST_SHAPES = 100_000, 10_000


class Part:
    """A node of a shape or a template."""

    __slots__ = ("label", "kids")

    def __init__(self, label: str):
        self.label, self.kids = label, []

    def name(self) -> str:
        return self.label

    def elements(self) -> list[Part]:
        return self.kids


def _label(node: Node) -> str:
    return " ".join([node.tag, *DIGITS.sub("0", node.name()[1]).split()])


def shape_of(root: Node) -> tuple[str, dict[int, int]]:
    """The page's shape - a line for each node, its parent's number and its name - and the number of each block element's node by id()."""
    nodes, kids = [root], []
    for node in nodes:
        below = [c for c in node.elements() if c.tag not in RAW and c.tag != "head"]
        kids.append(range(len(nodes), len(nodes) + len(below)))
        nodes += below
    names, kinds, kind = list(map(_label, nodes)), {}, [0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        own = tuple(k for k, _ in groupby(kind[c] for c in kids[i]))
        kind[i] = kinds.setdefault((names[i], own), len(kinds))
    lines, made, at = [f"-1 {names[0]}"], [None], {}
    stack = [(0, 0)]
    while stack:
        i, number = stack.pop()
        at[id(nodes[i])] = number
        runs = [list(g) for _, g in groupby(kids[i], kind.__getitem__)]
        if made[number] is None:
            made[number] = range(len(lines), len(lines) + len(runs))
            lines += [f"{number} {names[r[0]]}" for r in runs]
            made += [None] * len(runs)
        stack += [(c, to) for run, to in zip(reversed(runs), reversed(made[number]), strict=True) for c in reversed(run)]
    return "\n".join(lines), at


def tree(text: str) -> list[Part]:
    """The nodes of a shape or template; the first is the root."""
    nodes: list[Part] = []
    for line in text.split("\n"):
        parent, _, label = line.partition(" ")
        nodes.append(Part(label))
        if int(parent) >= 0:
            nodes[int(parent)].kids.append(nodes[-1])
    return nodes


def text_of(root: Part) -> str:
    lines, stack = [], [(root, -1)]
    while stack:
        node, parent = stack.pop()
        lines.append(f"{parent} {node.label}")
        stack += [(c, len(lines) - 1) for c in reversed(node.kids)]
    return "\n".join(lines)


def merge(template: Part, shape: Part) -> None:
    """Puts into the template what the shape has besides what aligns with it; takes the shape's nodes over."""
    own = {id(s): t for t, s in matched(template, shape)}
    stack = [shape] if id(shape) in own else []
    while stack:
        node = stack.pop()
        here = own[id(node)]
        place, kids, done = {id(k): i for i, k in enumerate(here.kids)}, [], 0
        for c in node.kids:
            if id(c) in own:
                upto = place[id(own[id(c)])] + 1
                kids += here.kids[done:upto]
                done = upto
                stack.append(c)
            else:
                kids.append(c)
        here.kids = kids + here.kids[done:]


def merged(texts: list[str], into: Part | None = None) -> Part | None:
    """The template of some shapes or templates, in this order."""
    for text in texts:
        root = tree(text)[0]
        if into is None:
            into = root
        else:
            merge(into, root)
    return into


class Template:
    """A host's template, and the alignment of pages with it."""

    def __init__(self, text: str):
        self.root = tree(text)[0]
        self.slots: dict[int, int] = {}
        n, groups = 0, [[self.root]]
        for group in groups:
            runs: dict[tuple[str, int], list[Part]] = {}
            for node in group:
                self.slots[id(node)] = n
                seen: dict[str, int] = {}
                for label, run in groupby(node.kids, Part.name):
                    seen[label] = seen.get(label, 0) + 1
                    runs.setdefault((label, seen[label]), []).extend(run)
            n += 1
            groups += runs.values()
        self.known: dict[str, list[int]] = {}
        self.matching = Matching(self.root)

    def align(self, shape: str) -> list[int]:
        """The slot of each node of a shape; -1 for those that align with nothing."""
        if shape not in self.known:
            if len(self.known) >= MOST_SHAPES:
                self.known.clear()
            if len(self.matching.kinds) > MOST_KINDS:
                self.matching = Matching(self.root)
            nodes = tree(shape)
            slot = {id(s): self.slots[id(t)] for t, s in matched(self.root, nodes[0], self.matching)}
            self.known[shape] = [slot.get(id(p), -1) for p in nodes]
        return self.known[shape]

    def of(self, root: Node) -> dict[int, int]:
        """The slots of a page's block elements, by id()."""
        shape, at = shape_of(root)
        slots = self.align(shape)
        return {i: slots[n] for i, n in at.items() if slots[n] >= 0}
