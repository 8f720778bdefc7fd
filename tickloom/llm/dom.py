"""A small tolerant DOM of HTML pages, and simple tree matching of two of them."""

from __future__ import annotations

from collections import Counter
from html.parser import HTMLParser

import numpy as np

# Fixed values of HTML: elements without content, with raw text, and those whose start ends an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg math iframe object".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Cells up to which a table of children is held whole; larger ones are split.
MOST_CELLS = 1_000_000
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())


class Node:
    __slots__ = ("tag", "attrs", "children", "below", "text")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children, self.below, self.text = tag, attrs, [], None, None

    def name(self) -> tuple[str, str]:
        return self.tag, self.attrs.get("class") or ""

    def elements(self) -> list[Node]:
        """The elements that take part in matching: inline elements belong to the text, blocks within them to the node. The tree must be whole."""
        if self.below is not None:
            return self.below
        out, stack = [], self.children[::-1]
        while stack:
            c = stack.pop()
            if isinstance(c, Node):
                if c.tag in INLINE:
                    stack += c.children[::-1]
                else:
                    out.append(c)
        self.below = out
        return out

    def own(self) -> str:
        """The text of the node and its inline elements, white space as one space. The tree must be whole."""
        if self.text is not None:
            return self.text
        out: list[str] = []
        stack: list = self.children[::-1]
        while stack:
            c = stack.pop()
            if isinstance(c, str):
                out.append(c)
            elif c.tag in INLINE:
                out.append(" " if c.tag == "br" else "")
                stack += c.children[::-1]
        self.text = " ".join("".join(out).split())
        return self.text


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {})
        self.open = [self.root]
        self.tags: Counter = Counter()

    def _close(self, i: int) -> None:
        """Ends the open elements from the i-th on."""
        for n in self.open[i:]:
            self.tags[n.tag] -= 1
        del self.open[i:]

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK and self.tags["p"]:  # a block ends an open paragraph and what is open within
            i = len(self.open) - 1
            while self.open[i].tag != "p":
                i -= 1
            self._close(i)
        if tag in ("li", "dd", "dt", "tr", "td", "th", "option") and self.open[-1].tag == tag:
            self._close(-1)
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.tags[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1].tag == tag and tag in ("svg", "math", "path"):
            self._close(-1)

    def handle_endtag(self, tag):
        if not self.tags[tag]:
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                self._close(i)
                break
            if self.open[i].tag in ("article", "main", "body", "table") and tag in ("b", "i", "em", "strong", "span", "a", "p"):
                break

    def handle_data(self, data):
        if data:
            self.open[-1].children.append(data)


def parsed(html: str) -> Node:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


class Matching:
    """Weights of the largest matchings of subtrees. Subtrees of equal names throughout are one kind, and kinds are compared once."""

    def __init__(self, *roots: Node):
        self.ids: dict[tuple, int] = {}
        self.kinds: list[tuple] = []  # name and kinds of children
        self.sizes: list[int] = []
        self.of: dict[int, int] = {}
        self.known: dict[tuple[int, int], int] = {}
        for root in roots:
            self.add(root)

    def add(self, root) -> None:
        order, stack = [], [root]
        while stack:
            node = stack.pop()
            order.append((node, below := node.elements()))
            stack += below
        for node, below in reversed(order):
            kind = (node.name(), tuple(self.of[id(c)] for c in below))
            if kind not in self.ids:
                self.ids[kind] = len(self.kinds)
                self.kinds.append(kind)
                self.sizes.append(1 + sum(self.sizes[k] for k in kind[1]))
            self.of[id(node)] = self.ids[kind]

    def plain(self, p: int, q: int) -> int | None:
        """The weight if no table is needed for it."""
        if p == q:
            return self.sizes[p]
        (a, x), (b, y) = self.kinds[p], self.kinds[q]
        return 0 if a != b else 1 if not x or not y else self.known.get((p, q))

    def weigh(self, p: int, q: int) -> int:
        stack = [(p, q)]
        while stack:
            a, b = stack[-1]
            x, y = self.kinds[a][1], self.kinds[b][1]
            missing = [] if self.plain(a, b) is not None else [(c, d) for c in set(x) for d in set(y) if self.plain(c, d) is None]
            if missing:
                stack += missing
                continue
            stack.pop()
            if self.plain(a, b) is None:
                self.known[a, b] = 1 + int(self.sums(x, y)[-1])
        return self.plain(p, q)

    def sums(self, x, y, table: list | None = None) -> np.ndarray:
        """The last row of the table of x and y: the best weight of x with the first of y. All rows go to table."""
        every, at = np.unique(np.array(y, np.int64), return_inverse=True)
        row, rows = np.zeros(len(y) + 1, np.int64), {}
        for p in x:
            if p not in rows:
                if len(rows) * len(every) > MOST_CELLS:
                    rows.clear()
                rows[p] = np.array([self.weigh(p, q) for q in every.tolist()], np.int64)
            new = np.zeros_like(row)
            np.maximum.accumulate(np.maximum(row[1:], row[:-1] + rows[p][at]), out=new[1:])
            row = new
            if table is not None:
                table.append(row)
        return row

    def path(self, x: list[int], y: list[int]) -> list[tuple[int, int]]:
        """Places in x and y that a best alignment pairs, in order. Large tables are split in two at a row that a best path crosses (Hirschberg)."""
        out, stack = [], [(0, len(x), 0, len(y))]
        while stack:
            a, b, c, d = stack.pop()
            while a < b and c < d and x[a] == y[c]:  # subtrees of one kind at an end can always be paired
                out.append((a, c))
                a, c = a + 1, c + 1
            while a < b and c < d and x[b - 1] == y[d - 1]:
                b, d = b - 1, d - 1
                out.append((b, d))
            if a == b or c == d:
                continue
            if b - a > 1 and (b - a) * (d - c) > MOST_CELLS:
                mid = (a + b) // 2
                best = self.sums(x[a:mid], y[c:d]) + self.sums(x[mid:b][::-1], y[c:d][::-1])[::-1]
                cut = c + int(best.argmax())
                stack += [(a, mid, c, cut), (mid, b, cut, d)]
                continue
            table: list = [np.zeros(d - c + 1, np.int64)]
            self.sums(x[a:b], y[c:d], table)
            i, j = b - a, d - c
            while i and j:
                if table[i][j] == table[i - 1][j]:
                    i -= 1
                elif table[i][j] == table[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    out.append((a + i, c + j))
        return sorted(out)


def matched(a, b, trees: Matching | None = None) -> list[tuple]:
    """Pairs of aligned nodes of the largest simple tree matching of a and b, trees of nodes with name() and elements(); their roots
    must have the same name. trees: a matching that knows a already."""
    pairs: list[tuple] = []
    if a.name() != b.name():
        return pairs
    trees, stack = trees or Matching(a), [(a, b)]
    trees.add(b)
    while stack:
        p, q = stack.pop()
        pairs.append((p, q))
        x, y = p.elements(), q.elements()
        stack += [(x[i], y[j]) for i, j in reversed(trees.path([trees.of[id(n)] for n in x], [trees.of[id(n)] for n in y]))]
    return pairs
