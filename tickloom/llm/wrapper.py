"""Wrapper induction: the main text of pages, from what the pages of a host have in common.

Every page of a host is evidence. Its tree of block elements is aligned by simple tree matching with the trees of the
host's other pages, which merge into a template (templates.py): each distinct shape is merged once, by tasks that hold one
template each - a host's shapes are split, partial templates are merged like shapes. Each page is aligned with the
template; for each slot and each text there, the distinct pages that have it are counted (exact copies count once). Text
on many of the pages with its slot is constant: template; other text, and elements that align with nothing, are varying.
Prose needs more pages to be constant than other elements. The content is the lowest element that holds all varying
text - a landmark (article, main) if the page has one -, without what tags and class names show to be menus, headers,
footers, sidebars, notices, adverts, forms or comments. Names yield to the text: an element named so is opened if the
page's only landmark is within and holds more than what is outside, or if (menus, footers and asides excepted) it holds
nearly all varying text and no varying prose stands outside. Paragraphs within the content stay even if they are equal;
other constant leaves there, and containers with nothing but constant text, go as template.

Pages without a host, or alone on theirs, and pages whose text is all constant go by tags and text alone. Null and empty
html give an empty text, an empty table no rows. A host's template and constant texts are joined to its pages: broadcast
if they were counted small, else shuffled (a hot host's pages can be split, its row is one; it grows with the variety of
its pages, not with their number). Extra columns are left out; repeated rows give equal results.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Container, Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, maybe_broadcast, stored, table
from .dom import INLINE, RAW, Node, matched, parsed
from .templates import Template, merged, shape_of, text_of

#: Characters of templates and constant texts of all hosts (16 each) up to which they are broadcast; tasks that a host's shapes are merged in first.
MOST_BYTES, SALTS = 64 << 20, 32
# Elements and class words that are no content, wherever they stand; elements of prose.
ASIDE = frozenset("nav footer aside form button select dialog head menu fieldset".split())
WORDS = frozenset(
    "ad ads adv advert advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disqus footer gdpr header login masthead menu modal nav navbar "
    "navigation newsletter notice notification pagination pager popup promo promoted promotion related replies reply search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar topbar widget".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figcaption caption summary".split())
#: Words of class names after which the next one tells what the element has or lacks, not what it is; elements that varying text doesn't open.
MODIFIERS, CLOSED = frozenset("with without has have no".split()), frozenset("nav footer aside menu select button".split())
SPLIT = re.compile(r"[^a-z]+|(?<=[a-z])(?=[A-Z])")


def is_hidden(node: Node) -> bool:
    return node.tag in RAW or node.tag == "head" or "hidden" in node.attrs or node.attrs.get("aria-hidden") == "true"


def is_aside(node: Node, in_content: bool) -> bool:
    """Whether tag, role, class or id show that the subtree is no main text. A header within an article is the article's own."""
    if is_hidden(node) or node.tag in ASIDE or node.attrs.get("role", "").lower() in ROLES:
        return True
    if node.tag == "header":
        return not in_content
    if node.tag in ("html", "body", "article", "main", "#root"):
        return False
    for name in (node.attrs.get("class", "") + " " + node.attrs.get("id", "")).split():
        words = [w.lower() for w in SPLIT.split(name)]
        if any(w in WORDS and (i == 0 or words[i - 1] not in MODIFIERS) for i, w in enumerate(words)):
            return True
    return False


def is_landmark(node: Node) -> bool:
    return node.tag in ("article", "main") or node.attrs.get("role", "").lower() in ("main", "article") or node.attrs.get("itemprop") == "articleBody"


def _walk(root: Node, opened: Container[int] = ()) -> Iterator[tuple[Node, bool]]:
    """Block nodes that aren't beside the content, in page order; whether a landmark holds them."""
    stack = [(root, False)]
    while stack:
        node, inside = stack.pop()
        if is_aside(node, inside) and id(node) not in opened:
            continue
        inside = inside or is_landmark(node)
        yield node, inside
        stack += [(c, inside) for c in reversed(node.elements())]


def opened_by_text(root: Node, constant: Container[int]) -> set[int]:
    """Elements that names put beside the content although they hold the only landmark or the main varying text."""
    nodes: list[tuple[Node, int, bool]] = []  # with the parent's place and whether names put it aside
    stack = [(root, -1, False)]
    while stack:
        node, parent, inside = stack.pop()
        if is_hidden(node):
            continue
        nodes.append((node, parent, is_aside(node, inside)))
        stack += [(c, len(nodes) - 1, inside or is_landmark(node)) for c in reversed(node.elements())]
    every, free, prose = ([0] * len(nodes) for _ in range(3))  # varying text below, not below asides, and thereof prose
    below: list[list[int]] = [[] for _ in nodes]
    for i in range(len(nodes) - 1, -1, -1):
        node, parent, aside = nodes[i]
        size = 0 if id(node) in constant else len(node.own())
        every[i] += size
        free[i] += size
        prose[i] += size if node.tag in PROSE else 0
        if parent >= 0:
            below[parent].append(i)
            every[parent] += every[i]
            if not aside:
                free[parent] += free[i]
                prose[parent] += prose[i]

    def reached(start: int, wanted) -> list[int]:
        """Outermost nodes below start that are wanted, not below asides."""
        out, stack = [], below[start][:]
        while stack:
            i = stack.pop()
            if wanted(i):
                out.append(i)
            elif not nodes[i][2]:
                stack += below[i]
        return out

    opened: set[int] = set()
    marks = reached(0, lambda i: is_landmark(nodes[i][0]) and not nodes[i][2])
    if not marks:
        held = max((i for i in range(len(nodes)) if is_landmark(nodes[i][0])), key=every.__getitem__, default=0)
        if held and every[held] > free[0]:
            marks, i = [held], held
            while i >= 0:
                if nodes[i][2]:
                    opened.add(id(nodes[i][0]))
                i = nodes[i][1]
    for scope in marks or [0]:
        while 10 * free[scope] < every[scope] and not prose[scope]:
            asides = [i for i in reached(scope, lambda i: nodes[i][2]) if nodes[i][0].tag not in CLOSED and nodes[i][0].attrs.get("role", "").lower() not in ROLES - {"form"}]
            heaviest = max(asides, key=every.__getitem__, default=scope)
            if heaviest == scope or 2 * every[heaviest] <= every[scope]:
                break
            opened.add(id(nodes[heaviest][0]))
            scope = heaviest
    return opened


def blocks(root: Node, dropped: set[int], in_content: bool, opened: Container[int] = ()) -> list[str]:
    """Texts of the blocks below root: runs of text and inline elements between block boundaries."""
    out: list[str] = []
    run: list[str] = []

    def close() -> None:
        text = " ".join("".join(run).split())
        if text:
            out.append(text)
        run.clear()

    stack: list = [(root, in_content)]
    while stack:
        item = stack.pop()
        if item is None:
            close()
            continue
        node, inside = item
        if isinstance(node, str):
            run.append(node)
            continue
        if node is not root and (id(node) in dropped or (is_aside(node, inside) and id(node) not in opened and not (node.tag in INLINE and node.elements()))):
            if node.tag not in INLINE:
                close()
            continue
        inside = inside or is_landmark(node)
        if node.tag == "br":
            run.append(" ")
        if node.tag in INLINE:
            stack += [(c, inside) for c in reversed(node.children)]
        else:
            close()
            stack.append(None)
            stack += [(c, inside) for c in reversed(node.children)]
    close()
    return out


def text_hash(node: Node) -> int:
    """A signed 64-bit hash of the element's own text."""
    h = xxhash.xxh3_64_intdigest(node.own().encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def _below(root: Node) -> Iterator[Node]:
    stack = root.elements()[::-1]
    while stack:
        node = stack.pop()
        yield node
        stack += reversed(node.elements())


def constant_levels(n, of):
    """Whether a text on n of the pages with its slot is constant if it is no prose, and even if it is prose."""
    strong = (n >= 3) & (2 * n >= of)
    return strong | ((n >= 3) & (10 * n >= of)) | ((n >= 2) & (2 * n > of)), strong


def main_text(html: str | None, references: Iterable[Node] = (), template: Template | None = None, weak: Container = (), strong: Container = ()) -> str:
    """template: the host's, with the pairs (slot, hash of text) that are constant there: weak, and strong - constant even as prose.
    Else references, trees of other pages, are aligned with the page and counted."""
    if not html:
        return ""
    root = parsed(html)
    constant: set[int] = set()
    if template is not None:
        slots = template.of(root)
        for node in [root, *_below(root)]:
            if id(node) in slots and node.own():
                key = slots[id(node)], text_hash(node)
                if key in strong or (key in weak and node.tag not in PROSE):
                    constant.add(id(node))
    else:
        n: Counter = Counter()
        of: Counter = Counter()
        for other in references:
            for p, q in matched(root, other):
                of[id(p)] += 1
                n[id(p)] += p.own() == q.own()
        for node in [root, *_below(root)]:
            levels = constant_levels(n[id(node)] + 1, of[id(node)] + 1)
            if node.own() and levels[node.tag in PROSE]:
                constant.add(id(node))
    opened = opened_by_text(root, constant)
    own = {id(n): (n, n.own()) for n, _ in _walk(root, opened)}
    if constant and all(i in constant for i, (_, text) in own.items() if text):  # nothing varies: the evidence tells nothing
        constant = set()
        opened = opened_by_text(root, constant)
        own = {id(n): (n, n.own()) for n, _ in _walk(root, opened)}
    constant &= own.keys()
    weight: dict[int, int] = {}
    texts: dict[int, int] = {}
    for node, _ in reversed(list(_walk(root, opened))):
        below = [id(c) for c in node.elements() if id(c) in weight]
        size = len(own[id(node)][1])
        weight[id(node)] = (0 if id(node) in constant else size) + sum(weight[c] for c in below)
        texts[id(node)] = size + sum(texts[c] for c in below)
    every = weight[id(root)]
    marks = [n for n, _ in _walk(root, opened) if is_landmark(n)]
    if marks:
        content = max(marks, key=lambda n: weight[id(n)])
        if weight[id(content)] == 0:
            content = max(marks, key=lambda n: texts[id(n)])
    else:
        content = root
        while every:
            holds = [c for c in content.elements() if weight.get(id(c), 0) == every and c.tag not in PROSE]
            if not holds:
                break
            content = holds[0]
    dropped: set[int] = set()
    if weight[id(content)]:
        leaves = {i for i in constant if own[i][0].tag not in PROSE and own[i][1] and not own[i][0].elements()}
        whole = {i for i in own if own[i][0].tag not in PROSE and texts[i] and not weight[i]}
        dropped = leaves | whole
    return "\n".join(blocks(content, dropped - {id(content)}, bool(marks), opened))


def page_shapes(rows: DataFrame) -> DataFrame:
    """For each distinct page of rows (site, html): page (its hash), shape (a hash), lines (the shape, at least once for each site and shape), and of
    the elements with text the places in the shape and the texts' hashes."""

    def run(it):
        told: set[tuple[int, int]] = set()
        for b in it:
            out: list[tuple] = []
            for site, html in zip(*(b.column(c).to_pylist() for c in ("site", "html")), strict=True):
                root = parsed(html)
                lines, at = shape_of(root)
                lines = lines.encode("utf-8", "replace").decode()
                shape, page = (xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) - (1 << 63) for x in (lines, html))
                own = [x for x in [root, *_below(root)] if id(x) in at and x.own()]
                out.append((site, page, shape, None if (site, shape) in told else lines, [at[id(x)] for x in own], list(map(text_hash, own))))
                if len(told) > 100_000:
                    told.clear()
                told.add((site, shape))
            cols = zip(*out, strict=True) if out else [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["site", "page", "shape", "lines", "places", "texts"])

    return rows.mapInArrow(run, "site long, page long, shape long, lines string, places array<int>, texts array<long>")


def host_templates(shapes: DataFrame, salts: int = SALTS) -> DataFrame:
    """site and lines, the template of its shapes (site, shape, lines, n), the most frequent first. A task holds one template at a time."""

    def run(it):
        site = salt = into = None
        for b in it:
            made = []
            for s, t, lines in zip(*(b.column(c).to_pylist() for c in ("site", "salt", "lines")), strict=True):
                if (s, t) != (site, salt):
                    made += [(site, salt, text_of(into))] if into else []
                    site, salt, into = s, t, None
                into = merged([lines], into)
            yield batch(made)
        yield batch([(site, salt, text_of(into))] if into else [])

    def batch(made: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*made, strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], ["site", "salt", "lines"])

    parts = int(shapes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = "site long, salt long, lines string"
    first = shapes.withColumn("salt", F.pmod("shape", F.lit(salts))).repartition(parts, "site", "salt").sortWithinPartitions("site", "salt", F.desc("n"), "shape")
    partial = first.select("site", "salt", "lines").mapInArrow(run, kind).repartition(parts, "site").sortWithinPartitions("site", "salt")
    return partial.select("site", F.lit(0).cast("long").alias("salt"), "lines").mapInArrow(run, kind).select("site", "lines")


def host_wrappers(rows: DataFrame) -> DataFrame:
    """For each site of rows (site, html): lines (its template), and its constant texts as (slot, text): weak, and strong (constant even as prose)."""

    def align(it):
        known: dict[int, Template] = {}
        for b in it:
            slots = []
            for site, shape, lines in zip(*(b.column(c).to_pylist() for c in ("site", "shape_lines", "lines")), strict=True):
                if site not in known:
                    if len(known) > 64:
                        known.clear()
                    known[site] = Template(lines)
                slots.append(known[site].align(shape))
            yield pa.RecordBatch.from_arrays([b.column("site"), b.column("shape"), pa.array(slots, pa.list_(pa.int32()))], ["site", "shape", "slots"])

    seen = stored(page_shapes(rows), "seen")
    shapes = stored(seen.groupBy("site", "shape").agg(F.max("lines").alias("lines"), F.count("*").alias("n")), "shapes")
    templates = stored(host_templates(shapes), "templates")
    size = templates.agg(F.coalesce(F.sum(F.length("lines")), F.lit(0))).first()[0]
    both = shapes.select("site", "shape", F.col("lines").alias("shape_lines")).join(maybe_broadcast(templates, size, MOST_BYTES), "site")
    aligned = stored(both.mapInArrow(align, "site long, shape long, slots array<int>"), "aligned")
    few = maybe_broadcast(aligned, aligned.agg(F.coalesce(F.sum(F.size("slots")), F.lit(0))).first()[0], MOST_BYTES // 8)
    pages = seen.select("site", "page", "shape", "places", "texts").dropDuplicates(["site", "page"]).join(few, ["site", "shape"])
    pages = stored(pages.select("site", F.expr("array_distinct(transform(places, (p, i) -> struct(slots[p] AS slot, texts[i] AS text)))").alias("own")), "pages")
    counts = pages.select("site", F.inline("own")).where("slot >= 0").groupBy("site", "slot", "text").agg(F.count("*").alias("n")).where("n >= 2")
    of = pages.select("site", F.explode(F.array_distinct("own.slot")).alias("slot")).groupBy("site", "slot").agg(F.count("*").alias("of"))
    weak, strong = constant_levels(F.col("n"), F.col("of"))
    key = F.struct("slot", "text")
    found = counts.join(of, ["site", "slot"]).where(weak).groupBy("site").agg(F.collect_list(key).alias("weak"), F.collect_list(F.when(strong, key)).alias("strong"))
    return templates.join(found, "site")


def extract(pages: DataFrame, most: int = MOST_BYTES) -> DataFrame:
    """page_id, url, text and n_chars of pages (page_id, url, html)."""
    spark = pages.sparkSession
    bound_batches(spark)
    host = F.lower(F.try_parse_url("url", F.lit("HOST")))
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), F.when(host.isNotNull(), F.xxhash64(host)).alias("site"))
    sites = stored(host_wrappers(rows.where("site IS NOT NULL AND html <> ''").select("site", "html")).withColumnRenamed("site", "of"), "sites")
    size = sites.agg(F.coalesce(F.sum(F.length("lines") + 16 * (F.size("weak") + F.size("strong"))), F.lit(0))).first()[0]
    rows = rows.join(maybe_broadcast(sites, size, most), F.col("site") == F.col("of"), "left").select("page_id", "url", "html", "site", "lines", "weak", "strong")
    known: dict[int, tuple[Template, frozenset, frozenset]] = {}

    def run(it):
        for b in it:
            texts = []
            for i, (html, site) in enumerate(zip(b.column("html").to_pylist(), b.column("site").to_pylist(), strict=True)):
                own: tuple = (None, (), ())
                if site is not None and b.column("lines")[i].is_valid:
                    if site not in known:
                        if len(known) > 64:
                            known.clear()
                        known[site] = (Template(b.column("lines")[i].as_py()), *(frozenset((k["slot"], k["text"]) for k in b.column(c)[i].as_py()) for c in ("weak", "strong")))
                    own = known[site]
                texts.append(main_text(html, (), *own))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, f"page_id {dict(pages.dtypes)['page_id']}, url string, text string, n_chars long")


def op7_wrapper(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
