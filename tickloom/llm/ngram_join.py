"""N-gram Jaccard join: documents whose sets of 4-word shingles overlap by 85 % of their union, and their components.

1. Equal sets become one class. Each set has the count vector of its shingles' hashes over GROUPS groups or more.
2. Sets that can link share one of their rarest shingles: of n shingles, the n - ceil(0.85 n) + 1 first in the order of
   corpus-wide frequency (log classes of a count sketch over all documents) share at least one with any link's. These
   shingles deal the sets out to groups; frequent lines and passages come last in their order. Groups with the same
   members are one. Groups of more than TILE sets are dealt in tiles by size.
3. Each tile is an R-tree of count vectors. First each set asks the trees of its groups for the nearest few whose summed
   coordinate minima reach the overlap that a link needs; the best of all its groups are verified on the sets.
4. What is then one component need not be compared again. In groups of several components, all sets but those of the
   largest one search the trees for every set of another component within the bound; these pairs are verified. No pair
   that links two components is lost; pairs within a component aren't listed, so groups of thousands of copies stay
   linear.

Null and empty texts have no shingles and are linked with nothing. Null ids count as larger than others. Repeated rows are
one class. An empty table gives no rows. Extra columns are left out. Sets, and the members of groups, are compared by
64-bit hashes.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, claim, maybe_broadcast, shingle_hashes, stored, table, unused, words_of
from .components import components
from .rtree import RTree

SIZE, SHARE, GROUPS, TILE = 4, (85, 100), 128, 2048
#: Most groups of a tree's vectors; partners of each set that are verified first.
MOST_GROUPS, NEAREST = 1024, 2
#: Buckets of the count sketch (as a power of two; 16 a document up to the most, so that as many shingles fall into one for any corpus), and the blocks that its sums are dealt in.
LEAST_BITS, MOST_BITS, SKETCH_BLOCKS = 18, 24, 256


def sketch_bits(docs: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(2, 16 * docs)))))


def _packed(counts: np.ndarray) -> bytes:
    """Counts in as few bytes as the largest needs, deflated: a task's are mostly 0."""
    kind = np.min_scalar_type(counts.max())
    return kind.char.encode() + zlib.compress(counts.astype(kind).tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed[1:]), np.dtype(packed[:1].decode()))


def _counts(docs: DataFrame, bits: int, size: int) -> np.ndarray:
    """Frequency class (half octaves) of each of 2**bits buckets of shingle hashes, over all documents. A task sends its counts, packed; blocks are summed as they stream in."""
    each = (1 << bits) // SKETCH_BLOCKS

    def run(it):
        claim("ngram_join")
        total = np.zeros(1 << bits, np.int32)
        for b in it:
            for t in b.column("text").to_pylist():
                np.add.at(total, (shingle_hashes(words_of(t), size) >> np.uint64(64 - bits)).astype(np.int64), 1)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(SKETCH_BLOCKS), pa.int32()), pa.array([_packed(total[i * each : (i + 1) * each]) for i in range(SKETCH_BLOCKS)], pa.binary())], ["block", "counts"])

    def add(it):
        totals: dict[int, np.ndarray] = {}
        for b in it:
            for block, counts in zip(b.column("block").to_pylist(), b.column("counts").to_pylist(), strict=True):
                totals.setdefault(block, np.zeros(each, np.int64))
                totals[block] += _unpacked(counts)
        levels = [np.floor(2 * np.log2(np.maximum(x, 1))).astype(np.uint8).tobytes() for x in totals.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array(levels, pa.binary())], ["block", "levels"])

    parts = docs.select("text").mapInArrow(run, "block int, counts binary").repartition(SKETCH_BLOCKS // 16, "block")
    out = np.zeros(1 << bits, np.uint8)
    for r in parts.mapInArrow(add, "block int, levels binary").collect():
        out[r["block"] * each : (r["block"] + 1) * each] = np.frombuffer(r["levels"], np.uint8)
    return out


def shingle_sets(docs: DataFrame, size: int = SIZE, share: tuple[int, int] = SHARE) -> DataFrame:
    """doc_id, n, sig (128-bit hash of the set, null if empty), vec (its count vector) and keys: the rarest shingles, one of which any link shares."""
    bits = sketch_bits(docs.count())
    levels = docs.sparkSession.sparkContext.broadcast(_counts(docs, bits, size))  # 16 MB at most

    def run(it):
        for b in it:
            n, sig, vec, keys = [], [], [], []
            for t in b.column("text").to_pylist():
                h = shingle_hashes(words_of(t), size)
                n.append(len(h))
                sig.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
                vec.append(_vector(h))
                level = levels.value[(h >> np.uint64(64 - bits)).astype(np.int64)]
                first = np.lexsort((h, level))[: len(h) - -(-share[0] * len(h) // share[1]) + 1] if len(h) else []
                keys.append(h[first].view(np.int64) if len(h) else np.empty(0, np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(k) for k in keys])]), pa.int32()), pa.array(np.concatenate(keys) if keys else [], pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(sig, pa.binary()), pa.array(vec, pa.binary()), lists], ["doc_id", "n", "sig", "vec", "keys"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n long, sig binary, vec binary, keys array<long>")


def _vector(h: np.ndarray) -> bytes:
    """Counts of the hashes by their remainder; the number of groups, a power of two, grows with the set, so that counts stay small."""
    groups = GROUPS << (len(h) // (4 * GROUPS)).bit_length()
    while (v := np.bincount((h % np.uint64(groups)).astype(np.int64), minlength=groups)).max() > 255:
        groups *= 2
    return v.astype(np.uint8).tobytes()


def _folded(v: bytes, groups: int) -> np.ndarray:
    """The count vector over fewer groups."""
    return np.frombuffer(v, np.uint8).reshape(-1, groups).sum(0, dtype=np.uint16)


def _bound(x: bytes, y: bytes) -> int:
    """The summed minima of two count vectors: an upper bound on the overlap of their sets."""
    groups = min(len(x), len(y))
    return int(np.minimum(_folded(x, groups), _folded(y, groups)).sum(dtype=np.int64))


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """id and shingles of the wanted classes (id, sig, doc): their texts are read again, not moved around."""

    def run(it):
        for b in it:
            sets = [shingle_hashes(words_of(t), size) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(h.tobytes()) for h in sets], pa.binary()), pa.array([h.tobytes() for h in sets], pa.binary())], ["sig", "shingles"])

    few = maybe_broadcast(wanted)
    own = docs.select("doc_id", "text").join(few.select(F.col("doc").alias("of")), F.col("doc_id").eqNullSafe(F.col("of")), "left_semi")
    return own.mapInArrow(run, "sig binary, shingles binary").join(few.select("sig", "id"), "sig").select("id", "shingles")


def _both(pairs: DataFrame, rows: DataFrame, what: str) -> DataFrame:
    """pairs (a, b) with the values x and y of a column of rows (id, what)."""
    with_x = pairs.join(rows.select(F.col("id").alias("a"), F.col(what).alias("x")), "a")
    return with_x.join(rows.select(F.col("id").alias("b"), F.col(what).alias("y")), "b").select("a", "b", "x", "y")


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, size: int, share: tuple[int, int], name: str) -> DataFrame:
    """Those of pairs (a, b) whose sets overlap enough; just the sets that pairs name are made."""

    def run(it):
        for b in it:
            keep = []
            for x, y in zip(b.column("x"), b.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(share[1] * both >= share[0] * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(c).filter(pa.array(keep, pa.bool_())) for c in "ab"], ["a", "b"])

    pairs = stored(pairs, f"{name}_pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = stored(ids.join(classes.select("id", "sig", "doc"), "id"), f"{name}_wanted")
    sets = stored(_sets(docs, wanted, size), f"{name}_sets")
    return stored(_both(pairs, sets, "shingles").mapInArrow(run, "a long, b long"), f"{name}_links")


def _compatible(x, y, share: tuple[int, int]) -> Column:
    return (F.col(x) * share[1] >= F.col(y) * share[0]) & (F.col(y) * share[1] >= F.col(x) * share[0])


def _members(classes: DataFrame, share: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """Who shares which rare shingle: rows (key, id, n, m) of groups of m sets, and a row (key, m, lo, hi) for each group, of which lo and hi are two members.

    Groups are described by aggregates, so that a key's rows never meet in a task; of groups with the same members one stays."""
    keyed = classes.select("id", "n", F.explode("keys").alias("key"))
    ends = F.min("id").alias("lo"), F.max("id").alias("hi"), F.min("n").alias("least"), F.max("n").alias("most")
    every = keyed.groupBy("key").agg(F.count("*").alias("m"), *ends, F.bit_xor(F.xxhash64("id")).alias("h")).where((F.col("m") > 2) | ((F.col("m") == 2) & _compatible("least", "most", share)))
    groups = stored(every.groupBy("m", "lo", "hi", "h").agg(F.min("key").alias("key")).drop("h"), "groups")
    return stored(keyed.join(maybe_broadcast(groups.select("key", "m")), "key"), "members"), groups


def _tiled(members: DataFrame, tile: int) -> DataFrame:
    """Adds tile: 0 in groups of at most so many sets; others are dealt by size, from counts of each size. Sets of one size go by a hash."""
    sizes = members.where(F.col("m") > tile).groupBy("key", "n").agg(F.count("*").alias("c"))
    before = F.sum("c").over(Window.partitionBy("key").orderBy("n")) - F.col("c")
    sizes = stored(sizes.withColumn("before", before), "sizes")
    place = F.floor((F.col("before") + F.pmod(F.xxhash64("id", "key"), F.col("c"))) / tile).cast("int")
    return members.join(maybe_broadcast(sizes), ["key", "n"], "left").withColumn("tile", F.coalesce(place, F.lit(0))).drop("c", "before")


def _searched(cells: DataFrame, classes: DataFrame, share: tuple[int, int], nearest: int | None = None) -> DataFrame:
    """Rows (a, b, score) of sets a that ask and sets b of another root that the cell's R-tree finds for them: all within the bound, or the nearest few.

    cells: key, tile, part, id, n, root, asks, holds (whether the set is in the tree)."""
    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cells.join(classes.select("id", "vec"), "id").repartition(parts, "key", "tile", "part").sortWithinPartitions("key", "tile", "part")

    def group(t: dict, i: int, j: int) -> list[tuple[int, int, float]]:
        vec, size, ids, root = t["vec"][i:j], t["n"][i:j], t["id"][i:j], t["root"][i:j]
        width = min(MOST_GROUPS, *map(len, vec))
        points = np.stack([_folded(v, width) for v in vec])
        asks, holds = np.flatnonzero(t["asks"][i:j]), np.flatnonzero(t["holds"][i:j])
        if not len(asks) or not len(holds):
            return []
        found = RTree(points[holds], size[holds]).pairs(points[asks], size[asks], share, nearest and nearest + 3)
        out: list[tuple[int, int, float]] = []
        q, r = asks[found[0]], holds[found[1]]
        other = root[q] != root[r]
        for a, b, bound in zip(q[other].tolist(), r[other].tolist(), found[2][other].tolist(), strict=True):
            both = int(size[a] + size[b])
            if min(len(vec[a]), len(vec[b])) > width:
                bound = _bound(vec[a], vec[b])
            if bound * sum(share) >= share[0] * both:
                out.append((int(ids[a]), int(ids[b]), bound / both))
        return out

    def run(it):
        held = None
        for b in it:
            held = pa.concat_tables([held, pa.Table.from_batches([b])]) if held is not None else pa.Table.from_batches([b])
            done, held = cut(held, False)
            yield done
        if held is not None and len(held):
            yield cut(held, True)[0]

    def cut(t: pa.Table, last: bool) -> tuple[pa.RecordBatch, pa.Table]:
        """What the whole cells of t give, and the rows of the one that may go on."""
        key = np.stack([t[c].to_numpy() for c in ("key", "tile", "part")])
        ends = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1).tolist(), *([len(t)] if last else [])] if len(t) else [0]
        cols = {c: t[c].to_numpy() for c in ("n", "id", "root")} | {c: np.array(t[c].to_pylist(), bool) for c in ("asks", "holds")} | {"vec": t["vec"].slice(0, ends[-1]).to_pylist()}
        rows = [x for i, j in zip(ends, ends[1:], strict=False) for x in group(cols, i, j)]
        a, b, score = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(score, pa.float64())], ["a", "b", "score"]), t.slice(ends[-1])

    return dealt.select("key", "tile", "part", "id", "n", "root", "asks", "holds", "vec").mapInArrow(run, "a long, b long, score double")


def _first_pairs(members: DataFrame, groups: DataFrame, classes: DataFrame, share: tuple[int, int], tile: int, nearest: int = NEAREST) -> DataFrame:
    """Pairs (a, b) of each set with the nearest that the trees of its groups find. Two sets of a large group are in all of its tiles, and tie them together."""
    tiled = stored(_tiled(members, tile), "tiled").select("key", "tile", "id", "n")
    large = groups.where(F.col("m") > tile)
    tiles = tiled.join(maybe_broadcast(large.select("key")), "key", "left_semi").select("key", "tile").distinct()
    ends = tiles.join(large.select("key", F.explode(F.array("lo", "hi")).alias("id")), "key").join(classes.select("id", "n"), "id")
    cells = tiled.unionByName(ends).distinct().select("key", "tile", F.lit(0).alias("part"), "id", "n", F.col("id").alias("root"), F.lit(True).alias("asks"), F.lit(True).alias("holds"))
    found = _searched(cells, classes, share, nearest)
    best = found.groupBy("a").agg(F.slice(F.sort_array(F.collect_set(F.struct("score", "b")), False), 1, nearest).alias("best")).select("a", F.explode("best.b").alias("b"))
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _other_pairs(members: DataFrame, marks: DataFrame, classes: DataFrame, share: tuple[int, int], tile: int) -> DataFrame:
    """Pairs (a, b) of sets of different components within the bound. Of each group all sets but those of its largest component ask."""
    rooted = members.join(maybe_broadcast(marks.withColumnRenamed("node", "id")), "id", "left").withColumn("root", F.coalesce("root", "id"))
    per = rooted.groupBy("key", "root").agg(F.count("*").alias("c")).groupBy("key").agg(F.max_by("root", "c").alias("major"), (F.sum("c") - F.max("c")).alias("minor"), F.count("*").alias("roots"))
    rows = rooted.join(maybe_broadcast(stored(per.where("roots > 1").drop("roots"), "open")), "key").withColumn("asks", F.col("root") != F.col("major"))
    rows = stored(_tiled(rows, tile), "rooted")
    cells, none = ["key", "tile", "part", "id", "n", "root", "asks", "holds"], F.lit(False)
    small = rows.where(F.col("m") <= tile).withColumns({"part": F.lit(0), "holds": F.lit(True)}).select(*cells)
    large = rows.where(F.col("m") > tile).withColumn("parts", F.ceil(F.col("minor") / tile).cast("int"))
    inside = large.withColumns({"part": F.explode(F.sequence(F.lit(0), F.col("parts") - 1)), "asks": none, "holds": F.lit(True)}).select(*cells)
    tiles = stored(large.groupBy("key", "tile").agg(F.min("n").alias("least"), F.max("n").alias("most")), "tiles")
    asking = large.where("asks").drop("tile").join(maybe_broadcast(tiles), "key").where((F.col("n") * share[1] >= F.col("least") * share[0]) & (F.col("most") * share[1] >= F.col("n") * share[0]))
    asking = asking.withColumns({"part": F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"), "holds": none}).select(*cells)
    found = _searched(small.unionByName(inside).unionByName(asking), classes, share)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _classes(docs: DataFrame, size: int, share: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """The set of each document, and the classes of equal sets: id, sig, doc (the least doc_id), copies, n, vec, keys."""
    bound_batches(docs.sparkSession)
    own = stored(shingle_sets(docs, size, share), "sets")
    same = own.where("sig IS NOT NULL").groupBy("sig").agg(F.min("doc_id").alias("doc"), F.count("*").alias("copies"), *(F.first(c).alias(c) for c in ("n", "vec", "keys")))
    return own, stored(same.withColumn("id", F.monotonically_increasing_id()), "classes")


def jaccard_pairs(docs: DataFrame, size: int = SIZE, share: tuple[int, int] = SHARE, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """All links between classes (a, b: the least doc_ids of two classes), and the members (doc_id, of: the least doc_id of its class).

    In place of components: work and result grow with the number of links, which is quadratic in groups of near copies."""
    own, classes = _classes(docs, size, share)
    members, _ = _members(classes, share)
    none = classes.select(F.col("id").alias("node"), F.col("id").alias("root")).limit(0)
    links = _verified(_other_pairs(members, none, classes, share, tile), docs, classes, size, share, "pairs")
    name = lambda c: classes.select(F.col("id").alias(c), F.col("doc").alias(f"doc_{c}"))
    pairs = links.join(name("a"), "a").join(name("b"), "b").select(F.least("doc_a", "doc_b").alias("a"), F.greatest("doc_a", "doc_b").alias("b"))
    return pairs, own.where("sig IS NOT NULL").join(classes.select("sig", F.col("doc").alias("of")), "sig").select("doc_id", "of")


def jaccard_components(docs: DataFrame, size: int = SIZE, share: tuple[int, int] = SHARE, tile: int = TILE) -> DataFrame:
    """doc_id, n_shingles, component_id (the least doc_id reachable by links), copies (rows with an equal set), of docs (doc_id, text)."""
    own, classes = _classes(docs, size, share)
    members, groups = _members(classes, share)
    marks = components(_verified(_first_pairs(members, groups, classes, share, tile), docs, classes, size, share, "first"))
    found = _verified(_other_pairs(members, marks, classes, share, tile), docs, classes, size, share, "other")
    marks = components(found.unionByName(marks.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    linked = classes.select("id", "sig", "doc", "copies").join(marks.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    least = linked.groupBy("root").agg(F.min("doc").alias("component_id"), F.count("*").alias("members"))
    of = stored(linked.join(least, "root").where("members > 1 OR copies > 1").select("sig", "component_id", "copies"), "of")
    out = own.select("doc_id", F.col("n").alias("n_shingles"), "sig").join(maybe_broadcast(of), "sig", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("copies", F.lit(1)).alias("copies"))


def op9_ngram_join(spark, sf_dir: str) -> DataFrame:
    """The component of every document."""
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five words, 80 %): the one with the least doc_id. Documents without
    words or without an id stay; of rows with one doc_id, each distinct text stays once at most."""
    of = unused(docs.columns, "of")
    twice = stored(docs.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias(of)), "twice")
    rows = docs
    if not twice.isEmpty():
        few = maybe_broadcast(twice)
        rows = docs.join(few, F.col("doc_id") == F.col(of), "left_anti").unionByName(docs.join(few, F.col("doc_id") == F.col(of), "left_semi").dropDuplicates(["doc_id", "text"]))
    gone = jaccard_components(rows.select("doc_id", "text"), SIZE + 1, (80, 100)).where("component_id <> doc_id").select(F.col("doc_id").alias(of)).distinct()
    return rows.join(maybe_broadcast(stored(gone, "gone")), F.col("doc_id") == F.col(of), "left_anti").select(*docs.columns)


#: All pairs of classes that share a shingle are counted: for small tables.
SQL = {
    "op9_ngram_join": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) AS g FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS sig FROM s GROUP BY doc_id),
c AS (SELECT sig, min(doc_id) AS doc, any_value(n) AS n, count(*) AS copies FROM n GROUP BY sig),
k AS (SELECT doc, n, g FROM c JOIN s ON doc_id = doc),
p AS (SELECT a.doc AS a, b.doc AS b FROM k AS a JOIN k AS b ON a.g = b.g AND a.doc < b.doc AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n GROUP BY a.doc, b.doc, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT doc AS a, doc AS root FROM c UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.a WHERE r.root < e.b),
m AS (SELECT a AS doc, min(root) AS root FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.root, d.doc_id) AS component_id, coalesce(c.copies, 1) AS copies
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (sig) LEFT JOIN m ON m.doc = c.doc"""
}
