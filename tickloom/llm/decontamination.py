"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Which documents hold at least `threshold` of the five-word shingles of a test item? Items are partitioned by their number
of shingles (powers of two), so that items of one partition have sketches of similar length. An item of q shingles keeps
its q - ceil(threshold * q) + 1 smallest hashes, its bottom-k MinHash sketch: a text that holds enough of its shingles
must hold one of these. A document keeps, for each partition, its hashes up to the partition's largest sketch hash, found
through the sorted sketches; what hits is a candidate and is verified on the shingles' words. No leak can be missed, at
any length of document, where banded signatures lose short items in long texts.

Items come in blocks of bounded number and length. A pass over the documents holds HELD blocks at most; of a longer
benchmark each pass writes what it found in the shared folder, by a hash of the text, and these few rows are joined to
the documents in the end. The benchmark is the stated query set: documents are never joined among each other.

Words are runs of letters, digits and _, in lower case. An item of fewer than five words is one shingle of all its words.
Null, empty and wordless items and documents match nothing. Repeated items and documents match each time. Null ids pass.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import _MIX, bound_batches, maybe_broadcast, mixed, stored, table, unused

#: Items and characters of a block, and blocks that a pass holds.
SIZE, THRESHOLD, BLOCK, BLOCK_CHARS, HELD = 5, 0.8, 20_000, 4 << 20, 4
WORDS = re.compile(r"\w+")
MATCH = pa.struct([("item_id", pa.int64()), ("n_shared", pa.int64()), ("n_item", pa.int64()), ("containment", pa.float64())])
MATCH_SQL = "array<struct<item_id: bigint, n_shared: bigint, n_item: bigint, containment: double>>"


def words(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def _hashes(own: list[str], size: int) -> np.ndarray:
    """Distinct hashes of all shingles of exactly this size."""
    if len(own) < size:
        return np.empty(0, np.uint64)
    w = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in own), np.uint64, len(own))
    h = np.zeros(len(own) - size + 1, np.uint64)
    for i in range(size):
        h = mixed(h * _MIX[0] + w[i : len(w) - size + 1 + i])
    return np.unique(h)


def _shingles(own: list[str], size: int) -> set[tuple[str, ...]]:
    return {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}


class Sketches:
    """Sketches of one block of items; by shingle size, then by partition."""

    def __init__(self, items: list[tuple[int | None, str | None]], size: int = SIZE, threshold: float = THRESHOLD):
        self.threshold, self.items, parts = threshold, [], {}
        for item_id, text in items:
            own = words(text)
            if not own:
                continue
            n = min(size, len(own))
            h = _hashes(own, n)
            q = len(_shingles(own, n))
            need = math.ceil(threshold * q - 1e-9)
            parts.setdefault((n, q.bit_length()), []).append((len(self.items), h[: q - need + 1]))
            self.items.append((item_id, _shingles(own, n), need, n))
        self.parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for (n, _), own in sorted(parts.items()):
            h, i = np.concatenate([x for _, x in own]), np.repeat([i for i, _ in own], [len(x) for _, x in own])
            order = np.argsort(h, kind="stable")
            self.parts.setdefault(n, []).append((h[order], i[order]))

    def matches(self, text: str | None) -> list[dict]:
        own, found, exact = words(text), set(), {}
        for n, parts in self.parts.items():
            h = _hashes(own, n)
            for sketch, item in parts:
                low = h[: np.searchsorted(h, sketch[-1], side="right")]
                a, z = np.searchsorted(sketch, low, side="left"), np.searchsorted(sketch, low, side="right")
                for i in np.flatnonzero(z > a):
                    found.update(item[a[i] : z[i]].tolist())
        out = []
        for i in sorted(found):
            item_id, shingles, need, n = self.items[i]
            if n not in exact:
                exact[n] = _shingles(own, n)
            shared = len(shingles & exact[n])
            if shared >= need:
                out.append({"item_id": item_id, "n_shared": shared, "n_item": len(shingles), "containment": shared / len(shingles)})
        return out


def _blocks(benchmark: DataFrame, most: int, most_chars: int) -> Iterator[list[tuple]]:
    """Items in blocks of at most about `most` items and `most_chars` characters, split by hash; each is collected when its turn comes."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    n, chars = rows.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    parts = max(1, math.ceil(n / most), math.ceil(chars / most_chars))
    for i in range(parts):
        yield [tuple(r) for r in rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == i).collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, size: int = SIZE, block: int = BLOCK, block_chars: int = BLOCK_CHARS, out: str = "leaks") -> DataFrame:
    """docs with an array of the items they hold: item_id, n_shared, n_item, containment. Extra columns are kept, but for one named like out."""
    spark = docs.sparkSession
    bound_batches(spark)
    keep = [c for c in docs.columns if c != out]
    rows, blocks = docs.select(*keep), _blocks(benchmark, block, block_chars)
    held = _held(spark, blocks, size, threshold)
    more = _held(spark, blocks, size, threshold)
    if not more:
        schema = T.StructType([docs.schema[c] for c in keep]).add(out, T.DataType.fromDDL(MATCH_SQL))

        def run(it):
            for b in it:
                got = [[m for x in held for m in x.value.matches(t)] for t in b.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(got, pa.list_(MATCH))], [*keep, out])

        return rows.mapInArrow(run, schema)
    texts, parts = docs.select(F.md5("text").alias("sig"), "text"), []
    while held:

        def hits(it, held=held):
            for b in it:
                got = [[m for x in held for m in x.value.matches(t)] for t in b.column("text").to_pylist()]
                some = pa.array([bool(g) for g in got], pa.bool_())
                yield pa.RecordBatch.from_arrays([b.column("sig").filter(some), pa.array([g for g in got if g], pa.list_(MATCH))], ["sig", "found"])

        found = texts.mapInArrow(hits, f"sig string, found {MATCH_SQL}").withColumn("part", F.lit(len(parts)))
        parts.append(stored(found.dropDuplicates(["sig"]), f"leaks{len(parts)}"))
        for x in held:
            x.destroy()
        held, more = more, _held(spark, blocks, size, threshold)
    listed = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("part", "found"))), lambda x: x["found"]))
    of = unused([*keep, out], "of")
    leaks = stored(reduce(DataFrame.unionByName, parts).groupBy(F.col("sig").alias(of)).agg(listed.alias(out)), "leaks")
    return rows.join(maybe_broadcast(leaks), F.md5("text") == F.col(of), "left").select(*keep, F.coalesce(out, F.array().cast(MATCH_SQL)).alias(out))


def _held(spark, blocks: Iterator[list[tuple]], size: int, threshold: float) -> list:
    """Broadcast sketches of the next few blocks; none after the last."""
    return [spark.sparkContext.broadcast(Sketches(items, size, threshold)) for items in islice(blocks, HELD)]


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    """Pairs of documents and the benchmark items that they hold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id", F.inline("leaks"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    leaks = unused(docs.columns, "leaks")
    return find_leaks(docs, table(spark, sf_dir, "benchmark"), out=leaks).where(F.size(leaks) == 0).select(*docs.columns)


SQL = {
    "op6_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM benchmark),
q AS (SELECT DISTINCT item_id, least(len(w), 5) AS k, unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda i: array_to_string(w[i:i + least(len(w), 5) - 1], ' '))) AS s FROM b WHERE len(w) > 0),
k AS (SELECT DISTINCT k FROM q),
x AS (SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s FROM d, k WHERE len(w) >= k),
n AS (SELECT item_id, count(*) AS n_item FROM q GROUP BY item_id),
m AS (SELECT x.doc_id, q.item_id, count(*) AS n_shared FROM x JOIN q USING (k, s) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment FROM m JOIN n USING (item_id) WHERE 5 * n_shared >= 4 * n_item"""
}
