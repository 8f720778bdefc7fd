"""Mixing sources to target weights by Pareto order sampling.

Each source has a target share of all words. Every document gets the whole copies that its source's target holds for
sure; the words that are left are drawn without replacement: documents are ranked by their random odds u/(1-u) divided
by the odds of their inclusion probability, and taken in this order up to the source's fixed size in words; documents
that are certain to be included come first, by their draw. Inclusion grows with a document's importance. The first that
doesn't fit ends this. What is left, less than its size, is filled by later documents of the order: from the largest size
class (powers of two) down to the smallest each class gives as many as fit, in order; then one more is taken, of those that
were next or of the one that ended the order, if the words come nearer to the target with it. So a source misses its target by
less than twice the smallest size class of which documents are left over. Draws are hashes of id and text: reruns agree,
repeated rows share a draw and are counted as one group; where the size is reached within a group, as many of its rows are
taken as fit.

Null or empty texts have no words and are never taken; null sources are one source, the last; an empty table gives an
empty mix. Other columns are kept, whatever their names. The ranks are never sorted as a whole: word counts in bins of the
rank give the bin where a source's size is reached, counts in bins of this bin the narrow one, and just its documents are
sorted, repeated rows as one; size classes are cut likewise, so that a source's filling looks at documents of no more words
than the one that ended the order, and a narrow bin. Jobs are as many for any data.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, maybe_broadcast, stored, table

WEIGHTS, CAP, BINS = (1, 2, 3), 3.0, 4096


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """A row for each source: source_size, its mean importance by words, and target.

    Targets share all words by weight; none exceeds cap times its source's size, what is left is shared again by weight.
    Sources are filled in the order of cap * size / weight: those before the first that holds its share are full."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("importance")).alias("sum_importance"))
    ranked = per.withColumn("weight", F.array(*(F.lit(float(w)) for w in weights))[(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)])
    full = F.col("source_size") * F.lit(float(cap))
    order = Window.orderBy("fill", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum(full).over(before), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    filled = ranked.withColumn("fill", full / F.col("weight")).withColumn("level", level).withColumn("place", F.row_number().over(order))
    cut = F.min(F.when(F.col("fill") >= F.col("level"), F.struct("place", "level"))).over(every)
    return filled.select("source", "source_size", F.try_divide("sum_importance", "source_size").alias("mean_importance"), F.least(full, F.coalesce(cut["level"] * F.col("weight"), full)).alias("target"))


def _uniform(seed: int, *cols: str) -> Column:
    """A number in (0, 1) from a hash."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 12) + F.lit(0.5)) / F.lit(float(1 << 52))


def _ranked(df: DataFrame) -> DataFrame:
    """Adds base (certain whole copies) and rank in [0, 1]: the draw of documents that are certain, then odds / inclusion odds, as a share."""
    ratio = F.try_divide(F.col("target"), F.col("source_size"))
    base = F.coalesce(F.floor(ratio), F.lit(0)).cast("long")
    inclusion = F.least((ratio - F.floor(ratio)) * F.try_divide(F.col("importance"), F.col("mean_importance")), F.lit(1.0))
    odds = F.col("draw") / (1 - F.col("draw"))
    against = F.when(inclusion > 0, (1 - inclusion) / inclusion)
    return df.withColumn("base", F.when(F.col("size") > 0, base).otherwise(0)).withColumn("rank", F.when(F.col("size") > 0, F.when(inclusion >= 1, F.col("draw") / 4).otherwise(0.25 + 0.75 * odds * against / (1 + odds * against))))


def _keyed(col: str) -> Column:
    return F.struct(F.col(col).isNull().alias("none"), F.coalesce(F.col(col), F.lit("")).alias("of"))


def _order() -> Column:
    """The order of documents; equal for repeated rows only (ids can have several texts)."""
    return F.struct("rank", "doc_id", "draw")


def _places() -> list[tuple[Column, Column, Column]]:
    """Where a group of equal rows can be taken in part: whether the document is there, how many rows are, and how many are taken."""
    return [(F.coalesce(_order() == F.col(f"cut{i}"), F.lit(False)), F.col(f"rows{i}"), F.col(f"take{i}")) for i in ("0", "1", "c")]


def _chosen() -> Column:
    """Whether one more copy of the document is taken: it comes before the cut, of all or of its size class, or all rows at such a place are taken."""
    later = (_order() > F.col("cut0")) & (F.col("size") <= F.col("left")) & F.col("filled")
    out = F.col("all0") | (_order() < F.col("cut0")) | F.coalesce(later & (F.col("cutc").isNull() | (_order() < F.col("cutc"))), F.lit(False))
    for here, rows, take in _places():
        out = F.coalesce(out, F.lit(False)) | (here & F.coalesce(take >= rows, F.lit(False)))
    return F.col("rank").isNotNull() & out


def _partly() -> list[Column]:
    """At which of the places the document is of a group of which some but not all rows are taken."""
    return [here & F.coalesce((take > 0) & (take < rows), F.lit(False)) for here, rows, take in _places()]


def _split(tied: DataFrame) -> DataFrame:
    """Adds _chosen to the stored rows of groups that are taken in part (key, _tie, _take, _tag): the first _take of each by tag.

    Rows are counted by blocks of tags (a partition's rows are one), and just the block where take is reached is sorted."""
    block = F.shiftrightunsigned("_tag", 33)
    counts = tied.groupBy("key", "_tie", "_take", block.alias("block")).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("key", "_tie").orderBy("block"))
    edge = counts.withColumn("upto", upto).where("upto >= _take").groupBy("key", "_tie").agg(F.min_by(F.struct("block", (F.col("_take") - F.col("upto") + F.col("n")).alias("left")), "block").alias("edge")).select("key", "_tie", "edge.*")
    at = tied.select("key", "_tie", "_tag", block.alias("block")).join(F.broadcast(edge), ["key", "_tie", "block"])
    last = at.withColumn("place", F.row_number().over(Window.partitionBy("key", "_tie").orderBy("_tag"))).where("place = left").select("key", "_tie", F.col("_tag").alias("_last"))
    return tied.join(F.broadcast(last), ["key", "_tie"]).withColumn("_chosen", F.col("_tag") <= F.col("_last"))


def _first_above(sums: DataFrame, what: str, keys: tuple[str, ...] = ("key",)) -> DataFrame:
    """keys, what and before (words of those before) of the keys' first row of sums (keys, what, words, before, gap) with which the words exceed gap."""
    upto = F.col("before") + F.sum("words").over(Window.partitionBy(*keys).orderBy(what))
    return sums.withColumn("upto", upto).where("upto > gap").groupBy(*keys).agg(F.min_by(F.struct(what, (F.col("upto") - F.col("words")).alias("before")), what).alias("edge")).select(*keys, "edge.*")


FILLED = pa.schema([("none", pa.bool_()), ("of", pa.string()), ("class", pa.int32()), ("id", pa.int64()), ("take", pa.int64()), ("more0", pa.bool_()), ("more1", pa.bool_())])


def fill(t: pa.Table) -> pa.Table:
    """What one source's filling takes. t: class, place (in the order of its class), id, size and n (equal rows); one row of class -1
    tells what is left (size), and of two larger documents, the one that ended the order and the smallest later one, over0 and over1.

    Gives of each class the id where it is cut (null: all are taken) and how many rows are taken there; and which larger one is taken."""
    t = t.sort_by([("class", "descending"), ("place", "ascending")])
    kind = t["class"].to_numpy()
    own = t.slice(len(t) - 1).to_pylist()[0]
    left, out, following = float(own["size"]), [], []
    begins = np.flatnonzero(np.diff(kind, prepend=kind[0] + 1)).tolist()
    for i, j in zip(begins, begins[1:], strict=False):  # but for the last, the row of class -1
        size, n, ids = (t[c].slice(i, j - i).to_numpy() for c in ("size", "n", "id"))
        upto = np.cumsum(size * n)
        k = int(np.searchsorted(upto, left, side="right"))
        left -= int(upto[k - 1]) if k else 0
        take = 0
        if k < len(ids):
            take = int(left // size[k])
            left -= take * int(size[k])
            following.append((int(size[k]), len(out), "take"))
        out.append({"class": int(kind[i]), "id": int(ids[k]) if k < len(ids) else None, "take": take, "more0": False, "more1": False})
    out.append({"class": -1, "id": None, "take": 0, "more0": False, "more1": False})
    following += [(int(own[c]), len(out) - 1, more) for more, c in (("more0", "over0"), ("more1", "over1")) if own[c] > 0]
    size, at, which = min(following, key=lambda x: abs(x[0] - left), default=(math.inf, 0, "take"))
    if abs(size - left) < left:
        out[at][which] = out[at][which] + 1 if which == "take" else True
    return pa.Table.from_pylist([x | {"none": own["none"], "of": own["of"]} for x in out], schema=FILLED)


def _cuts(sized: DataFrame, targets: DataFrame, bins: int) -> tuple[DataFrame, DataFrame]:
    """The places that _chosen() needs. For each source: cut0, the first in order that doesn't fit (take0 of its rows0 equal rows do; all0:
    everything fits), left (words after it) and cut1, the smallest later document that is larger, if it is taken. For each source and
    class of sizes: cutc, the first later document that isn't taken (take_c of its rows_c are)."""
    left = F.when(F.col("source_size") > 0, F.col("target") - F.floor(F.col("target") / F.col("source_size")) * F.col("source_size")).otherwise(0.0)
    out = stored(targets.withColumns({"gap": left, "key": _keyed("source")}), "gaps")
    n, cols = out.count(), ["key", "size", "rank", "doc_id", "draw"]
    rows = _ranked(sized.join(maybe_broadcast(out.drop("source"), n), "key")).where("rank IS NOT NULL")
    own = rows.select(*cols, "gap").withColumn("bin", F.floor(F.col("rank") * bins)).withColumn("fine", F.floor((F.col("rank") * bins - F.col("bin")) * bins))
    sums = stored(own.groupBy("key", "bin").agg(F.sum("size").alias("words"), F.first("gap").alias("gap"), F.lit(0).alias("before")), "sums")
    edge = stored(_first_above(sums, "bin"), "edge")
    fine = own.join(maybe_broadcast(edge, n), ["key", "bin"]).groupBy("key", "bin", "fine").agg(F.sum("size").alias("words"), F.first("gap").alias("gap"), F.first("before").alias("before"))
    edge = stored(_first_above(fine, "fine").join(edge.select("key", "bin"), "key"), "fine")
    at = own.join(maybe_broadcast(edge, n), ["key", "bin", "fine"]).groupBy("key", "rank", "doc_id", "draw", "size", "gap", "before").agg(F.count("*").alias("n"))
    words = F.col("size") * F.col("n")
    upto = F.col("before") + F.sum(words).over(Window.partitionBy("key").orderBy("rank", "doc_id", "draw").rowsBetween(Window.unboundedPreceding, 0))
    room = F.col("gap") - F.col("upto") + words
    take = F.greatest(F.least(F.floor(room / F.col("size")), F.col("n") - 1), F.lit(0)).cast("long")
    cut = at.withColumn("upto", upto).where("upto > gap").withColumn("take", take)
    cut = cut.groupBy("key").agg(F.min_by(F.struct(_order().alias("cut0"), F.col("size").alias("over0"), F.col("n").alias("rows0"), F.col("take").alias("take0"), (room - F.col("take") * F.col("size")).alias("rest")), _order()).alias("found")).select("key", "found.*")
    out = stored(out.join(cut, "key", "left").withColumn("all0", F.col("cut0").isNull()).withColumn("gap", F.coalesce("rest", F.lit(0.0))).drop("rest"), "cut")
    later = rows.select(*cols).join(maybe_broadcast(out.select("key", "cut0", "gap"), n), "key").where((_order() > F.col("cut0")) & (F.col("size") < 2 * F.col("gap")))
    over = later.where("size > gap").groupBy("key", *cols[1:]).agg(F.count("*").alias("n")).groupBy("key").agg(F.min_by(F.struct(_order().alias("cut1"), F.col("size").alias("over1"), F.col("n").alias("rows1")), F.struct("size", _order())).alias("found"))
    out = stored(out.join(over.select("key", "found.*"), "key", "left"), "over")
    own = later.where("size <= gap").select(*cols, "gap", F.floor(F.log2("size")).cast("int").alias("class"), F.floor(F.col("rank") * bins).alias("bin")).withColumn("fine", F.floor((F.col("rank") * bins - F.col("bin")) * bins))
    keys, held = ("key", "class"), [F.sum("size").alias("words"), F.first("gap").alias("gap")]
    edge = stored(_first_above(own.groupBy(*keys, "bin").agg(*held, F.lit(0).alias("before")), "bin", keys), "edge")
    narrow = own.join(maybe_broadcast(edge), [*keys, "bin"]).groupBy(*keys, "bin", "fine").agg(*held, F.first("before").alias("before"))
    edge = stored(_first_above(narrow, "fine", keys).drop("before").join(edge.select(*keys, "bin"), list(keys)).select(*keys, F.struct("bin", "fine").alias("edge")), "fine")
    near = own.join(maybe_broadcast(edge), list(keys), "left").where(F.col("edge").isNull() | (F.struct("bin", "fine") <= F.col("edge")))
    near = near.groupBy(*keys, *cols[1:]).agg(F.count("*").alias("n")).withColumn("id", F.monotonically_increasing_id())
    near = stored(near, "near").withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("rank", "doc_id", "draw")))
    # A row a source, so that one without later documents is seen, too.
    each = out.select("key", F.lit(-1).alias("class"), F.lit(0).alias("place"), F.lit(-1).cast("long").alias("id"), F.col("gap").alias("size"), F.lit(1).cast("long").alias("n"), F.coalesce("over0", F.lit(0)).alias("over0"), F.coalesce("over1", F.lit(0)).alias("over1"))
    shared = near.select("key", "class", "place", "id", F.col("size").cast("double").alias("size"), "n", F.lit(0).cast("long").alias("over0"), F.lit(0).cast("long").alias("over1")).unionByName(each)
    filled = shared.select("key.none", "key.of", *shared.columns[1:]).groupBy("none", "of").applyInArrow(fill, "none boolean, of string, class int, id long, take long, more0 boolean, more1 boolean")
    filled = stored(filled.withColumn("key", F.struct("none", "of")).drop("none", "of"), "filled")
    out = out.join(maybe_broadcast(filled.where("class < 0").select("key", "more0", "more1"), n), "key").withColumn("left", F.col("gap"))
    out = out.withColumns({"take0": F.col("take0") + F.col("more0").cast("long"), "take1": F.col("more1").cast("long")}).drop("gap", "over0", "over1", "more0", "more1")
    classes = filled.where("class >= 0").select("key", "class", "id", F.col("take").alias("takec"), F.lit(True).alias("filled"))
    classes = classes.join(near.select("id", _order().alias("cutc"), F.col("n").alias("rowsc")), "id", "left").drop("id")
    return stored(out, "cuts"), stored(classes, "classes")


def mix(docs: DataFrame, weights=WEIGHTS, cap: float = CAP, importance: Column | None = None, seed: int = 17, bins: int = BINS) -> DataFrame:
    """docs with size, source_size, target and copies (0 for documents that the mix leaves out). Columns of these names are replaced.

    importance: a positive column that the inclusion probability is in proportion to; by default log2(2 + size), so that
    longer documents are likelier. The per-source table has a row for each source; it is broadcast if it was counted small."""
    importance = F.log2(F.col("size") + 2.0) if importance is None else importance
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    rows = docs.select(*kept).withColumn("size", n_words())
    # The documents' own columns lie in one, so that no name of theirs meets one of these.
    rows = rows.select(F.struct(*kept).alias("row"), "doc_id", "source", "size", importance.alias("importance"), _uniform(seed, "doc_id", "text").alias("draw"), _keyed("source").alias("key"))
    narrow = stored(rows.drop("row"), "sized")
    targets = stored(source_targets(narrow, weights, cap), "targets")
    cuts, classes = _cuts(narrow.drop("source"), targets, bins)
    rows = rows.drop("source").withColumn("class", F.when(F.col("size") > 0, F.floor(F.log2("size"))).cast("int"))
    joined = _ranked(rows.join(maybe_broadcast(cuts.drop("source")), "key")).join(maybe_broadcast(classes), ["key", "class"], "left")
    joined = joined.withColumn("chosen", _chosen())
    at, by = _partly(), [F.lit(-2), F.lit(-1), F.col("class")]
    whole = classes.where((F.col("takec") > 0) & (F.col("takec") < F.col("rowsc"))).isEmpty() and cuts.where(reduce(or_, [F.coalesce((F.col(f"take{i}") > 0) & (F.col(f"take{i}") < F.col(f"rows{i}")), F.lit(False)) for i in (0, 1)])).isEmpty()
    if not whole:  # repeated rows at a cut, of which some are taken
        joined = joined.withColumns({"_tie": F.coalesce(*(F.when(a, t) for a, t in zip(at, by, strict=True))), "_take": F.coalesce(*(F.when(a, take) for a, (_, _, take) in zip(at, _places(), strict=True)))})
        tied = stored(joined.where("_tie IS NOT NULL").withColumn("_tag", F.monotonically_increasing_id()).drop("chosen"), "tied")
        joined = joined.where("_tie IS NULL").drop("_tie", "_take").unionByName(_split(tied).withColumnRenamed("_chosen", "chosen").drop("_tie", "_take", "_tag", "_last"))
    copies = F.coalesce("base", F.lit(0)) + F.when(F.col("chosen"), 1).otherwise(0)
    return joined.select(*(F.col("row")[c].alias(c) for c in kept), "size", "source_size", "target", copies.alias("copies"))


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents with the words that the mix takes of each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as many times as it is taken, with its columns as they are."""
    taken = mix(docs.select("doc_id", "source", "text", F.struct("*").alias("row"))).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")
