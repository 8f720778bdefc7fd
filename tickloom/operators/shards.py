"""Shards of a file inventory: files in the order of their paths fill a shard; one is closed before a file that doesn't fit,
and after a file that is larger than a shard, which is alone in its shard therefore.

A shard's end depends on the file it begins with alone: it is the first later file whose end lies more than a shard's bytes
beyond. So the plan is a chain of jumps from file to file. Cells of SPAN shards' bytes are joined to ranges of about FILES
files. Each range, with the files of one more shard's bytes behind it, tells for every file a shard can begin with at its start
where the chain enters the next range. These jumps are doubled by joins, so that in log2(ranges) rounds each range knows where
it is entered and by which shard; each then follows its own chain, and files take the number of the last shard that begins at
or before them, which is looked up by cell.

Empty files never close a shard: of a row of them the first takes part. A task holds the sizes of FILES files, and of SPAN + 1 shards' files.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .ordered import running

#: Shards' bytes in a cell, and files from which on a range takes no further cell: a call for each range, and entries at its start, cost little then.
SPAN, FILES = 8, 1 << 17
JUMPS = "cell long, entry long, leave long, shards long"
BEGINS = "own long, begins array<struct<place:long,shard:long>>"


def next_places(begin: np.ndarray, end: np.ndarray, limit: int) -> np.ndarray:
    """For a shard that begins with a file, where in these files the next begins (their number: behind them). Files in order, by the bytes before and upto them."""
    return np.maximum(np.searchsorted(end, begin + limit, side="right"), np.arange(len(begin)) + 1)


def ranges(placed: DataFrame, files: int = FILES) -> DataFrame:
    """The cells that files (own: the cell, place) begin in, with their range, and the range of the cell before where that is another. Ranges take cells by the place of their first file."""
    cells = stored(placed.groupBy("own").agg(F.floor(F.min("place") / files).alias("range")))
    earlier = cells.select((F.col("own") + 1).alias("own"), F.col("range").alias("last"))
    return stored(cells.join(earlier, "own", "left").select("own", "range", F.when(F.col("last") != F.col("range"), F.col("last")).alias("near")))


def _ordered(t: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    t = t.sort_values("place")
    begin = t["before"].to_numpy()
    return t["place"].to_numpy(), begin, begin + t["size"].to_numpy(), int((t["cell"] == t["range"]).sum())


def shard_plan(inventory: DataFrame, shard_bytes: int, span: int = SPAN, files: int = FILES) -> DataFrame:
    """relative_path, size_bytes and shard. Paths must be unique; null sizes count as 0; an empty inventory gives no rows."""
    limit = int(shard_bytes)
    if limit <= 0:
        raise ValueError("shard_bytes must be positive")
    width = span * limit
    size = F.coalesce("size_bytes", F.lit(0))
    rows = inventory.select("relative_path", F.col("size_bytes").cast("long").alias("size_bytes"))
    placed = stored(running(rows, "relative_path", {"before": size}, {"last": size}).withColumn("own", F.floor(F.col("before") / width)))
    items = placed.where((size > 0) | F.col("last").isNull() | (F.col("last") > 0)).select("place", "before", size.alias("size"), "own").join(ranges(placed, files), "own")
    near = F.when(F.col("before") - F.col("own") * width < limit, F.col("near"))
    dealt = stored(items.withColumn("cell", F.explode(F.array_compact(F.array("range", near)))).drop("near"))

    def jumps(t: pd.DataFrame) -> pd.DataFrame:
        """Of each file that a shard can begin with at the start of the range: where its chain leaves the range (null: at the end of all files), after how many shards."""
        place, begin, end, n = _ordered(t)
        if not n:
            return pd.DataFrame({c.split()[0]: [] for c in JUMPS.split(", ")})
        cell = int(t["cell"].iloc[0])
        step = next_places(begin, end, limit)[:n]
        to, count = step.copy(), np.ones(n, np.int64)
        while (inside := np.flatnonzero(to < n)).size:
            to[inside], count[inside] = to[to[inside]], count[inside] + count[to[inside]]
        # Behind the last file here nothing follows, unless that is larger than a shard: then the next file does, if there is one.
        known = np.append(place, place[-1] + 1)[to]
        open_end = (to == len(place)) & ~(end[-1] - begin[-1] > limit)
        enter = begin[:n] - begin[0] <= limit
        leave = pd.array(known, dtype="Int64")
        leave[open_end] = pd.NA
        return pd.DataFrame({"cell": cell, "entry": place[:n], "leave": leave, "shards": count})[enter]

    reach = stored(dealt.groupBy("cell").applyInPandas(jumps, JUMPS))
    met = reach.select(F.col("leave").alias("entry")).distinct()
    reach = stored(reach.where("entry = 0").unionByName(reach.join(met, "entry", "left_semi").where("entry > 0").select(*reach.columns)))
    known = reach.where("entry = 0").select("entry", F.lit(0).cast("long").alias("shard"))
    hops = reach.where("leave IS NOT NULL").select("entry", "leave", "shards")
    while not hops.isEmpty():  # twice as many ranges a round
        known = stored(known.unionByName(known.join(hops, "entry").select(F.col("leave").alias("entry"), (F.col("shard") + F.col("shards")).alias("shard"))))
        then = hops.select(F.col("entry").alias("leave"), F.col("leave").alias("beyond"), F.col("shards").alias("more"))
        hops = stored(hops.join(then, "leave").select("entry", F.col("beyond").alias("leave"), (F.col("shards") + F.col("more")).alias("shards")))
    entered = known.join(reach.select("entry", "cell"), "entry").select("cell", F.col("entry").alias("first"), "shard")

    def begins(rows: pa.Table) -> pa.Table:
        """For each cell of the range the shards that begin in it, and the one that is open before."""
        t = rows.to_pandas()
        place, begin, end, n = _ordered(t)
        step, at, shard = next_places(begin, end, limit).tolist(), int(np.searchsorted(place, t["first"].iloc[0])), int(t["shard"].iloc[0])
        found = []
        while at < n:
            found.append(at)
            at = step[at]
        cell, first = np.unique(np.sort(t["own"].to_numpy())[:n], return_index=True)
        upto = np.searchsorted(found, np.append(first, n))
        counts = np.diff(upto) + 1
        shards = np.arange(len(found) + len(cell)) - np.repeat(np.arange(len(cell)), counts) + shard - 1
        places = np.insert(place[found], upto[:-1], -1)
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.StructArray.from_arrays([pa.array(places, pa.int64()), pa.array(shards, pa.int64())], ["place", "shard"]))
        return pa.table({"own": pa.array(cell, pa.int64()), "begins": lists})

    cells = stored(dealt.join(entered, "cell").groupBy("cell").applyInArrow(begins, BEGINS))
    last = cells.agg(F.max(F.array_max(F.transform("begins", lambda x: x["shard"])))).first()[0]
    shard = F.array_max(F.transform(F.filter("begins", lambda x: x["place"] <= F.col("place")), lambda x: x["shard"]))
    out = placed.join(cells, "own", "left")
    # A last range that no shard begins in holds the end of the last one.
    return out.select("relative_path", "size_bytes", F.coalesce(shard, F.lit(last)).cast("long").alias("shard"))
