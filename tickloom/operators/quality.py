"""Quality metrics of bars: bounds, duplicate keys, price integrity, order."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BAR_KEY
from ..session import checkpointed

NULLABLE = ("symbol", "ts_utc", "timeframe", "open", "high", "low", "close", "volume")


def _any(conditions) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | F.coalesce(c, F.lit(False))
    return out


def report_rules() -> dict[str, Column]:
    """The five rules of the report; a row can break several."""
    return {
        "high_lt_open_close": F.col("high") < F.greatest("open", "close"),
        "low_gt_open_close": F.col("low") > F.least("open", "close"),
        "nonpositive_price": _any(F.col(c) <= 0 for c in ("open", "high", "low", "close")),
        "negative_volume": F.col("volume") < 0,
        "null_required": _any(F.col(c).isNull() for c in NULLABLE),
    }


def export_rule() -> Column:
    """Any broken rule of the export: as the report, with high below low, without nulls."""
    rules = report_rules()
    rules.pop("null_required")
    return _any([*rules.values(), F.col("high") < F.col("low")])


def duplicate_keys(bars: DataFrame) -> DataFrame:
    return bars.groupBy(*BAR_KEY).agg(F.count("*").alias("row_count")).where("row_count > 1")


def duplicates_by_symbol(bars: DataFrame) -> DataFrame:
    """symbol, duplicate_keys, duplicate_rows (beyond the first of a key), of all symbols."""
    keys = bars.groupBy(*BAR_KEY).agg(F.count("*").alias("n"))
    return keys.groupBy("symbol").agg(F.count_if(F.col("n") > 1).alias("duplicate_keys"), F.sum(F.col("n") - 1).alias("duplicate_rows"))


def duplicates_rollup(bars: DataFrame) -> DataFrame:
    """As duplicates_by_symbol, of symbols with duplicates; null symbols are left out."""
    return duplicates_by_symbol(bars.where("symbol IS NOT NULL")).where("duplicate_keys > 0")


def violations_by_symbol(bars: DataFrame) -> DataFrame:
    return bars.where(export_rule()).groupBy("symbol").agg(F.count("*").alias("ohlc_violation_count"))


def violations_by_rule(bars: DataFrame) -> DataFrame:
    """rule, symbol, violation_count in one pass over the bars."""
    broken = F.array_compact(F.array(*(F.when(c, F.lit(name)) for name, c in report_rules().items())))
    return bars.select("symbol", F.explode(broken).alias("rule")).groupBy("rule", "symbol").agg(F.count("*").alias("violation_count"))


def any_rule() -> Column:
    return _any(report_rules().values())


def violations_total(bars: DataFrame) -> DataFrame:
    return bars.agg(F.count_if(any_rule()).alias("violation_count"))


def violation_samples(bars: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """At most n broken rows of each rule, first in order."""
    broken = F.array_compact(F.array(*(F.when(c, F.lit(name)) for name, c in report_rules().items())))
    place = F.row_number().over(Window.partitionBy("rule").orderBy(*order))
    return bars.withColumn("rule", F.explode(broken)).withColumn("sample", place).where(F.col("sample") <= n)


def broken_days(keys: DataFrame, n: int) -> DataFrame:
    """symbol and day of the rows of rollup.keyed() that hold each rule's first n broken bars by symbol and time: n at most a rule."""
    days = keys.groupBy("symbol", "day").agg(*(F.sum(f"broken_{k}").alias(k) for k in report_rules()))
    order = [F.asc_nulls_last("symbol"), F.asc_nulls_last("day")]
    found = [days.where(F.col(k) > 0).orderBy(*order).limit(n).select("symbol", "day") for k in report_rules()]
    return reduce(DataFrame.unionByName, found).distinct()


def on_days(bars: DataFrame, days: DataFrame) -> DataFrame:
    """bars on some days of symbols (few: they are broadcast, and their bounds are pushed to the scan)."""
    b = days.agg(F.min("day"), F.max("day"), F.count_if(F.col("day").isNull())).first()
    some = bars if b[0] is None else bars.where(((F.col("ts_utc") >= F.lit(b[0]).cast("timestamp")) & (F.col("ts_utc") < F.date_add(F.lit(b[1]), 1).cast("timestamp"))) | (F.col("ts_utc").isNull() if b[2] else F.lit(False)))
    own = days.select(F.col("symbol").alias("_symbol"), F.col("day").alias("_day"))
    return some.join(F.broadcast(own), F.col("symbol").eqNullSafe(F.col("_symbol")) & F.to_date("ts_utc").eqNullSafe(F.col("_day")), "left_semi")


def symbol_bounds(bars: DataFrame, ts: str = "ts_utc", by=("symbol",)) -> DataFrame:
    return bars.groupBy(*by).agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count("*").alias("rows_observed"))


def out_of_order(bars: DataFrame, order: str | list[str] = "ts_utc", by=("symbol", "timeframe")) -> DataFrame:
    """How often a bar is earlier than the one before it of its symbol. In order of ts_utc that is never; in order of ingestion it is.

    Bars are sorted over ranges of (symbol, order), so that a symbol can lie in many tasks; each task gives its counts, and
    the first and last bar of each symbol, which are compared across the ranges."""
    order, keys = [order] if isinstance(order, str) else order, list(dict.fromkeys(["symbol", *by]))
    rows = bars.where("symbol IS NOT NULL AND ts_utc IS NOT NULL")
    if order == ["ts_utc"]:
        return rows.groupBy(*by).agg(F.lit(0).cast("long").alias("out_of_order_count"))
    micros = F.unix_micros(F.col("ts_utc").cast("timestamp")).alias("at")
    dealt = rows.repartitionByRange("symbol", *order).sortWithinPartitions("symbol", *order).select(*keys, micros)
    kinds = T.StructType([*dealt.select(*keys).schema, T.StructField("part", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("first_at", T.LongType()), T.StructField("last_at", T.LongType())])

    def run(it):
        from pyspark import TaskContext

        part, held = TaskContext.get().partitionId(), None
        for b in it:
            at, symbol = b.column("at").to_numpy(), b.column("symbol")
            if not len(b):
                continue
            new = np.ones(len(b), bool)
            new[1:] = pc.not_equal(symbol.slice(1), symbol.slice(0, len(b) - 1)).to_numpy(zero_copy_only=False)
            new[0] = held is None or held[0] != symbol[0].as_py()
            before = np.concatenate([[at[0] if new[0] else held[1]], at[:-1]])
            late = (at < before) & ~new
            ends = np.append(new[1:], True)
            held = symbol[len(b) - 1].as_py(), at[-1]
            some = pa.array(late | new | ends)
            none = pa.nulls(len(b), pa.int64())
            cols = [pa.array(late.astype(np.int64)), pc.if_else(pa.array(new), b.column("at"), none), pc.if_else(pa.array(ends), b.column("at"), none)]
            yield pa.RecordBatch.from_arrays([*(b.column(k).filter(some) for k in keys), pa.array([part] * pc.sum(some).as_py(), pa.int32()), *(c.filter(some) for c in cols)], [*keys, "part", "n", "first_at", "last_at"])

    found = checkpointed(dealt.mapInArrow(run, kinds))
    firsts = found.where("first_at IS NOT NULL").select("part", "symbol", *[k for k in keys if k != "symbol"], "first_at")
    lasts = found.where("last_at IS NOT NULL").withColumn("row", F.monotonically_increasing_id()).groupBy("symbol", "part").agg(F.max_by("last_at", "row").alias("last_at"))
    place = Window.partitionBy("symbol").orderBy("part")
    across = firsts.join(lasts.withColumn("before", F.lag("last_at").over(place)).drop("last_at"), ["symbol", "part"]).where("first_at < before")
    late = found.where("n > 0").select(*by, "n").unionByName(across.select(*by, F.lit(1).cast("long").alias("n"))).groupBy(*by).agg(F.sum("n").alias("n"))
    return rows.select(*by).distinct().join(late, list(by), "left").select(*by, F.coalesce("n", F.lit(0).cast("long")).alias("out_of_order_count"))
