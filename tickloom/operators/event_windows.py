"""Bars within calendar days of dividend events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import symbol_of
from ..session import stored
from .normalize import COUNT, checked

#: Copies of an event for the buckets of its window, but for one more.
COPIES = 4
#: Bars that are broadcast at most, and rows of a range of the order if each event meets a bar a day.
BROADCAST, RANGE_ROWS = 100_000, 1 << 20
# Columns of the contract, in their order.
EVENT = ("corporate_action_id", "symbol", "corporate_action_type", "ex_date", "declaration_date", "record_date", "payable_date", "process_date", "cash_amount", "stock_amount", "currency", "source_payload_hash")
DERIVED = ("event_date_field", "event_date", "event_day_offset")
BAR = ("timeframe", "symbol", "ts", "date", "open", "high", "low", "close", "volume")
OUTPUT = (*(f"event_{c}" for c in EVENT), *DERIVED, *(f"bar_{c}" for c in BAR))
DATE_FIELDS = ("ts_utc", "timestamp", "date", "ts")
NUMBERS = {"cash_amount", "stock_amount", "open", "high", "low", "close", "volume"}


def bucket_days(pre: int, post: int) -> int:
    """Days of a bucket: a window meets COPIES + 1 at most, and no more than about a quarter of the bars that it is compared with lie outside."""
    return -(-(pre + post + 1) // COPIES)


def _bucket(day: Column, width: int) -> Column:
    return F.floor(F.unix_date(day) / width)


def _column(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else F.lit(None).cast("double" if name in NUMBERS else "string")


def event_windows(dividends: DataFrame, bars: DataFrame, pre: int = 5, post: int = 5, symbol: str | None = None, bar_date_field: str | None = None, timeframe: str = "1D", guard: str = COUNT, dealt: bool = False) -> DataFrame:
    """A row for each event and bar of its symbol from pre days before to post days after ex_date, both included.

    Dates that can't be read and blank symbols raise, before the symbol filter (see normalize.checked()); duplicates stay. The
    join is by symbol and a range of days: events are copied to the buckets of days that their window meets, COPIES + 1 at
    most for any width, so that it is an equality join on (symbol, bucket) and no symbol's bars meet in one task. The order is
    that of event_order().

    dealt: for results that are sorted. Bars are stored and events counted first; up to BROADCAST bars are sent to all tasks, and
    events are dealt to ranges of the order before they meet them, so that sorting the rows shuffles none of them."""
    if pre < 0 or post < 0:
        raise ValueError("pre and post must not be negative")
    field = bar_date_field or next((f for f in DATE_FIELDS if f in bars.columns), None)
    if field is None or field not in bars.columns:
        raise ValueError(f"bars need a date column: one of {DATE_FIELDS}")
    for c in ("corporate_action_id", "symbol", "ex_date"):
        if c not in dividends.columns:
            raise ValueError(f"dividends need {c}")
    day = F.to_date(F.try_to_timestamp(F.col("ex_date").cast("string")))
    bar_day = F.to_date(F.try_to_timestamp(F.col(field))) if dict(bars.dtypes)[field] == "string" else F.to_date(field)
    dividends = checked(dividends, (day.isNull() | symbol_of("symbol").isNull(), "{n} dividends lack a symbol or a valid ex_date"), guard=guard, carrier="symbol")
    bars = checked(bars, (bar_day.isNull() | symbol_of("symbol").isNull(), "{n} bars lack a symbol or a valid " + field), guard=guard, carrier="symbol")
    ev = dividends.select(*(_column(dividends, c).alias(f"event_{c}") for c in EVENT), day.alias("event_date")).withColumn("event_symbol", symbol_of("event_symbol"))
    br = bars.select(_column(bars, "timeframe").alias("bar_timeframe"), *(_column(bars, field if c == "ts" else c).alias(f"bar_{c}") for c in BAR if c not in ("timeframe", "date")), bar_day.alias("bar_date")).withColumn("bar_symbol", symbol_of("bar_symbol"))
    br = br.withColumn("bar_timeframe", F.coalesce("bar_timeframe", F.lit(timeframe)))
    if symbol is not None:
        ev, br = ev.where(F.col("event_symbol") == symbol.strip().upper()), br.where(F.col("bar_symbol") == symbol.strip().upper())
    width = bucket_days(pre, post)
    first, last = F.date_sub("event_date", pre), F.date_add("event_date", post)
    if dealt:
        br = stored(br)
        dealt = br.count() <= BROADCAST
    if dealt:
        ranges = max(1, -(-ev.count() * (pre + post + 1) // RANGE_ROWS))
        key = event_order()[:3]
        br = stored(br.coalesce(1).sortWithinPartitions(F.desc("bar_date"), F.desc("bar_ts")))  # lookups give the last of a key first, and rows that are almost in order are sorted sooner
        ev = ev.repartitionByRange(ranges, *key).sortWithinPartitions(*key)
    spread = ev.withColumn("event_bucket", F.explode(F.sequence(_bucket(first, width), _bucket(last, width))))
    br = br.withColumn("bar_bucket", _bucket(F.col("bar_date"), width))
    near = (F.col("event_symbol") == F.col("bar_symbol")) & (F.col("event_bucket") == F.col("bar_bucket"))
    out = spread.join(F.broadcast(br) if dealt else br, near & F.col("bar_date").between(first, last))
    return out.withColumns({"event_date_field": F.lit("ex_date"), "event_day_offset": F.datediff("bar_date", "event_date")}).select(*OUTPUT)


def event_order() -> list:
    return [F.asc_nulls_last(c) for c in ("event_symbol", "event_date", "event_corporate_action_id", "bar_date", "bar_ts")]
