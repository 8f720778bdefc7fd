"""Raw bars to canonical bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import BAR, BAR_KEY

PRICES = ("open", "high", "low", "close")
REQUIRED = ("timestamp", *PRICES, "volume")


#: How a guard works: an action that counts bad rows before the lazy result, or an error of the first bad row that a task meets, in one scan.
COUNT, PLAN = "count", "plan"


def checked(df: DataFrame, *rules: tuple[Column, str], guard: str = COUNT, carrier: str | None = None) -> DataFrame:
    """df, guarded against rows that break a rule (bad, message).

    COUNT: one action counts them and raises ValueError for the first rule that has any. PLAN: the carrier, a column that what
    follows needs, raises when a bad row is met; df is scanned once, with its result."""
    if guard == COUNT:
        counts = df.agg(*(F.count_if(bad).alias(f"n{i}") for i, (bad, _) in enumerate(rules))).first()
        for n, (_, message) in zip(counts, rules, strict=True):
            if n:
                raise ValueError(message.format(n=n))
        return df
    if guard != PLAN or carrier is None:
        raise ValueError(f"unknown guard {guard}")
    own = F.col(carrier)
    for bad, message in reversed(rules):
        own = F.when(bad, F.raise_error(F.lit(message.format(n="some")))).otherwise(own)
    return df.withColumn(carrier, own)


def with_errors(df: DataFrame, *rules: tuple[Column, str], errors: str = "errors") -> DataFrame:
    """df with an array of the messages of the rules that each row breaks: filter it for a clean and a quarantine table, without a guard."""
    return df.withColumn(errors, F.array_compact(F.array(*(F.when(bad, F.lit(message.format(n="this").strip())) for bad, message in rules))))


def keep_last(df: DataFrame, key=BAR_KEY, ordinal: str = "ordinal") -> DataFrame:
    """The row with the greatest ordinal of each key, null ordinals last; null keys are keys."""
    place = F.struct(F.col(ordinal).isNotNull(), F.col(ordinal))
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), place).alias("row_")).select(*key, "row_.*").select(*df.columns)


def normalize_bars(raw: DataFrame, symbol: str | Column, source: str, timeframe: str, ordinal: str = "ordinal", strict: bool = True, guard: str = COUNT) -> DataFrame:
    """Canonical bars with year and date: text becomes numbers, rows without a full price are dropped, the last of a key stays.

    raw needs timestamp, open, high, low, close, volume and an ordinal of ingestion. strict: a timestamp that can't be read raises."""
    missing = [c for c in (*REQUIRED, ordinal) if c not in raw.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    ts = F.try_to_timestamp(F.col("timestamp")) if dict(raw.dtypes)["timestamp"] == "string" else F.col("timestamp").cast("timestamp")
    df = raw.withColumn("ts_utc", ts)
    if strict:
        df = checked(df, (F.col("ts_utc").isNull(), "{n} timestamps can't be parsed"), guard=guard, carrier="ts_utc")
    symbol = F.lit(symbol) if isinstance(symbol, str) else symbol
    number = {c: F.expr(f"try_cast({c} AS double)") for c in PRICES}
    volume = F.coalesce(F.expr("try_cast(try_cast(volume AS double) AS bigint)"), F.lit(0)).cast("long")
    df = df.withColumns({"symbol": symbol, "source": F.lit(source), "timeframe": F.lit(timeframe), **number, "volume": volume})
    full = F.lit(True)
    for c in PRICES:
        full = full & F.col(c).isNotNull() & ~F.isnan(c)
    df = keep_last(df.where(full), BAR_KEY, ordinal)
    return df.withColumns({"year": F.year("ts_utc"), "date": F.date_format("ts_utc", "yyyy-MM-dd")}).select(*BAR.names)
