"""By-symbol and global exports, statuses, gates."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import minutes_between
from .gaps import MINUTES
from .quality import any_rule, export_rule, report_rules

COUNTS = ("duplicate_rows", "duplicate_keys", "gap_count", "gap_segments", "max_gap_len", "ohlc_violation_count")


@dataclass(frozen=True)
class Thresholds:
    max_duplicate_rows: int = 0
    max_ohlc_violations: int = 0
    max_gap_count_per_symbol: int = 0
    min_coverage_pct: float = 0.99


def keyed(bars: DataFrame) -> DataFrame:
    """What all quality metrics are made of, in one pass over the bars: a row for each key with its day, n (bars), missing (minutes since
    the symbol's bar before it, within the day), and how many of its bars break each rule, any (broken), and the export's (broken_export).

    Bars are dealt by symbol and day, so that keys and gaps need no other shuffle. Null symbols have no gaps."""
    flags = {f"broken_{k}": c for k, c in report_rules().items()} | {"broken": any_rule(), "broken_export": export_rule()}
    rows = bars.select("symbol", "ts_utc", "timeframe", F.to_date("ts_utc").alias("day"), *(F.coalesce(c, F.lit(False)).cast("long").alias(k) for k, c in flags.items()))
    keys = rows.repartition("symbol", "day").groupBy("symbol", "day", "ts_utc", "timeframe").agg(F.count("*").alias("n"), *(F.sum(k).alias(k) for k in flags))
    before = F.lag("ts_utc").over(Window.partitionBy("symbol", "day").orderBy("ts_utc"))
    missing = F.when(F.col("symbol").isNull(), 0).otherwise(F.greatest(F.coalesce(minutes_between(before, "ts_utc") - 1, F.lit(0)), F.lit(0)))
    return keys.withColumn("missing", missing)


def qa_by_symbol(bars: DataFrame, expected: int | Column, gaps: DataFrame | None = None) -> DataFrame:
    """Bounds with duplicates, violations and gaps of each symbol, in one pass over the bars. Null symbols form a group without minute gaps.

    gaps: symbol and its gaps, in place of minute gaps; expected: bars that a symbol should have."""
    return by_symbol_of(keyed(bars), expected, gaps)


def by_symbol_of(keys: DataFrame, expected: int | Column, gaps: DataFrame | None = None) -> DataFrame:
    """qa_by_symbol() of the rows of keyed()."""
    keys = keys if gaps is None else keys.withColumn("missing", F.lit(0))
    out = keys.groupBy("symbol").agg(
        F.min("ts_utc").alias("first_ts"), F.max("ts_utc").alias("last_ts"), F.sum("n").alias("rows_observed"), F.count_if(F.col("n") > 1).alias("duplicate_keys"), F.sum(F.col("n") - 1).alias("duplicate_rows"),
        F.sum("broken_export").alias("ohlc_violation_count"), F.sum("missing").alias("gap_count"), F.count_if(F.col("missing") > 0).alias("gap_segments"), F.max("missing").alias("max_gap_len"),
    )
    if gaps is not None:
        side = gaps.withColumnRenamed("symbol", "of")
        out = out.drop("gap_count", "gap_segments", "max_gap_len").join(side, F.col("symbol").eqNullSafe(F.col("of")), "left").drop("of")
    out = out.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in COUNTS}).withColumn("expected_bars", (expected if isinstance(expected, Column) else F.lit(expected)).cast("long"))
    return out.withColumn("coverage_pct", F.when(F.col("expected_bars") > 0, F.col("rows_observed") / F.col("expected_bars")).otherwise(0.0))


def qa_global(by_symbol: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """One row of totals with PASS, WARN or FAIL; an empty input passes with zeros."""
    below = F.col("coverage_pct") < t.min_coverage_pct
    zero = F.lit(0).cast("long")
    total = by_symbol.agg(
        F.coalesce(F.sum("rows_observed"), zero).alias("total_rows"), F.coalesce(F.sum("duplicate_rows"), zero).alias("duplicate_rows"), F.coalesce(F.sum("duplicate_keys"), zero).alias("total_duplicate_keys"),
        F.count("*").alias("symbols_present"), F.coalesce(F.sum("gap_count"), zero).alias("total_gap_count"), F.coalesce(F.sum("ohlc_violation_count"), zero).alias("total_ohlc_violation_count"),
        F.coalesce(F.avg(F.when(below, 1.0).otherwise(0.0)), F.lit(0.0)).alias("pct_below"), F.coalesce(F.max(below | (F.col("gap_count") > t.max_gap_count_per_symbol)), F.lit(False)).alias("warn"),
    )
    fail = (F.col("duplicate_rows") > t.max_duplicate_rows) | (F.col("total_ohlc_violation_count") > t.max_ohlc_violations)
    return total.withColumn("unique_rows", F.col("total_rows") - F.col("duplicate_rows")).withColumn("overall_status", F.when(fail, "FAIL").when(F.col("warn"), "WARN").otherwise("PASS")).drop("warn")


def run_id(dataset: str, interval: str, start: str | None = None, end: str | None = None, calendar: str = "XNYS") -> str:
    """The name of a quality run: equal for equal settings."""
    return f"qa_{dataset}_{interval}_{start or 'ALL'}_{end or 'ALL'}_{calendar}"


def handoff_status(status: str | Column = "overall_status") -> Column:
    """What a run's status tells the next system; any other text is just available."""
    own = F.upper(F.trim(F.col(status) if isinstance(status, str) else status))
    return F.when(own == "PASS", "passed").when(own == "FAIL", "failed").when(own.isin("WARN", "WARNING"), "warning").otherwise("available")


def qa_summary(bars: DataFrame) -> DataFrame:
    """By symbol and timeframe: bounds, and the symbol's duplicate keys, sum of rule counts, missing minutes and inversions, in one pass over the bars.

    Inversions in the order of time are none by definition. Null symbols form a group with bounds alone."""
    return summary_of(keyed(bars))


def summary_of(keys: DataFrame) -> DataFrame:
    """qa_summary() of the rows of keyed()."""
    broken = sum((F.sum(f"broken_{k}") for k in report_rules()), F.lit(0))
    days = keys.groupBy("symbol", "day", "timeframe").agg(
        F.min("ts_utc").alias("min_ts"), F.max("ts_utc").alias("max_ts"), F.sum("n").alias("row_count"), F.count_if(F.col("n") > 1).alias("duplicate_keys"), broken.alias("ohlc_violation_count"),
    )
    day, own = Window.partitionBy("symbol", "day"), Window.partitionBy("symbol")
    missing = F.when(F.row_number().over(day.orderBy("timeframe")) == 1, F.greatest(F.lit(MINUTES) - F.sum("row_count").over(day), F.lit(0))).otherwise(0)
    out = days.withColumn("gap_count", missing).groupBy("symbol", "timeframe").agg(F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts"), *(F.sum(c).alias(c) for c in ("row_count", "duplicate_keys", "ohlc_violation_count", "gap_count")))
    named = F.col("symbol").isNotNull()
    return out.withColumns({c: F.when(named, F.sum(c).over(own)).otherwise(0).cast("long") for c in ("duplicate_keys", "ohlc_violation_count", "gap_count")}).withColumn("out_of_order_count", F.lit(0).cast("long"))


def top_offenders(by_symbol: DataFrame, n: int = 10) -> DataFrame:
    keys = ("duplicate_keys", "ohlc_violation_count", "gap_count")
    return by_symbol.where(" OR ".join(f"{k} > 0" for k in keys)).orderBy(*(F.desc(k) for k in keys), "symbol").limit(n).select("symbol", *keys)


def missing_symbols(bars: DataFrame, expected: DataFrame) -> DataFrame:
    gone = expected.join(bars.select("symbol").distinct(), "symbol", "left_anti")
    return gone.agg(F.array_join(F.array_sort(F.collect_list("symbol")), ";").alias("symbols_missing"), F.count("*").alias("n_missing"))


@dataclass(frozen=True)
class Gates:
    max_duplicate_keys: int = 0
    max_ohlc_violations: int = 0
    min_coverage_pct: float | None = None
    max_gap_count: int | None = None
    allow_missing_symbols: bool = True


@dataclass(frozen=True)
class Verdict:
    passed: bool
    reasons: list[str] = field(default_factory=list)
    offenders: list[dict] = field(default_factory=list)

    @property
    def exit_code(self) -> int:
        return 0 if self.passed else 1


def enforce(by_symbol: DataFrame, gates: Gates = Gates(), missing: list[str] | None = None, top: int = 10) -> Verdict:
    """Whether the totals stay within the gates; one row and the top offenders reach the driver."""
    m = by_symbol.agg(F.sum("duplicate_keys").alias("dup"), F.sum("ohlc_violation_count").alias("ohlc"), F.sum("gap_count").alias("gap"), F.min("coverage_pct").alias("cov")).first()
    reasons = []
    for name, value, most in (("duplicate_keys", m.dup or 0, gates.max_duplicate_keys), ("ohlc_violations", m.ohlc or 0, gates.max_ohlc_violations), ("gap_count", m.gap or 0, gates.max_gap_count)):
        if most is not None and value > most:
            reasons.append(f"{name}={value} > {most}")
    if gates.min_coverage_pct is not None and m["cov"] is not None and m["cov"] < gates.min_coverage_pct:
        reasons.append(f"min_coverage={m['cov']} < {gates.min_coverage_pct}")
    if missing and not gates.allow_missing_symbols:
        reasons.append("missing_symbols=" + ";".join(sorted(missing)))
    return Verdict(not reasons, reasons, [r.asDict() for r in top_offenders(by_symbol, top).collect()] if reasons else [])


__all__ = ["Gates", "Thresholds", "Verdict", "enforce", "export_rule", "handoff_status", "missing_symbols", "qa_by_symbol", "qa_global", "qa_summary", "report_rules", "run_id", "top_offenders"]
