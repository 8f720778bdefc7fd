"""Gaps and coverage against calendars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendars import EXCHANGES, KNOWN, at_utc, exchange, is_session, minute, session_minutes
from ..functions.columns import minutes_between, sessions

MINUTES = 390
FALLBACK_NOTE = "calendar_fallback=WEEKDAY"


def _sum(rows: str | None) -> Column:
    return F.sum(F.lit(1) if rows is None else rows)


def minute_gaps(bars: DataFrame) -> DataFrame:
    """symbol, gap_count (missing minutes), gap_segments, max_gap_len; gaps end with the day."""
    rows = bars.where("symbol IS NOT NULL AND ts_utc IS NOT NULL").withColumn("day", F.to_date("ts_utc"))
    before = F.lag("ts_utc").over(Window.partitionBy("symbol", "day").orderBy("ts_utc"))
    missing = F.greatest(F.coalesce(minutes_between("before", "ts_utc") - 1, F.lit(0)), F.lit(0))
    steps = rows.withColumn("before", before).withColumn("missing", missing)
    return steps.groupBy("symbol").agg(F.sum("missing").alias("gap_count"), F.count_if(F.col("missing") > 0).alias("gap_segments"), F.max("missing").alias("max_gap_len"))


def minute_gaps_by_day(bars: DataFrame, expected: int = MINUTES, rows: str | None = None) -> DataFrame:
    """rows: a column that tells how many bars a row stands for."""
    days = bars.where("symbol IS NOT NULL").groupBy("symbol", F.to_date("ts_utc").alias("date")).agg(_sum(rows).cast("long").alias("actual_minutes"))
    return days.withColumn("missing_minutes", F.greatest(F.lit(expected) - F.col("actual_minutes"), F.lit(0)))


def minute_gap_rollup(bars: DataFrame) -> DataFrame:
    return minute_gaps_by_day(bars).groupBy("symbol").agg(F.sum("missing_minutes").alias("gap_count"))


def daily_gaps_by_symbol(bars: DataFrame, day: str = "d") -> DataFrame:
    """Weekdays between a symbol's first and last day against its days."""
    spans = bars.where("symbol IS NOT NULL").groupBy("symbol").agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"), F.countDistinct(day).alias("actual_days"))
    return spans.withColumn("expected_days", F.size(sessions("min_date", "max_date")).cast("long")).withColumn("missing_days", F.greatest(F.col("expected_days") - F.col("actual_days"), F.lit(0)))


def weekday_calendar(spark, start: str, end: str) -> DataFrame:
    """session_date and its index idx."""
    return spark.range(1).select(F.posexplode(sessions(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("idx", "session_date"))


def calendar(spark, mode: str, start: str, end: str) -> DataFrame:
    """Sessions of a calendar from start to end, both included: session_date, its index idx, and its minutes."""
    days, _ = expected_days(mode, start, end)
    return spark.range(1).select(F.posexplode(days).alias("idx", "session_date")).withColumn("minutes", session_minutes(F.col("session_date"), mode))


def daily_gaps(bars: DataFrame, calendar: DataFrame, day: str = "d") -> DataFrame:
    """symbol, gap_count, gap_segments, max_gap_len: runs of sessions that a symbol misses.

    The calendar is a dimension of at most some thousand days, one array for all symbols; a symbol's days are a set of no
    more. A run is of missing sessions whose idx less their place among the missing ones is the same."""
    sessions_ = calendar.agg(F.array_sort(F.collect_list(F.struct("idx", "session_date")))).scalar()
    seen = bars.where("symbol IS NOT NULL").groupBy("symbol").agg(F.collect_set(F.col(day).cast("date")).alias("days"))
    missing = F.filter(F.col("all"), lambda s: ~F.array_contains("days", s["session_date"]))
    rows = seen.withColumn("all", sessions_).select("symbol", F.transform(missing, lambda s, i: (s["idx"] - i).cast("long")).alias("runs"))
    start = F.struct(F.lit(None).cast("long").alias("run"), F.lit(0).cast("long").alias("len"), F.lit(0).cast("long").alias("most"))

    def step(s, run):
        n = F.when(s["run"].eqNullSafe(run), s["len"] + 1).otherwise(F.lit(1).cast("long"))
        return F.struct(run.alias("run"), n.alias("len"), F.greatest(s["most"], n).alias("most"))

    longest = F.aggregate("runs", start, step)["most"]
    return rows.select("symbol", F.size("runs").cast("long").alias("gap_count"), F.size(F.array_distinct("runs")).cast("long").alias("gap_segments"), longest.alias("max_gap_len"))


def expected_days(mode: str, start: str, end: str) -> tuple[Column, str | None]:
    """The days that a calendar mode expects, none if the end comes first; a note if the mode isn't known: weekdays stand in."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    days = F.when(first <= last, F.sequence(first, F.greatest(first, last))).otherwise(F.array().cast("array<date>"))
    return F.filter(days, lambda d: is_session(d, mode)), None if mode.strip().upper() in KNOWN else FALLBACK_NOTE


def coverage(bars: DataFrame, expected: DataFrame, mode: str, start: str, end: str, day: str = "d", rows: str | None = None) -> DataFrame:
    """Each expected symbol's days between start and end, both included; symbols without rows are listed too.

    bars: symbol and day, of which each stands for as many bars as its column `rows` tells; expected: symbol. coverage_days_pct is null if no day is expected."""
    days, note = expected_days(mode, start, end)
    inside = bars.where(F.col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    seen = inside.groupBy("symbol").agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"), _sum(rows).cast("long").alias("rows_total"), F.countDistinct(day).alias("observed_days"))
    zero = F.lit(0).cast("long")
    out = expected.join(seen, "symbol", "left").withColumns({"rows_total": F.coalesce("rows_total", zero), "observed_days": F.coalesce("observed_days", zero), "expected_days": F.size(days).cast("long")})
    missing = F.greatest(F.col("expected_days") - F.col("observed_days"), zero)
    notes = F.concat_ws("; ", F.when(F.col("rows_total") == 0, "NO_ROWS"), F.when(missing > 0, F.concat(F.lit("missing_days="), missing.cast("string"))), F.lit(note))
    return out.select(
        "symbol", "min_date", "max_date", "rows_total", "expected_days", "observed_days", missing.alias("missing_day_count"),
        F.when(F.col("expected_days") > 0, F.col("observed_days") / F.col("expected_days")).alias("coverage_days_pct"), notes.alias("notes"),
    )


def expected_bars(spark, start: str, end: str, minutes: int | None = None, mode: str = "WEEKDAY") -> DataFrame:
    """Sessions between start and end (excluded) and the minutes that they hold; with minutes, all sessions are of that length."""
    days, _ = expected_days(mode, start, F.date_sub(F.lit(end).cast("date"), 1))
    each = F.transform(days, lambda d: session_minutes(d, mode) if minutes is None else F.lit(minutes))
    return spark.range(1).select(F.size(days).cast("long").alias("daily_bars"), F.aggregate(each, F.lit(0).cast("long"), lambda a, m: a + m).alias("minute_bars"))


#: Days of exchanges' calendars up to which they are broadcast after they were counted: some hundred bytes each.
CALENDAR_DAYS = 200_000


def exchange_sessions(spark, start: str, end: str, exchanges: tuple[str, ...] = tuple(EXCHANGES)) -> DataFrame:
    """The calendar dimension: exchange, session_date, idx (its place in the exchange's sessions from start), open_utc,
    close_utc, break_start_utc and break_end_utc (null where trading goes on), minutes and traded_minutes (without the
    break), of sessions from start to end, both included. An exchange that isn't known raises."""
    parts = []
    for name in exchanges:
        if (of := exchange(name)) is None:
            raise ValueError(f"no calendar of {name}")
        days, _ = expected_days(name, start, end)
        rows, d = spark.range(1).select(F.posexplode(days).alias("idx", "session_date")), F.col("session_date")
        rests = [at_utc(d, minute(x), of.zone) for x in of.break_] if of.break_ else [F.lit(None).cast("timestamp")] * 2
        parts.append(rows.select(
            F.lit(name).alias("exchange"), "session_date", "idx", at_utc(d, minute(of.opens), of.zone).alias("open_utc"), at_utc(d, of.close(d), of.zone).alias("close_utc"), rests[0].alias("break_start_utc"), rests[1].alias("break_end_utc"),
            session_minutes(d, name).alias("minutes"), session_minutes(d, name, breaks=False).alias("traded_minutes"),
        ))
    return reduce(DataFrame.unionByName, parts)


def _small(calendar: DataFrame) -> DataFrame:
    return F.broadcast(calendar) if calendar.count() <= CALENDAR_DAYS else calendar


def exchange_coverage(bars: DataFrame, listing: DataFrame, calendar: DataFrame, day: str = "d") -> DataFrame:
    """Days of each listed symbol against its exchange's sessions in the calendar (see exchange_sessions()).

    listing: symbol and exchange, a row for each symbol. observed_days are sessions with bars; off_session_days days with bars
    between the calendar's first and last day that are no session. A symbol whose exchange has no sessions expects none, with a
    note; one without rows is listed too. coverage_days_pct is null if no day is expected."""
    per = calendar.groupBy("exchange").agg(F.count("*").alias("expected_days"))
    first, last = calendar.agg(F.min("session_date"), F.max("session_date")).first()
    days = bars.where(F.col(day).between(F.lit(first), F.lit(last))).groupBy("symbol", F.col(day).cast("date").alias("session_date")).agg(F.count("*").alias("n"))
    named = listing.select("symbol", "exchange")
    met = days.join(named, "symbol").join(_small(calendar.select("exchange", "session_date", F.lit(True).alias("open"))), ["exchange", "session_date"], "left")
    seen = met.groupBy("symbol").agg(F.sum("n").alias("rows_total"), F.count_if(F.col("open")).alias("observed_days"), F.count_if(F.col("open").isNull()).alias("off_session_days"))
    out = named.join(F.broadcast(per), "exchange", "left").join(seen, "symbol", "left")  # per: a row for each exchange
    zero = F.lit(0).cast("long")
    counts = {c: F.coalesce(c, zero) for c in ("rows_total", "observed_days", "off_session_days")} | {"unknown": F.col("expected_days").isNull(), "expected_days": F.coalesce("expected_days", zero)}
    out = out.withColumns(counts).withColumn("missing_day_count", F.col("expected_days") - F.col("observed_days"))
    notes = F.concat_ws("; ", F.when(F.col("rows_total") == 0, "NO_ROWS"), F.when(F.col("missing_day_count") > 0, F.concat(F.lit("missing_days="), F.col("missing_day_count").cast("string"))), F.when(F.col("unknown"), "no_calendar"))
    pct = F.when(F.col("expected_days") > 0, F.col("observed_days") / F.col("expected_days")).alias("coverage_days_pct")
    return out.select("symbol", "exchange", "rows_total", "expected_days", "observed_days", "missing_day_count", "off_session_days", pct, notes.alias("notes"))


def exchange_minutes(bars: DataFrame, listing: DataFrame, calendar: DataFrame) -> DataFrame:
    """Minutes of each listed symbol against its exchange's trading hours in the calendar: symbol, exchange, sessions,
    expected_minutes (without breaks), observed_minutes (with bars, while trading goes on), outside_minutes (with bars at other
    times between the calendar's first open and last close).

    Minutes meet sessions by the UTC days that these touch, then by their times, so that no symbol's bars gather in one task."""
    span = calendar.agg(F.min("open_utc"), F.max("close_utc")).first()
    within = (F.col("ts_utc") >= F.lit(span[0])) & (F.col("ts_utc") < F.lit(span[1]))
    minutes = bars.where(within).select("symbol", F.date_trunc("minute", "ts_utc").alias("at")).distinct().withColumn("day", F.to_date("at"))
    touched = calendar.select("exchange", "open_utc", "close_utc", "break_start_utc", "break_end_utc", F.explode(F.sequence(F.to_date("open_utc"), F.to_date("close_utc"))).alias("day"))
    rests = F.coalesce((F.col("at") >= F.col("break_start_utc")) & (F.col("at") < F.col("break_end_utc")), F.lit(False))
    trading = (F.col("at") >= F.col("open_utc")) & (F.col("at") < F.col("close_utc")) & ~rests
    named = listing.select("symbol", "exchange")
    inside = minutes.join(named, "symbol").join(_small(touched), ["exchange", "day"]).where(trading).groupBy("symbol").agg(F.count("*").alias("observed"))
    every = minutes.groupBy("symbol").agg(F.count("*").alias("every"))
    per = calendar.groupBy("exchange").agg(F.count("*").alias("sessions"), F.sum("traded_minutes").cast("long").alias("expected_minutes"))
    zero = F.lit(0).cast("long")
    out = named.join(F.broadcast(per), "exchange", "left").join(every, "symbol", "left").join(inside, "symbol", "left")
    observed = F.coalesce("observed", zero)
    return out.select("symbol", "exchange", F.coalesce("sessions", zero).alias("sessions"), F.coalesce("expected_minutes", zero).alias("expected_minutes"), observed.alias("observed_minutes"), (F.coalesce("every", zero) - observed).alias("outside_minutes"))
