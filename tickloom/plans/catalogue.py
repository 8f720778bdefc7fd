"""The queries over bars and dividends derived from the driver's tables, and their SQL for DuckDB."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import partitions_of, sessions, utc_text
from ..operators import dividends as dv
from ..operators import event_windows as ew
from ..operators import gaps, inventory, normalize, quality, rollup, shards
from ..schemas import BAR
from ..session import shared_dir
from ..sources import footers, listing, tables
from . import composites
from .views import END, START, YEAR_END, YEAR_START, base_table, view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
UNIVERSE = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "9-ABSENT"]
MINUTE_UNIVERSE = ["ABSENT"]


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def bars(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "bars_1m")


def daily(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "bars_daily")


def dividends(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "dividends")


B = with_views("bars_1m") + ", b AS (SELECT * FROM bars_1m)"
D = with_views("bars_daily") + ", b AS (SELECT * FROM bars_daily)"
V = with_views("dividends")
RULES = {
    "high_lt_open_close": "high < greatest(open, close)", "low_gt_open_close": "low > least(open, close)", "nonpositive_price": "(open <= 0 OR high <= 0 OR low <= 0 OR close <= 0)",
    "negative_volume": "volume < 0", "null_required": "(symbol IS NULL OR ts_utc IS NULL OR timeframe IS NULL OR open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL)",
}
EXPORT = " OR ".join(v for k, v in RULES.items() if k != "null_required") + " OR high < low"
KEYS = "k AS (SELECT symbol, ts_utc, timeframe, count(*) AS n FROM b GROUP BY ALL)"
DUPS = "SELECT symbol, count(*) FILTER (n > 1) AS duplicate_keys, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM k GROUP BY symbol"
STEPS = "s AS (SELECT symbol, ts_utc, lag(ts_utc) OVER (PARTITION BY symbol, CAST(ts_utc AS DATE) ORDER BY ts_utc) AS p FROM b), g AS (SELECT symbol, greatest(coalesce(datediff('minute', p, ts_utc) - 1, 0), 0) AS m FROM s)"
GAPS = "SELECT symbol, CAST(sum(m) AS BIGINT) AS gap_count, count(*) FILTER (m > 0) AS gap_segments, max(m) AS max_gap_len FROM g GROUP BY symbol"
DAYS = "SELECT symbol, CAST(ts_utc AS DATE) AS date, count(*) AS actual_minutes, greatest(390 - count(*), 0) AS missing_minutes FROM b GROUP BY ALL"
BROKEN = " UNION ALL ".join(f"SELECT '{k}' AS rule, * FROM b WHERE {v}" for k, v in RULES.items())
#: Minutes of the weekdays from the first to the last day of the bars.
EXPECTED = f"(SELECT {gaps.MINUTES} * len(list_filter(generate_series(CAST(min(ts_utc) AS DATE), CAST(max(ts_utc) AS DATE), INTERVAL 1 DAY), lambda t: isodow(t) < 6)) FROM b)"
BY_SYMBOL = f"""{KEYS}, dup AS ({DUPS}), {STEPS}, gap AS ({GAPS}), o AS (SELECT symbol, count(*) AS n FROM b WHERE {EXPORT} GROUP BY symbol),
a AS (SELECT symbol, min(ts_utc) AS first_ts, max(ts_utc) AS last_ts, count(*) AS rows_observed FROM b GROUP BY symbol),
n_bars AS (SELECT CAST({EXPECTED} AS BIGINT) AS n_expected),
q AS (SELECT symbol, first_ts, last_ts, rows_observed, duplicate_keys, duplicate_rows, gap_count, gap_segments, max_gap_len, coalesce(o.n, 0) AS ohlc_violation_count,
 n_expected AS expected_bars, rows_observed / n_expected AS coverage_pct FROM a JOIN dup USING (symbol) JOIN gap USING (symbol) LEFT JOIN o USING (symbol), n_bars)"""


@_query(f"{B}, {KEYS} {DUPS}")
def dup_by_symbol(spark, d):
    return quality.duplicates_by_symbol(bars(spark, d))


@_query(f"{B}, {KEYS} SELECT symbol, ts_utc, timeframe, n AS row_count FROM k WHERE n > 1")
def dup_keys_detail(spark, d):
    return quality.duplicate_keys(bars(spark, d))


@_query(f"{B}, {KEYS}, x AS ({DUPS}) SELECT * FROM x WHERE duplicate_keys > 0 AND symbol IS NOT NULL")
def dup_rollup(spark, d):
    return quality.duplicates_rollup(bars(spark, d))


@_query(f"{B} SELECT symbol, count(*) AS ohlc_violation_count FROM b WHERE {EXPORT} GROUP BY symbol")
def ohlc_by_symbol(spark, d):
    return quality.violations_by_symbol(bars(spark, d))


@_query(f"{B} SELECT rule, symbol, count(*) AS violation_count FROM ({BROKEN}) GROUP BY ALL")
def ohlc_by_rule_symbol(spark, d):
    return quality.violations_by_rule(bars(spark, d))


@_query(f"{B} SELECT count(*) AS violation_count FROM b WHERE {' OR '.join(RULES.values())}")
def ohlc_total(spark, d):
    return quality.violations_total(bars(spark, d))


@_query(f"{B} SELECT rule, symbol, ts_utc, event_id, sample FROM (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY symbol, ts_utc, event_id) AS sample FROM ({BROKEN})) WHERE sample <= 5")
def ohlc_samples(spark, d):
    return quality.violation_samples(bars(spark, d), 5, ["symbol", "ts_utc", "event_id"]).select("rule", "symbol", "ts_utc", "event_id", "sample")


@_query(f"{B}, {STEPS} {GAPS}")
def gap_1m_metrics(spark, d):
    return gaps.minute_gaps(bars(spark, d))


@_query(f"{B} {DAYS}")
def gap_1m_approx(spark, d):
    return gaps.minute_gaps_by_day(bars(spark, d))


@_query(f"{B} SELECT symbol, CAST(sum(missing_minutes) AS BIGINT) AS gap_count FROM ({DAYS}) GROUP BY symbol")
def gap_1m_rollup(spark, d):
    return gaps.minute_gap_rollup(bars(spark, d))


CALENDAR = "c AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS idx FROM (SELECT CAST(unnest(generate_series((SELECT min(d) FROM b), (SELECT max(d) FROM b), INTERVAL 1 DAY)) AS DATE) AS day) WHERE isodow(day) < 6)"


@_query(f"""{D}, {CALENDAR}, sy AS (SELECT DISTINCT symbol FROM b), m AS (SELECT symbol, idx, idx - row_number() OVER (PARTITION BY symbol ORDER BY idx) AS run FROM sy, c
WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.symbol = sy.symbol AND b.d = c.day)), r AS (SELECT symbol, run, count(*) AS n FROM m GROUP BY ALL)
SELECT sy.symbol, CAST(coalesce(sum(n), 0) AS BIGINT) AS gap_count, count(n) AS gap_segments, coalesce(max(n), 0) AS max_gap_len FROM sy LEFT JOIN r USING (symbol) GROUP BY sy.symbol""")
def gap_daily_islands(spark, d):
    own = daily(spark, d)
    ends = own.agg(gaps.sessions(F.min("d"), F.max("d")).alias("days"))
    return gaps.daily_gaps(own, ends.select(F.posexplode("days").alias("idx", "session_date")))


# Holidays of the New York exchange in the years of the derived tables.
CLOSED_DAYS = ["1996-01-01", "1996-02-19", "1996-04-05", "1996-05-27", "1996-07-04", "1996-09-02", "1996-11-28", "1996-12-25"]
CLOSED_2024 = ["2024-01-01", "2024-01-15", "2024-02-19", "2024-03-29", "2024-05-27", "2024-06-19", "2024-07-04", "2024-09-02", "2024-11-28", "2024-12-25"]
SHORT_2024 = ["2024-07-03", "2024-11-29", "2024-12-24"]
YEAR = CALENDAR.replace("(SELECT min(d) FROM b)", f"DATE '{YEAR_START}'").replace("(SELECT max(d) FROM b)", f"DATE '{YEAR_END}'")
EXCHANGE = YEAR.replace("isodow(day) < 6", f"isodow(day) < 6 AND strftime(day, '%Y-%m-%d') NOT IN ({', '.join(map(repr, CLOSED_DAYS))})")


@_query(ORACLES["gap_daily_islands"].replace(CALENDAR, EXCHANGE))
def gap_daily_exchange(spark, d):
    return gaps.daily_gaps(daily(spark, d), gaps.calendar(spark, "XNYS", YEAR_START, YEAR_END))


@_query(f"""{D}, w AS (SELECT * FROM b WHERE isodow(d) < 6), x AS (SELECT symbol, min(d) AS min_date, max(d) AS max_date, count(DISTINCT d) AS actual_days FROM w GROUP BY symbol),
y AS (SELECT *, len(list_filter(generate_series(min_date, max_date, INTERVAL 1 DAY), lambda t: isodow(t) < 6)) AS expected_days FROM x) SELECT *, greatest(expected_days - actual_days, 0) AS missing_days FROM y""")
def gap_daily_approx(spark, d):
    return gaps.daily_gaps_by_symbol(daily(spark, d).where(F.weekday("d") < 5))


ORDERED = "SELECT symbol, timeframe, count(*) FILTER (ts_utc < p) AS out_of_order_count FROM (SELECT *, lag(ts_utc) OVER (PARTITION BY symbol ORDER BY {0}) AS p FROM b) GROUP BY ALL"


@_query(f"{B} {ORDERED.format('ts_utc')}")
def out_of_order(spark, d):
    return quality.out_of_order(bars(spark, d))


@_query(f"{B} {ORDERED.format('(event_id * 7919) % 10007, event_id')}")
def out_of_order_ingest(spark, d):
    return quality.out_of_order(bars(spark, d).withColumn("place", F.expr("(event_id * 7919) % 10007")), ["place", "event_id"])


BOUNDS = "SELECT {0}, min({1}) AS first_ts, max({1}) AS last_ts, count(*) AS rows_observed FROM b GROUP BY {0}"


@_query(f"{B} {BOUNDS.format('symbol', 'ts_utc')}")
def symbol_bounds(spark, d):
    return quality.symbol_bounds(bars(spark, d))


@_query(f"{B} {BOUNDS.format('symbol, timeframe', 'ts_utc')}")
def dataset_summary(spark, d):
    return quality.symbol_bounds(bars(spark, d), by=("symbol", "timeframe"))


@_query(f"{D} {BOUNDS.format('symbol', 'd')}")
def symbol_bounds_daily(spark, d):
    return quality.symbol_bounds(daily(spark, d), "d")


def _coverage_sql(base: str, day: str, universe: list[str], start: str, end: str, days: str) -> str:
    symbols = ", ".join(f"('{s}')" for s in universe)
    return f"""{base}, e AS (SELECT * FROM (VALUES {symbols}) t(symbol)), n AS (SELECT {days} AS expected_days),
s AS (SELECT symbol, min({day}) AS min_date, max({day}) AS max_date, count(*) AS rows_total, count(DISTINCT {day}) AS observed_days FROM b WHERE {day} BETWEEN DATE '{start}' AND DATE '{end}' GROUP BY symbol),
j AS (SELECT symbol, min_date, max_date, coalesce(rows_total, 0) AS rows_total, expected_days, coalesce(observed_days, 0) AS observed_days FROM e LEFT JOIN s USING (symbol), n)
SELECT *, greatest(expected_days - observed_days, 0) AS missing_day_count, observed_days / expected_days AS coverage_days_pct,
 concat_ws('; ', CASE WHEN rows_total = 0 THEN 'NO_ROWS' END, CASE WHEN observed_days < expected_days THEN 'missing_days=' || (expected_days - observed_days) END) AS notes FROM j"""


@_query(_coverage_sql(D, "d", UNIVERSE, YEAR_START, YEAR_END, f"(SELECT count(*) FROM (SELECT unnest(generate_series(DATE '{YEAR_START}', DATE '{YEAR_END}', INTERVAL 1 DAY)) AS t) WHERE isodow(t) < 6)"))
def coverage_by_symbol(spark, d):
    expected = spark.range(1).select(F.explode(F.array(*map(F.lit, UNIVERSE))).alias("symbol"))
    return gaps.coverage(daily(spark, d), expected, "WEEKDAY", YEAR_START, YEAR_END)


@_query(_coverage_sql(D, "d", UNIVERSE, YEAR_START, YEAR_END, f"(SELECT count(*) - {len(CLOSED_DAYS)} FROM (SELECT unnest(generate_series(DATE '{YEAR_START}', DATE '{YEAR_END}', INTERVAL 1 DAY)) AS t) WHERE isodow(t) < 6)"))
def coverage_exchange(spark, d):
    expected = spark.range(1).select(F.explode(F.array(*map(F.lit, UNIVERSE))).alias("symbol"))
    return gaps.coverage(daily(spark, d), expected, "XNYS", YEAR_START, YEAR_END)


@_query(_coverage_sql(B, "CAST(ts_utc AS DATE)", ["CLICK", "VIEW", "PURCHASE", "ABSENT"], START, END, "CAST(16 AS BIGINT)"))
def coverage_all_days(spark, d):
    expected = spark.range(1).select(F.explode(F.array(*map(F.lit, ["CLICK", "VIEW", "PURCHASE", "ABSENT"]))).alias("symbol"))
    return gaps.coverage(bars(spark, d).withColumn("d", F.to_date("ts_utc")), expected, "ALL_DAYS", START, END)


def _observed(spark, d, first: str, end: str) -> DataFrame:
    """Days and minutes with bars of each symbol in a window."""
    own = bars(spark, d).where((F.col("ts_utc") >= F.lit(first).cast("timestamp")) & (F.col("ts_utc") < F.lit(end).cast("timestamp")))
    minutes = own.groupBy("symbol", F.to_date("ts_utc").alias("day")).agg(F.countDistinct("ts_utc").alias("n"))
    return minutes.groupBy("symbol").agg(F.count("*").alias("observed_days"), F.sum("n").alias("observed_minutes"))


def _observed_sql(first: str, end: str, expected: str) -> str:
    return f"""{B}, o AS (SELECT symbol, count(DISTINCT CAST(ts_utc AS DATE)) AS observed_days, count(DISTINCT ts_utc) AS observed_minutes FROM b WHERE ts_utc >= TIMESTAMP '{first}' AND ts_utc < TIMESTAMP '{end}' GROUP BY symbol),
e AS ({expected}) SELECT o.*, e.*, CAST(observed_minutes / minute_bars AS DOUBLE) AS coverage_pct FROM o, e"""


def _expected(spark, d, first: str, end: str, mode: str) -> DataFrame:
    days, minutes = gaps.expected_bars(spark, first, end, mode=mode).first()
    out = _observed(spark, d, first, end).withColumns({"daily_bars": F.lit(days).cast("long"), "minute_bars": F.lit(minutes).cast("long")})
    return out.withColumn("coverage_pct", F.col("observed_minutes") / F.col("minute_bars"))


@_query(_observed_sql(START, END, f"SELECT count(*) AS daily_bars, 390 * count(*) AS minute_bars FROM (SELECT unnest(generate_series(DATE '{START}', DATE '{END}' - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS t) WHERE isodow(t) < 6"))
def expected_bars(spark, d):
    return _expected(spark, d, START, END, "WEEKDAY")


@_query(_observed_sql("2024-01-01", "2025-01-01", f"""SELECT count(*) AS daily_bars, CAST(sum(CASE WHEN strftime(t, '%Y-%m-%d') IN ({', '.join(map(repr, SHORT_2024))}) THEN 210 ELSE 390 END) AS BIGINT) AS minute_bars
FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-12-31', INTERVAL 1 DAY)) AS t) WHERE isodow(t) < 6 AND strftime(t, '%Y-%m-%d') NOT IN ({', '.join(map(repr, CLOSED_2024))})"""))
def expected_bars_exchange(spark, d):
    return _expected(spark, d, "2024-01-01", "2025-01-01", "XNYS")


#: The exchange that each symbol of the views is listed on, and what its calendar is in the queries' windows, for SQL.
LISTED = {"1-URGENT": "XNYS", "2-HIGH": "XLON", "3-MEDIUM": "XETR", "4-NOT SPECIFIED": "XTKS", "5-LOW": "XTSE", "CLICK": "XNYS", "VIEW": "XLON", "SIGNUP": "XETR", "PURCHASE": "XTKS", "ERROR": "XTSE", "9-ABSENT": "XNYS"}
DAYS_2000 = {
    "XNYS": "01-17 02-21 04-21 05-29 07-04 09-04 11-23 12-25", "XLON": "01-03 04-21 04-24 05-01 05-29 08-28 12-25 12-26", "XETR": "04-21 04-24 05-01 12-25 12-26", "XTSE": "01-03 04-21 05-22 07-03 08-07 09-04 10-09 12-25 12-26",
    "XTKS": "01-03 01-10 02-11 03-20 05-03 05-04 05-05 07-17 09-18 10-09 11-03 11-23",
}
#: Open, close and break in UTC (minutes of the day), and the closed weekdays of January 2024.
HOURS_2024 = {"XNYS": (870, 1260, 0, 0, "01-01 01-15"), "XLON": (480, 990, 0, 0, "01-01"), "XETR": (480, 990, 0, 0, "01-01"), "XTSE": (870, 1260, 0, 0, "01-01"), "XTKS": (0, 360, 150, 210, "01-01 01-02 01-03 01-08")}


def _listing(spark, d, own: DataFrame) -> DataFrame:
    """The bars' symbols that an exchange lists, and one that has no bars."""
    names = F.create_map(*(F.lit(x) for pair in LISTED.items() for x in pair))
    symbols = own.select("symbol").distinct().unionByName(spark.range(1).select(F.lit("9-ABSENT").alias("symbol")))
    return symbols.select("symbol", names[F.col("symbol")].alias("exchange")).where("exchange IS NOT NULL")


def _values(rows) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(map(repr, r)) + ")" for r in rows) + ")"


LISTING_SQL = f"l AS (SELECT s.symbol, v.exchange FROM (SELECT DISTINCT symbol FROM b UNION SELECT '9-ABSENT') s JOIN {_values(LISTED.items())} AS v(symbol, exchange) USING (symbol))"


@_query(f"""{D}, {LISTING_SQL}, h(exchange, day) AS {_values((x, f"2000-{day}") for x, days in DAYS_2000.items() for day in days.split())},
c AS (SELECT exchange, CAST(t AS DATE) AS session_date FROM (SELECT unnest(generate_series(DATE '2000-01-01', DATE '2000-12-31', INTERVAL 1 DAY)) AS t), (SELECT DISTINCT exchange FROM h) WHERE isodow(t) < 6 AND (exchange, strftime(t, '%Y-%m-%d')) NOT IN (SELECT (exchange, day) FROM h)),
e AS (SELECT exchange, count(*) AS expected_days FROM c GROUP BY exchange),
o AS (SELECT b.symbol, count(*) AS rows_total, count(DISTINCT CASE WHEN c.session_date IS NOT NULL THEN b.d END) AS observed_days, count(DISTINCT CASE WHEN c.session_date IS NULL THEN b.d END) AS off_session_days
 FROM b JOIN l USING (symbol) LEFT JOIN c ON c.exchange = l.exchange AND c.session_date = b.d WHERE b.d BETWEEN (SELECT min(session_date) FROM c) AND (SELECT max(session_date) FROM c) GROUP BY b.symbol),
q AS (SELECT l.symbol, l.exchange, coalesce(rows_total, 0) AS rows_total, expected_days, coalesce(observed_days, 0) AS observed_days, coalesce(off_session_days, 0) AS off_session_days FROM l JOIN e USING (exchange) LEFT JOIN o USING (symbol))
SELECT *, expected_days - observed_days AS missing_day_count, observed_days / expected_days AS coverage_days_pct,
 concat_ws('; ', CASE WHEN rows_total = 0 THEN 'NO_ROWS' END, CASE WHEN expected_days > observed_days THEN 'missing_days=' || (expected_days - observed_days) END) AS notes FROM q""")
def exchange_coverage(spark, d):
    own, table = daily(spark, d), f"{shared_dir(spark)}/{uuid.uuid4().hex}/calendars"
    gaps.exchange_sessions(spark, "2000-01-01", "2000-12-31", tuple(DAYS_2000)).write.parquet(table)
    return gaps.exchange_coverage(own, _listing(spark, d, own), spark.read.parquet(table))


@_query(f"""{B}, {LISTING_SQL}, h(exchange, opens, closes, rests, goes_on, days) AS {_values((x, *y) for x, y in HOURS_2024.items())},
c AS (SELECT exchange, CAST(t AS DATE) AS day, opens, closes, rests, goes_on FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS t), h WHERE isodow(t) < 6 AND NOT contains(days, strftime(t, '%m-%d'))),
e AS (SELECT exchange, count(*) AS sessions, CAST(sum(closes - opens - goes_on + rests) AS BIGINT) AS expected_minutes FROM c GROUP BY exchange),
m AS (SELECT DISTINCT symbol, ts_utc, CAST(ts_utc AS DATE) AS day, date_part('hour', ts_utc) * 60 + date_part('minute', ts_utc) AS mi FROM b
 WHERE ts_utc >= (SELECT min(day + to_minutes(opens)) FROM c) AND ts_utc < (SELECT max(day + to_minutes(closes)) FROM c)),
o AS (SELECT m.symbol, count(c.day) AS observed_minutes, count(*) - count(c.day) AS outside_minutes FROM m JOIN l USING (symbol) LEFT JOIN c ON c.exchange = l.exchange AND c.day = m.day AND mi >= opens AND mi < closes AND NOT (mi >= rests AND mi < goes_on) GROUP BY m.symbol)
SELECT l.symbol, l.exchange, sessions, expected_minutes, coalesce(observed_minutes, 0) AS observed_minutes, coalesce(outside_minutes, 0) AS outside_minutes FROM l JOIN e USING (exchange) LEFT JOIN o USING (symbol)""")
def exchange_minutes(spark, d):
    own, table = bars(spark, d), f"{shared_dir(spark)}/{uuid.uuid4().hex}/calendars"
    gaps.exchange_sessions(spark, "2024-01-01", "2024-01-31", tuple(HOURS_2024)).write.parquet(table)
    return gaps.exchange_minutes(own, _listing(spark, d, own), spark.read.parquet(table))


def _by_symbol(spark, d):
    own = bars(spark, d)
    days = own.agg(F.size(gaps.sessions(F.to_date(F.min("ts_utc")), F.to_date(F.max("ts_utc"))))).scalar()
    return rollup.qa_by_symbol(own, days * gaps.MINUTES)


@_query(f"{B}, {BY_SYMBOL} SELECT * FROM q")
def qa_by_symbol(spark, d):
    return _by_symbol(spark, d)


@_query(f"""{B}, {BY_SYMBOL} SELECT CAST(sum(rows_observed) AS BIGINT) AS total_rows, CAST(sum(duplicate_rows) AS BIGINT) AS duplicate_rows, CAST(sum(duplicate_keys) AS BIGINT) AS total_duplicate_keys,
count(*) AS symbols_present, CAST(sum(gap_count) AS BIGINT) AS total_gap_count, CAST(sum(ohlc_violation_count) AS BIGINT) AS total_ohlc_violation_count, avg(CASE WHEN coverage_pct < 0.99 THEN 1.0 ELSE 0.0 END) AS pct_below,
CAST(sum(rows_observed) - sum(duplicate_rows) AS BIGINT) AS unique_rows,
CASE WHEN sum(duplicate_rows) > 0 OR sum(ohlc_violation_count) > 0 THEN 'FAIL' WHEN max(gap_count) > 0 OR min(coverage_pct) < 0.99 THEN 'WARN' ELSE 'PASS' END AS overall_status FROM q""")
def qa_global(spark, d):
    return rollup.qa_global(_by_symbol(spark, d))


@_query(f"""{B}, {KEYS}, dup AS ({DUPS}), o AS (SELECT symbol, count(*) AS n FROM ({BROKEN}) GROUP BY symbol), g AS (SELECT symbol, CAST(sum(missing_minutes) AS BIGINT) AS gap_count FROM ({DAYS}) GROUP BY symbol),
x AS ({ORDERED.format('ts_utc')}), a AS (SELECT symbol, timeframe, min(ts_utc) AS min_ts, max(ts_utc) AS max_ts, count(*) AS row_count FROM b GROUP BY ALL)
SELECT symbol, a.timeframe, min_ts, max_ts, row_count, duplicate_keys, coalesce(n, 0) AS ohlc_violation_count, gap_count, out_of_order_count
FROM a JOIN dup USING (symbol) LEFT JOIN o USING (symbol) JOIN g USING (symbol) JOIN x USING (symbol)""")
def qa_summary(spark, d):
    return rollup.qa_summary(bars(spark, d))


@_query(f"{B}, {BY_SYMBOL} SELECT symbol, duplicate_keys, ohlc_violation_count, gap_count FROM q WHERE duplicate_keys > 0 OR ohlc_violation_count > 0 OR gap_count > 0 ORDER BY 2 DESC, 3 DESC, 4 DESC, 1 LIMIT 3")
def top_offenders(spark, d):
    return rollup.top_offenders(_by_symbol(spark, d), 3)


@_query(f"""{D}, e AS (SELECT * FROM (VALUES {", ".join(f"('{s}')" for s in UNIVERSE)}) t(symbol)) SELECT coalesce(string_agg(symbol, ';' ORDER BY symbol), '') AS symbols_missing, count(*) AS n_missing FROM e WHERE symbol NOT IN (SELECT symbol FROM b)""")
def missing_symbols(spark, d):
    return rollup.missing_symbols(daily(spark, d), spark.range(1).select(F.explode(F.array(*map(F.lit, UNIVERSE))).alias("symbol")))


@_query(with_views("bars_1m") + """ SELECT symbol, ts_utc, volume, event_id FROM bars_1m QUALIFY row_number() OVER (PARTITION BY symbol, ts_utc, timeframe ORDER BY event_id DESC) = 1""")
def dedup_keep_last(spark, d):
    return normalize.keep_last(view(spark, d, "bars_1m"), ordinal="event_id").select("symbol", "ts_utc", "volume", "event_id")


@_query(with_views("bars_1m") + """ SELECT symbol, timeframe, 'synthetic' AS source, ts_utc, open, high, low, close, volume, CAST(year(ts_utc) AS INTEGER) AS year, strftime(ts_utc, '%Y-%m-%d') AS date
FROM bars_1m QUALIFY row_number() OVER (PARTITION BY symbol, ts_utc, timeframe ORDER BY event_id DESC) = 1""")
def normalize_bars(spark, d):
    raw = view(spark, d, "bars_1m").withColumnRenamed("ts_utc", "timestamp")
    out = normalize.normalize_bars(raw, F.col("symbol"), "synthetic", "1Min", "event_id", strict=False)
    return out.withColumn("ts_utc", F.col("ts_utc").cast("timestamp_ntz"))


@_query(f"{B} SELECT symbol, CAST(year(ts_utc) AS INTEGER) AS year, strftime(ts_utc, '%Y-%m-%d') AS date, count(*) AS n FROM b GROUP BY ALL")
def bars_partition_cols(spark, d):
    return bars(spark, d).groupBy("symbol", F.year("ts_utc").alias("year"), F.date_format("ts_utc", "yyyy-MM-dd").alias("date")).agg(F.count("*").alias("n"))


def _events(spark, d, pre=5, post=5, symbol=None, dealt=False) -> DataFrame:
    return ew.event_windows(dividends(spark, d), view(spark, d, "bars_daily").withColumnRenamed("d", "date"), pre, post, symbol, guard="plan", dealt=dealt)


def _events_sql(pre: int, post: int, more: str = "") -> str:
    return with_views("dividends", "bars_daily") + f""", w AS (SELECT v.corporate_action_id AS event_corporate_action_id, v.symbol AS event_symbol, v.ex_date AS event_date, b.d AS bar_date,
 CAST(datediff('day', v.ex_date, b.d) AS INTEGER) AS event_day_offset, b.close AS bar_close, b.volume AS bar_volume, v.currency AS event_currency
 FROM dividends v JOIN bars_daily b ON b.symbol = v.symbol AND b.d BETWEEN v.ex_date - {pre} AND v.ex_date + {post}{more})"""


EVENT_COLUMNS = ["event_corporate_action_id", "event_symbol", "event_date", "bar_date", "event_day_offset", "bar_close", "bar_volume", "event_currency"]


@_query(_events_sql(5, 5) + " SELECT * FROM w")
def event_window(spark, d):
    return _events(spark, d).select(*EVENT_COLUMNS)


@_query(_events_sql(5, 5, " AND v.symbol = '1-URGENT'") + " SELECT * FROM w")
def event_window_symbol(spark, d):
    return _events(spark, d, symbol=" 1-urgent ").select(*EVENT_COLUMNS)


@_query(_events_sql(1, 0) + " SELECT * FROM w")
def event_window_asym(spark, d):
    return _events(spark, d, 1, 0).select(*EVENT_COLUMNS)


@_query(_events_sql(5, 5) + " SELECT event_symbol, count(*) AS n_rows, count(DISTINCT event_corporate_action_id) AS n_events FROM w GROUP BY ALL")
def event_window_counts(spark, d):
    return _events(spark, d).groupBy("event_symbol").agg(F.count("*").alias("n_rows"), F.countDistinct("event_corporate_action_id").alias("n_events"))


@_query(_events_sql(5, 5) + " SELECT event_day_offset, count(*) AS n, min(bar_close) AS min_close, max(bar_close) AS max_close FROM w GROUP BY ALL")
def event_window_profile(spark, d):
    return _events(spark, d).groupBy("event_day_offset").agg(F.count("*").alias("n"), F.min("bar_close").alias("min_close"), F.max("bar_close").alias("max_close"))


@_query(V + """, u AS (SELECT *, md5(corporate_action_id) AS h FROM dividends UNION ALL SELECT *, md5(concat(corporate_action_id, 'x')) AS h FROM dividends WHERE o_orderkey % 2 = 0)
SELECT corporate_action_id, symbol, ex_date, max(h) AS source_payload_hash FROM u GROUP BY ALL""")
def dividend_dedup(spark, d):
    own = dividends(spark, d)
    both = own.withColumn("source_payload_hash", F.md5("corporate_action_id")).unionByName(own.where("o_orderkey % 2 = 0").withColumn("source_payload_hash", F.md5(F.concat("corporate_action_id", F.lit("x")))))
    return dv.dedup_dividends(both.select("corporate_action_id", "symbol", "ex_date", "source_payload_hash"), ("corporate_action_id", "symbol", "ex_date"))


def _raw_dividends(spark, d):
    own = dividends(spark, d)
    return own.select(F.col("corporate_action_id").alias("id"), F.concat(F.lit(" "), F.lower("symbol")).alias("symbol"), F.col("corporate_action_type").alias("type"), F.col("ex_date").cast("string").alias("ex_date"), F.col("cash_amount").cast("string").alias("rate"), "currency")


@_query(V + """ SELECT corporate_action_id, upper(symbol) AS symbol, corporate_action_type, CAST(ex_date AS VARCHAR) AS ex_date, cash_amount, CASE WHEN currency IS NULL AND corporate_action_type = 'cash_dividend' THEN 'USD' ELSE currency END AS currency FROM dividends""")
def dividend_normalize(spark, d):
    return dv.normalize_dividends(_raw_dividends(spark, d)).select("corporate_action_id", "symbol", "corporate_action_type", "ex_date", "cash_amount", "currency")


@_query(V + " SELECT corporate_action_id, symbol, corporate_action_type, ex_date FROM dividends ORDER BY symbol, ex_date, corporate_action_type, corporate_action_id")
def dividend_sorted(spark, d):
    own = dividends(spark, d).withColumn("process_date", F.lit(None).cast("string")).withColumn("day", F.col("ex_date")).withColumn("ex_date", F.col("ex_date").cast("string"))
    return own.orderBy(*dv.action_order()).select("corporate_action_id", "symbol", "corporate_action_type", F.col("day").alias("ex_date"))


@_query(V + """ SELECT count(*) AS record_count, string_agg(DISTINCT corporate_action_type, ',' ORDER BY corporate_action_type) AS types, count(*) FILTER (currency IS NULL) AS missing_currency,
count(DISTINCT symbol) AS symbol_count, min(ex_date) AS min_ex_date, max(ex_date) AS max_ex_date FROM dividends""")
def snapshot_metadata(spark, d):
    return dv.snapshot_metadata(dividends(spark, d))


@_query(V + " SELECT corporate_action_id, upper(symbol) AS symbol, CAST(year(ex_date) AS INTEGER) AS year FROM dividends")
def mart_prep(spark, d):
    return dv.mart_rows(dividends(spark, d)).select("corporate_action_id", "symbol", "year")


@_query(V + " SELECT CAST(year(ex_date) AS INTEGER) AS year, count(*) AS n, count(DISTINCT symbol) AS symbols FROM dividends GROUP BY ALL")
def mart_metadata(spark, d):
    return dv.mart_rows(dividends(spark, d)).groupBy("year").agg(F.count("*").alias("n"), F.countDistinct("symbol").alias("symbols"))


@_query(f"""{D}, e AS (SELECT min(d) AS a, max(d) AS z FROM b), m AS (SELECT CAST(unnest(generate_series(date_trunc('month', a), z, INTERVAL 1 MONTH)) AS DATE) AS m FROM e),
w AS (SELECT greatest(m, a) AS window_start, least(CAST(m + INTERVAL 1 MONTH AS DATE), CAST(z + INTERVAL 1 DAY AS DATE)) AS window_end FROM m, e)
SELECT window_start, window_end, count(d) AS n_bars FROM w LEFT JOIN b ON d >= window_start AND d < window_end GROUP BY ALL""")
def month_windows(spark, d):
    own = daily(spark, d)
    first, last = own.agg(F.min("d"), F.max("d")).first()
    months = gaps_months(spark, str(first), str(last + timedelta(days=1))).withColumn("month", F.trunc("window_start", "MM"))
    counts = own.groupBy(F.trunc("d", "MM").alias("month")).agg(F.count("*").alias("n"))
    return months.join(counts, "month", "left").select("window_start", "window_end", F.coalesce("n", F.lit(0).cast("long")).alias("n_bars"))


def gaps_months(spark, start: str, end: str) -> DataFrame:
    """Month windows from start to end (excluded), cut at both."""
    a, z = F.lit(start).cast("date"), F.lit(end).cast("date")
    months = spark.range(1).select(F.explode(F.sequence(F.trunc(a, "MM"), F.date_sub(z, 1), F.expr("INTERVAL 1 MONTH"))).alias("m"))
    return months.select(F.greatest("m", a).alias("window_start"), F.least(F.add_months("m", 1), z).alias("window_end"))


@_query(f"{B}, e AS (SELECT CAST(min(ts_utc) AS DATE) AS a, CAST(max(ts_utc) AS DATE) AS z FROM b), w AS (SELECT CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS day FROM e) SELECT day, count(symbol) AS n_bars FROM w LEFT JOIN b ON CAST(ts_utc AS DATE) = day WHERE isodow(day) < 6 GROUP BY day")
def weekday_list(spark, d):
    counts = bars(spark, d).groupBy(F.to_date("ts_utc").alias("day")).agg(F.count("symbol").alias("n"))
    days = counts.agg(F.explode(sessions(F.min("day"), F.max("day"))).alias("day"))
    return days.join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0).cast("long")).alias("n_bars"))


@_query("SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS n, count(*) FILTER (json_extract_string(props, '$.absent') IS NULL) AS without FROM events GROUP BY ALL")
def payload_fields(spark, d):
    e = base_table(spark, d, "events")
    return e.groupBy(F.get_json_object("props", "$.k").cast("int").alias("k")).agg(F.count("*").alias("n"), F.count_if(F.get_json_object("props", "$.absent").isNull()).alias("without"))


@_query("SELECT event_id, sha256('{\"k\":' || json_extract_string(props, '$.k') || '}') AS payload_hash FROM events")
def payload_hash(spark, d):
    return base_table(spark, d, "events").select("event_id", dv.payload_hash(F.col("props")).alias("payload_hash"))


@_query(V + """, c AS (SELECT symbol, corporate_action_id, corporate_action_type, row_number() OVER (PARTITION BY symbol, ex_date, corporate_action_type ORDER BY corporate_action_id) - 1 AS position FROM dividends)
SELECT symbol, corporate_action_id AS id, corporate_action_type AS action_type, position FROM c""")
def nested_flatten(spark, d):
    one = F.struct(F.col("corporate_action_id").alias("id"))
    groups = dividends(spark, d).groupBy("symbol", "ex_date").agg(*(F.array_sort(F.collect_list(F.when(F.col("corporate_action_type") == f"{k}_dividend", one))).alias(f"{k}_dividends") for k in ("cash", "stock")))
    bodies = groups.select("symbol", F.to_json(F.struct(F.struct("cash_dividends", "stock_dividends").alias("corporate_actions"))).alias("body"))
    return dv.flatten_payloads(bodies).select("symbol", F.get_json_object("raw", "$.id").alias("id"), "action_type", F.col("position").cast("long").alias("position"))


def _files(spark, d):
    docs = base_table(spark, d, "orders")
    path = F.format_string("bars_daily/symbol=%s/date=%s/part-%08d.parquet", F.col("o_orderpriority"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey"))
    return docs.select(path.alias("relative_path"), F.col("o_totalprice").cast("long").alias("size_bytes"), F.sha2(F.col("o_orderkey").cast("string"), 256).alias("sha256"), "o_orderkey")


FILES = "f AS (SELECT format('bars_daily/symbol={}/date={}/part-{:08d}.parquet', o_orderpriority, strftime(o_orderdate, '%Y-%m-%d'), o_orderkey) AS relative_path, CAST(trunc(o_totalprice) AS BIGINT) AS size_bytes, sha256(CAST(o_orderkey AS VARCHAR)) AS sha256, o_orderkey, o_orderpriority, o_orderdate FROM orders)"


@_query(f"""WITH RECURSIVE {FILES}, o AS (SELECT relative_path, size_bytes, row_number() OVER w - 1 AS place, CAST(sum(size_bytes) OVER w AS BIGINT) - size_bytes AS begin FROM f WINDOW w AS (ORDER BY relative_path)),
n AS MATERIALIZED (SELECT place, greatest(place + 1, max(CASE WHEN size_bytes > 0 THEN place END) OVER (ORDER BY begin RANGE BETWEEN UNBOUNDED PRECEDING AND 1000000 FOLLOWING)) AS following,
 begin + 1000000 < sum(size_bytes) OVER () OR size_bytes > 1000000 AS goes_on FROM o),
c AS (SELECT CAST(0 AS BIGINT) AS place UNION ALL SELECT n.following FROM c JOIN n ON c.place = n.place AND n.goes_on)
SELECT o.relative_path, o.size_bytes, count(c.place) OVER (ORDER BY o.place) - 1 AS shard FROM o LEFT JOIN c ON o.place = c.place""")
def shard_plan(spark, d):
    return shards.shard_plan(_files(spark, d), 1_000_000)


@_query(f"WITH {FILES} SELECT 'bars_daily' AS dataset, count(*) AS file_count, CAST(sum(size_bytes) AS BIGINT) AS total_bytes, 'date,symbol' AS partition_keys FROM f")
def pack_dataset_summary(spark, d):
    files = _files(spark, d).withColumns({"dataset": F.substring_index("relative_path", "/", 1), "partitions": partitions_of("relative_path")})
    return inventory.dataset_summary(files)


@_query(f"""WITH {FILES} SELECT relative_path, CASE WHEN o_orderkey % 7 = 0 THEN 'missing' WHEN o_orderkey % 11 = 0 THEN 'duplicate' WHEN o_orderkey % 13 = 0 THEN 'size_mismatch'
 WHEN o_orderkey % 17 = 0 THEN 'checksum_mismatch' ELSE 'ok' END AS status FROM f""")
def inventory_reconcile(spark, d):
    files = _files(spark, d)
    k = F.col("o_orderkey")
    found = files.where(k % 7 != 0).withColumns({"size_bytes": F.col("size_bytes") + F.when(k % 13 == 0, 1).otherwise(0), "sha256": F.when(k % 17 == 0, F.lit("x")).otherwise(F.col("sha256"))})
    return inventory.reconcile(files, found.unionByName(found.where(k % 11 == 0)))


@_query(f"WITH {FILES} SELECT relative_path, o_orderpriority AS symbol, strftime(o_orderdate, '%Y-%m-%d') AS date FROM f")
def partition_path_parse(spark, d):
    parts = partitions_of("relative_path")
    return _files(spark, d).select("relative_path", parts["symbol"].alias("symbol"), parts["date"].alias("date"))


@_query(f"WITH {FILES} SELECT o_orderpriority AS symbol, count(*) AS file_count, strftime(min(o_orderdate), '%Y-%m-%d') AS date_min, strftime(max(o_orderdate), '%Y-%m-%d') AS date_max FROM f GROUP BY ALL")
def path_summary(spark, d):
    parts = partitions_of("relative_path")
    return _files(spark, d).select(parts["symbol"].alias("symbol"), parts["date"].alias("date")).groupBy("symbol").agg(F.count("*").alias("file_count"), F.min("date").alias("date_min"), F.max("date").alias("date_max"))


@_query(f"{B} SELECT symbol, ts_utc, event_id, strftime(ts_utc, '%Y-%m-%dT%H:%M:%S+00:00') AS ts_text FROM b WHERE symbol = 'CLICK' AND CAST(ts_utc AS DATE) = DATE '2024-01-08' ORDER BY ts_utc, event_id LIMIT 10")
def preview_partition(spark, d):
    """Of one folder of curated bars; the others aren't read."""
    schema = T.StructType([*BAR.fields, T.StructField("event_id", T.LongType())])
    rows = tables.read_partition(spark, f"{_lake(spark, d)}/bars_1m", schema, symbol="CLICK", date="2024-01-08")
    return rows.orderBy("ts_utc", "event_id").limit(10).select("symbol", "ts_utc", "event_id", utc_text("ts_utc").alias("ts_text"))


def _lake(spark, d) -> str:
    """The minute bars as curated ones, in folders symbol=/date= of a new root."""
    root = _folder(spark)
    rows = bars(spark, d).withColumn("ts_utc", F.col("ts_utc").cast("timestamp"))
    tables.write_bars(rows.withColumns({"year": F.year("ts_utc"), "date": F.date_format("ts_utc", "yyyy-MM-dd")}), f"{root}/bars_1m")
    return root


@_query(f"{B} SELECT symbol, timeframe, min(ts_utc) AS min_ts, max(ts_utc) AS max_ts, count(*) AS row_count FROM b GROUP BY ALL")
def footer_bounds(spark, d):
    return footers.bounds(spark, f"{_lake(spark, d)}/bars_1m", BAR)


@_query(f"{B} SELECT 'bars_1m' AS dataset, count(DISTINCT (symbol, CAST(ts_utc AS DATE))) AS file_count, count(*) AS row_count FROM b")
def footer_counts(spark, d):
    return footers.row_counts(spark, _lake(spark, d))


@_query(f"{B} SELECT 'bars_1m' AS dataset, symbol, strftime(ts_utc, '%Y-%m-%d') AS date, count(DISTINCT CAST(ts_utc AS DATE)) AS files FROM b WHERE symbol = 'VIEW' AND ts_utc >= TIMESTAMP '2024-01-10' GROUP BY ALL")
def folder_listing(spark, d):
    """Folders of one symbol from a day on; the others aren't entered."""
    found = listing.listing(spark, _lake(spark, d)).where("symbol = 'VIEW' AND date >= '2024-01-10'")
    return found.groupBy("dataset", "symbol", "date").agg(F.count("*").alias("files"))


@_query(f"{D} SELECT symbol, count(*) AS n FROM b GROUP BY symbol ORDER BY n DESC, symbol LIMIT 5")
def top_symbols(spark, d):
    return daily(spark, d).groupBy("symbol").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "symbol").limit(5)


@_query(f"{B} SELECT symbol, ts_utc, event_id FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts_utc DESC, event_id DESC) AS r FROM b) WHERE r = 1")
def latest_bar(spark, d):
    last = F.max(F.struct("ts_utc", "event_id")).alias("last")
    return bars(spark, d).groupBy("symbol").agg(last).select("symbol", "last.*")


# Queries that write a table with its metadata and read it back.


def _folder(spark) -> str:
    """A new folder that driver and executors share."""
    return f"{shared_dir(spark)}/{uuid.uuid4().hex}"


def _snapshot(spark, d, path: str) -> dict:
    return tables.write_snapshot(dv.normalize_dividends(_raw_dividends(spark, d)), path)


@_query(_events_sql(5, 5) + " SELECT * FROM w")
def event_window_output(spark, d):
    path = _folder(spark)
    tables.write_event_windows(_events(spark, d, dealt=True), path, 5, 5)
    return tables.read_event_windows(spark, path, EVENT_COLUMNS)


@_query(_events_sql(2, 2) + " SELECT event_corporate_action_id, bar_date, event_day_offset FROM w")
def snapshot_windows(spark, d):
    path = _folder(spark)
    _snapshot(spark, d, path)
    return tables.snapshot_windows(spark, path, view(spark, d, "bars_daily").withColumnRenamed("d", "date"), 2, 2).select("event_corporate_action_id", "bar_date", "event_day_offset")


@_query(_events_sql(0, 3) + " SELECT event_corporate_action_id, bar_date, event_day_offset FROM w")
def mart_windows(spark, d):
    path = _folder(spark)
    _snapshot(spark, d, f"{path}/snapshot")
    tables.mart_from_snapshot(spark, f"{path}/snapshot", f"{path}/mart")
    return tables.mart_windows(spark, f"{path}/mart", view(spark, d, "bars_daily").withColumnRenamed("d", "date"), 0, 3).select("event_corporate_action_id", "bar_date", "event_day_offset")


@_query(V + " SELECT count(*) AS row_count, count(DISTINCT upper(symbol)) AS symbol_count, count(DISTINCT year(ex_date)) AS year_count, true AS valid FROM dividends")
def mart_inspection(spark, d):
    path = _folder(spark)
    _snapshot(spark, d, f"{path}/snapshot")
    tables.mart_from_snapshot(spark, f"{path}/snapshot", f"{path}/mart")
    found = tables.validate_mart(spark, f"{path}/mart")
    return spark.createDataFrame([tuple(found[c] for c in ("row_count", "symbol_count", "year_count", "valid"))], "row_count bigint, symbol_count bigint, year_count bigint, valid boolean")


@_query(V + """ SELECT count(*) AS input_record_count, count(*) AS written_record_count, CAST(0 AS BIGINT) AS duplicate_record_count, count(*) FILTER (currency IS NULL AND corporate_action_type = 'cash_dividend') AS currency_missing_for_cash_dividend_count FROM dividends""")
def snapshot_counts(spark, d):
    found = _snapshot(spark, d, _folder(spark))
    names = ("input_record_count", "written_record_count", "duplicate_record_count", "currency_missing_for_cash_dividend_count")
    return spark.createDataFrame([tuple(found[c] for c in names)], ", ".join(f"{c} bigint" for c in names))


@_query(ORACLES["qa_summary"].replace("SELECT symbol, a.timeframe, min_ts, max_ts, row_count", "SELECT symbol, a.timeframe, row_count"))
def qa_report(spark, d):
    """The summary that the report wrote."""
    path = _folder(spark)
    composites.qa_report(bars(spark, d), path)
    names = ("row_count", "duplicate_keys", "ohlc_violation_count", "gap_count", "out_of_order_count")
    return spark.read.option("header", True).csv(f"{path}/qa_summary").select("symbol", "timeframe", *(F.col(c).cast("long").alias(c) for c in names))


def _export(spark, d) -> str:
    e = composites.Export("bars_1m", start=START, end=END, calendar="WEEKDAY", symbols=("CLICK", "VIEW", "ABSENT"))
    return composites.write_export(bars(spark, d), e, _folder(spark))[0]


WINDOW = f"{with_views('bars_1m')}, b AS (SELECT * FROM bars_1m WHERE ts_utc >= TIMESTAMP '{START}' AND ts_utc < TIMESTAMP '{END}')"
BY_SYMBOL_SQL = f"{WINDOW}, {BY_SYMBOL}"


@_query(f"{BY_SYMBOL_SQL} SELECT symbol, rows_observed, CAST({11 * gaps.MINUTES} AS BIGINT) AS expected_bars, rows_observed / {11 * gaps.MINUTES} AS coverage_pct, duplicate_rows, duplicate_keys, gap_count, gap_segments, max_gap_len, ohlc_violation_count FROM q")
def qa_export_by_symbol(spark, d):
    """What the export of a window wrote of each symbol."""
    rows, _ = composites.read_metrics(spark, _export(spark, d))
    return rows.select("symbol", "rows_observed", "expected_bars", "coverage_pct", "duplicate_rows", "duplicate_keys", "gap_count", "gap_segments", "max_gap_len", "ohlc_violation_count")


@_query(f"""{BY_SYMBOL_SQL} SELECT CAST(sum(rows_observed) AS BIGINT) AS total_rows, CAST(sum(duplicate_rows) AS BIGINT) AS duplicate_rows, CAST(3 AS BIGINT) AS symbols_expected, count(*) AS symbols_present, 'ABSENT' AS symbols_missing,
CAST(sum(gap_count) AS BIGINT) AS total_gap_count, 'FAIL' AS overall_status FROM q""")
def qa_export_global(spark, d):
    """What the export of a window wrote of all symbols."""
    return composites.read_metrics(spark, _export(spark, d))[1].select("total_rows", "duplicate_rows", "symbols_expected", "symbols_present", "symbols_missing", "total_gap_count", "overall_status")


@_query(f"""{BY_SYMBOL_SQL} SELECT false AS passed, concat_ws('|', CASE WHEN sum(duplicate_keys) > 0 THEN 'duplicate_keys=' || CAST(sum(duplicate_keys) AS BIGINT) || ' > 0' END,
 CASE WHEN sum(ohlc_violation_count) > 0 THEN 'ohlc_violations=' || CAST(sum(ohlc_violation_count) AS BIGINT) || ' > 0' END, 'missing_symbols=ABSENT') AS reasons FROM q""")
def qa_enforcement(spark, d):
    """The gates on what an export wrote."""
    v = composites.enforce_artifacts(spark, _export(spark, d), rollup.Gates(allow_missing_symbols=False))
    return spark.createDataFrame([(v.passed, "|".join(v.reasons))], "passed boolean, reasons string")


@_query(f"WITH {FILES} SELECT 'bars_daily' AS dataset, string_agg(DISTINCT o_orderpriority, ';' ORDER BY o_orderpriority) AS symbols, strftime(min(o_orderdate), '%Y-%m-%d') AS date_min, strftime(max(o_orderdate), '%Y-%m-%d') AS date_max, count(*) AS file_count FROM f")
def handoff_datasets(spark, d):
    return composites.dataset_inventory(_files(spark, d)).withColumn("symbols", F.array_join("symbols", ";"))


@_query(f"WITH {FILES} SELECT count(*) AS file_count, CAST(sum(size_bytes) AS BIGINT) AS total_bytes FROM f WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND NOT (o_orderpriority = '2-HIGH' AND strftime(o_orderdate, '%Y-%m-%d') = '1996-01-02')")
def plan_summary(spark, d):
    planned = composites.save_plan(_files(spark, d), ["bars_daily/symbol=1-URGENT", "bars_daily/symbol=2-HIGH/"], ["bars_daily/symbol=2-HIGH/date=1996-01-02"])
    return composites.plan_summary(planned)
