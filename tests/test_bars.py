"""Operators over bars and dividends on hand-made fixtures."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tickloom.functions.calendars import easter
from tickloom.operators import dividends as dv
from tickloom.operators import event_windows as ew
from tickloom.operators import gaps, inventory, normalize, quality, rollup
from tickloom.schemas import CANONICAL_BAR, DIVIDEND
from tickloom.session import configured
from tickloom.sources import rest, tables
from tickloom.sources.backfill import backfill_bars
from tickloom.streaming.backfill import run_backfill, stream_backfill

T = dt.datetime
BARS = [
    ("AAPL", "1Min", "x", T(2025, 11, 3, 14, 30), 100.0, 100.2, 99.8, 100.1, 10),
    ("AAPL", "1Min", "x", T(2025, 11, 3, 14, 30), 100.0, 100.2, 99.8, 100.1, 10),
    ("AAPL", "1Min", "x", T(2025, 11, 3, 14, 31), 100.0, 99.0, 99.5, 100.2, 10),
]
BAR_DDL = "symbol string, timeframe string, source string, ts_utc timestamp, open double, high double, low double, close double, volume bigint"


@pytest.fixture
def bars(spark):
    return configured(spark).createDataFrame(BARS, BAR_DDL)


def test_duplicates_and_violations_fail(bars):
    by = rollup.qa_by_symbol(bars, 2)
    r = by.first()
    assert (r.duplicate_keys, r.duplicate_rows, r.ohlc_violation_count, r.rows_observed) == (1, 1, 1, 3)
    assert rollup.qa_global(by).first().overall_status == "FAIL"
    verdict = rollup.enforce(by)
    assert verdict.exit_code == 1 and len(verdict.reasons) == 2 and verdict.offenders[0]["symbol"] == "AAPL"
    assert rollup.enforce(by, rollup.Gates(1, 1)).passed


def test_status_table(spark):
    rows = lambda **k: spark.createDataFrame([{"rows_observed": 1, "coverage_pct": 1.0, **dict.fromkeys(rollup.COUNTS, 0), **k}])
    status = lambda **k: rollup.qa_global(rows(**k)).first().overall_status
    assert [status(), status(gap_count=1), status(coverage_pct=0.5), status(duplicate_rows=1), status(ohlc_violation_count=1)] == ["PASS", "WARN", "WARN", "FAIL", "FAIL"]
    assert rollup.qa_global(rows().limit(0)).first().overall_status == "PASS"


def test_rules_of_nulls(spark):
    b = spark.createDataFrame([("A", "1Min", "x", None, None, 1.0, 1.0, 1.0, -1)], BAR_DDL)
    assert {r.rule for r in quality.violations_by_rule(b).collect()} == {"negative_volume", "null_required"}
    assert quality.violations_total(b).first().violation_count == 1 and quality.violations_total(b.limit(0)).first().violation_count == 0


def test_minute_gaps_end_with_the_day(spark):
    at = [T(2025, 1, 2, 9, 0, 59), T(2025, 1, 2, 9, 4, 1), T(2025, 1, 2, 9, 5), T(2025, 1, 3, 9, 0)]
    b = spark.createDataFrame([("A", t) for t in at] + [(None, at[0])], "symbol string, ts_utc timestamp")
    assert tuple(gaps.minute_gaps(b).first()) == ("A", 3, 1, 3)


def test_daily_islands_against_a_loop(spark):
    import random

    rng, start = random.Random(2), dt.date(2024, 1, 1)
    days = [start + dt.timedelta(i) for i in range(90)]
    sessions = [d for d in days if d.weekday() < 5]
    seen = {s: [d for d in sessions if rng.random() < 0.6] for s in "ABC"}
    b = spark.createDataFrame([(s, d) for s, own in seen.items() for d in own], "symbol string, d date")
    got = {r.symbol: (r.gap_count, r.gap_segments, r.max_gap_len) for r in gaps.daily_gaps(b, gaps.weekday_calendar(spark, str(days[0]), str(days[-1]))).collect()}
    for s, own in seen.items():
        runs, n = [], 0
        for d in [*sessions, None]:
            if d is not None and d not in own:
                n += 1
            else:
                runs += [n] if n else []
                n = 0
        assert got[s] == (sum(runs), len(runs), max(runs))


def test_coverage_lists_absent_symbols_and_unknown_calendars(spark):
    b = spark.createDataFrame([("A", dt.date(2024, 1, 1))], "symbol string, d date")
    e = spark.createDataFrame([("A",), ("Z",)], "symbol string")
    rows = {r.symbol: r for r in gaps.coverage(b, e, "NOPE", "2024-01-01", "2024-01-05").collect()}
    assert rows["Z"].notes.startswith("NO_ROWS; missing_days=5") and gaps.FALLBACK_NOTE in rows["A"].notes and rows["A"].coverage_days_pct == pytest.approx(0.2)


def test_exchange_calendar(spark):
    """Counts of trading days are public figures of the exchange; 2024 has three early closes."""
    counts = {1999: 252, 2001: 248, 2004: 252, 2007: 251, 2012: 250, 2013: 252, 2014: 252, 2015: 252, 2016: 252, 2017: 251, 2018: 251, 2019: 252, 2020: 253, 2021: 252, 2022: 251, 2023: 250, 2024: 252, 2025: 250}
    days = gaps.calendar(spark, "xnys", "1999-01-01", "2025-12-31")
    got = {r.y: r["count"] for r in days.groupBy(F.year("session_date").alias("y")).count().collect()}
    assert {y: got[y] for y in counts} == counts
    assert [str(r[0]) for r in days.where("minutes = 210 AND year(session_date) = 2024").orderBy("idx").select("session_date").collect()] == ["2024-07-03", "2024-11-29", "2024-12-24"]
    easters = {2008: "2008-03-23", 2011: "2011-04-24", 2019: "2019-04-21", 2024: "2024-03-31", 2025: "2025-04-20"}
    assert {r.y: str(r.e) for r in spark.createDataFrame([(y,) for y in easters], "y int").select("y", easter(F.col("y")).alias("e")).collect()} == easters


def test_calendars_of_no_days(spark):
    assert gaps.calendar(spark, "XNYS", "2024-01-06", "2024-01-07").count() == 0  # a weekend
    assert gaps.calendar(spark, "ALL", "2024-01-07", "2024-01-06").count() == 0  # the end comes first
    assert tuple(gaps.expected_bars(spark, "2024-01-05", "2024-01-05").first()) == (0, 0)
    assert tuple(gaps.expected_bars(spark, "2024-01-05", "2024-01-20", mode="NYSE").first()) == (10, 3900)


def test_normalize_bars(spark):
    raw = [("2025-01-02T10:01:00+01:00", "1", "2", "0.5", "1.5", None, 0), ("2025-01-02T09:01:00Z", "1", "2", "0.5", "1.6", "7.9", 1), ("2025-01-02T09:00:00Z", "bad", "2", "1", "1", "1", 2)]
    df = spark.createDataFrame(raw, "timestamp string, open string, high string, low string, close string, volume string, ordinal int")
    rows = normalize.normalize_bars(df, "AAPL", "api", "1Min").collect()
    assert len(rows) == 1 and (rows[0].close, rows[0].volume, rows[0].date, rows[0].year) == (1.6, 7, "2025-01-02", 2025)
    with pytest.raises(ValueError, match="can't be parsed"):
        normalize.normalize_bars(df.withColumn("timestamp", F.lit("noon")), "A", "x", "1D")
    with pytest.raises(ValueError, match="missing"):
        normalize.normalize_bars(df.drop("open"), "A", "x", "1D")


def events(spark):
    rows = [("ca-2", "aapl", "2025-01-10", 0.25), ("ca-1", "AAPL", "2025-01-07", 0.20)]
    bars = [("AAPL", f"2025-01-{d:02d}T00:00:00Z", 10 + i / 10, 100 + i) for i, d in enumerate(range(4, 13))] + [("MSFT", "2025-01-10T00:00:00Z", 1.0, 1)]
    return spark.createDataFrame(rows, "corporate_action_id string, symbol string, ex_date string, cash_amount double"), spark.createDataFrame(bars, "symbol string, ts_utc string, open double, volume bigint")


def test_event_windows(spark):
    d, b = events(spark)
    out = ew.event_windows(d, b, 2, 2)
    assert out.columns == list(ew.OUTPUT) and len(out.columns) == 24
    offsets = [r.event_day_offset for r in out.orderBy(*ew.event_order()).collect() if r.event_corporate_action_id == "ca-2"]
    assert offsets == [-2, -1, 0, 1, 2]
    assert sorted(r.event_day_offset for r in ew.event_windows(d, b, 1, 0).where("event_corporate_action_id = 'ca-1'").collect()) == [-1, 0]
    assert ew.event_windows(d, b, symbol="MSFT").count() == 0
    for bad in (lambda: ew.event_windows(d, b, -1), lambda: ew.event_windows(d.withColumn("ex_date", F.lit("not-a-date")), b), lambda: ew.event_windows(d, b.drop("ts_utc"))):
        with pytest.raises(ValueError):
            bad()


def test_dividends(spark):
    rows = [("ca-1", " aapl ", "cash_dividend", "2025-01-10", None, "0.24", None), ("ca-2", "MSFT", "stock_dividend", "2025-02-10", "0.05", None, " ")]
    df = spark.createDataFrame(rows, "id string, symbol string, type string, ex_date string, stock_amount string, rate string, currency string")
    got = [r.asDict() for r in dv.normalize_dividends(df).orderBy("corporate_action_id").collect()]
    assert [(g["symbol"], g["cash_amount"], g["stock_amount"], g["currency"]) for g in got] == [("AAPL", 0.24, None, "USD"), ("MSFT", None, 0.05, None)]
    for c, v in (("type", "split"), ("ex_date", "2025-1-1"), ("symbol", " ")):
        with pytest.raises(ValueError):
            dv.normalize_dividends(df.withColumn(c, F.lit(v)))
    raw = spark.createDataFrame([('{"b": 1.0, "a": "é"}',)], "raw string")
    import hashlib

    assert dv.canonical_hash(raw).first().source_payload_hash == hashlib.sha256(b'{"a":"\\u00e9","b":1.0}').hexdigest()


def test_nested_payloads(spark):
    bodies = [{"corporate_actions": {"cash_dividends": [{"id": "1"}], "stock_dividends": [{"id": "2"}]}}, {"stock_dividends": [{"id": "3"}]}, {"corporate_actions": [{"id": "4", "type": "cash_dividend"}]}, {}]
    got = dv.flatten_payloads(spark.createDataFrame([(json.dumps(b),) for b in bodies], "body string")).collect()
    assert {(json.loads(r.raw)["id"], r.action_type) for r in got} == {("1", "cash_dividend"), ("2", "stock_dividend"), ("3", "stock_dividend"), ("4", "cash_dividend")}


def test_writes_replace_their_folders(spark, bars, tmp_path):
    root = str(tmp_path / "bars")
    full = bars.withColumns({"year": F.year("ts_utc"), "date": F.date_format("ts_utc", "yyyy-MM-dd")})
    for _ in range(2):
        tables.write_bars(full, root)
    assert tables.read_bars(spark, root).count() == 3 and tables.read_bars(spark, root, "AAPL", "2025-11-03").count() == 3 and tables.read_bars(spark, root, "X").count() == 0
    assert tables.read_bars(spark, str(tmp_path / "none")).count() == 0 and tables.missing_columns(bars.drop("open")) == ["open"] and set(CANONICAL_BAR) <= set(bars.columns)


def test_snapshot_and_mart(spark, tmp_path):
    rows = [("1", "AAPL", "cash_dividend", "s", None, None, "2025-01-10", None, None, 0.2, None, "USD", h, "{}") for h in ("a", "b")]
    df = spark.createDataFrame(rows, DIVIDEND)
    meta = tables.write_snapshot(df, str(tmp_path / "snap"))
    snap = tables.read_snapshot(spark, str(tmp_path / "snap"))
    assert meta["record_count"] == 1 and snap.first().source_payload_hash == "b"
    tables.write_mart(snap, str(tmp_path / "mart"))
    assert tables.read_mart(spark, str(tmp_path / "mart")).first().year == 2025 and tables.inspect_mart(spark, str(tmp_path / "mart"), {"record_count": 1}) == []
    assert tables.inspect_mart(spark, str(tmp_path / "mart"), {"record_count": 9}) and tables.inspect_mart(spark, str(tmp_path / "no"))
    with pytest.raises(ValueError):
        tables.write_mart(snap, str(tmp_path / "curated" / "x"))
    with pytest.raises(ValueError):
        tables.write_mart(snap.withColumn("ex_date", F.lit(None).cast("string")), str(tmp_path / "mart2"))


CALLS: list = []


def fake(url, params):
    n = len(CALLS)
    CALLS.append(params)
    if n == 0:
        return 503, ""
    page = {"bars": [{"t": "2025-01-02T00:00:00Z", "o": 1, "h": 2, "l": 1, "c": 2, "v": 3}], "next_page_token": None if params.get("page_token") else "p2"}
    return 200, json.dumps(page)


def test_rest_source_pages_and_retries():
    CALLS.clear()
    waits = []
    got = list(rest.pages(fake, "u", {}, waits.append))
    assert len(got) == 2 and len(waits) == 1 and 1 <= waits[0] <= 1.25
    with pytest.raises(RuntimeError, match="status 404"):
        rest.fetched(lambda u, p: (404, ""), "u", {})
    with pytest.raises(RuntimeError, match="no answer"):
        rest.fetched(lambda u, p: (500, ""), "u", {}, waits.append)
    reader = rest.BarsReader({"symbols": "a, b,a", "transport": f"{__name__}:fake"})
    assert [p.symbol for p in reader.partitions()] == ["A", "B"] and len(list(reader.read(reader.partitions()[0]))) == 2


def fake_actions(url: str, params: dict) -> tuple[int, str]:
    """Two pages: dividends in groups below corporate_actions, then groups at the top."""
    cash = [{"id": f"c-{s}", "symbol": s, "ex_date": "2025-01-10", "process_date": "2025-01-15", "rate": "0.25"} for s in params["symbols"].split(",")]
    if params.get("page_token"):
        return 200, json.dumps({"stock_dividends": [{"id": "s-" + params["symbols"], "symbol": "MSFT", "ex_date": "2025-02-10", "process_date": "2025-02-15", "stock_amount": "0.05"}], "next_page_token": None})
    return 200, json.dumps({"corporate_actions": {"cash_dividends": cash}, "next_page_token": "2"})


def test_rest_dividends_reach_the_snapshot(spark):
    options = {"symbols": "aapl, msft,aapl,x", "symbolsPerRequest": "2", "transport": f"{__name__}:fake_actions"}
    reader = rest.DividendsReader(options)
    assert [p.symbols for p in reader.partitions()] == [["AAPL", "MSFT"], ["X"]]
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert [(r[0], r[1]) for r in rows] == [("AAPL,MSFT", 0), ("AAPL,MSFT", 1), ("X", 0), ("X", 1)]
    flat = dv.flatten_payloads(spark.createDataFrame(rows, rest.PAGES)).collect()
    assert sorted((r.action_type, json.loads(r.raw)["id"]) for r in flat) == [("cash_dividend", "c-AAPL"), ("cash_dividend", "c-MSFT"), ("cash_dividend", "c-X"), ("stock_dividend", "s-AAPL,MSFT"), ("stock_dividend", "s-X")]


@pytest.mark.parametrize("bad", [{"types": "merger"}, {"limit": "0"}, {"limit": "1001"}, {"sort": "up"}, {"symbolsPerRequest": "0"}])
def test_rest_dividends_options(bad):
    with pytest.raises(ValueError):
        rest.DividendsReader({"symbols": "a"} | bad)


def test_rest_pages_of_another_form():
    with pytest.raises(RuntimeError, match="no JSON object"):
        rest.fetched(lambda u, p: (200, "[]"), "u", {})
    with pytest.raises(ValueError, match="symbols"):
        rest.DividendsReader({"symbols": " ,"}).partitions()


def test_rest_dividends_as_a_source(spark):
    spark.dataSource.register(rest.RestDividends)
    with pytest.raises(Exception, match="limit must be"):
        spark.read.format("rest_dividends").option("symbols", "a").option("limit", "5000").load().collect()


def fake_days(url: str, params: dict) -> tuple[int, str]:
    """A bar a day; symbol BAD fails on its second page of 2025-01-03."""
    if "/BAD/" in url and params["start"] == "2025-01-03" and params.get("page_token"):
        return 403, ""
    bar = {"t": params["start"] + ("T10:01:00Z" if params.get("page_token") else "T10:00:00Z"), "o": 1, "h": 2, "l": 1, "c": 2, "v": 3}
    return 200, json.dumps({"bars": [bar], "next_page_token": None if params.get("page_token") else "2"})


def fake_logged(url: str, params: dict) -> tuple[int, str]:
    """As fake_days; each first page adds a line to the file that the url begins with."""
    if not params.get("page_token"):
        log, _, symbol = url.removesuffix("/bars").partition("/v2/stocks/")
        with open(log, "a") as f:
            f.write(f"{symbol} {params['start']}\n")
    return fake_days(url, params)


def test_backfill_as_a_stream_fetches_no_window_twice(spark, tmp_path):
    root, log = str(tmp_path / "bars"), tmp_path / "log"
    options = {"symbols": "ok,bad,c", "start": "2025-01-02", "end": "2025-01-09", "transport": f"{__name__}:fake_logged", "url": str(log), "windowsPerBatch": "4"}
    for end, days in (("2025-01-09", 5), ("2025-01-09", 5), ("2025-01-16", 10)):  # stopped, started again, and again when there is more to fetch
        query = stream_backfill(spark, options | {"end": end}, root, str(tmp_path / "cp"), str(tmp_path / "failures"))
        query.processAllAvailable()
        query.stop()
        asked = log.read_text().split("\n")[:-1]
        assert len(asked) == len(set(asked)) == 3 * days
    got = {(r.symbol, r["count"]) for r in tables.read_bars(spark, root).groupBy("symbol").count().collect()}
    assert got == {("OK", 20), ("C", 20), ("BAD", 18)}  # one window of BAD fails
    failed = spark.read.option("header", True).csv(str(tmp_path / "failures")).collect()
    assert [(r.symbol, r.date) for r in failed] == [("BAD", "2025-01-03")]


def test_stream_of_windows_plans_by_offsets(tmp_path):
    options = {"symbols": "a,b", "start": "2025-01-02", "end": "2025-01-08", "windows": "day", "progress": str(tmp_path / "p.json"), "windowsPerBatch": "3", "ratePerMinute": "60", "transport": f"{__name__}:fake_days"}
    r = rest.BarsStream(options)
    assert (r.initialOffset(), r.latestOffset()) == ({"next": 0}, {"next": 3}) and r.partitions({"next": 0}, {"next": 0}) == []
    own = r.partitions({"next": 0}, {"next": 3})
    assert [(p.symbol, p.windows, p.wait) for p in own] == [("A", [("2025-01-02", "2025-01-03"), ("2025-01-03", "2025-01-04")], 2.0), ("B", [("2025-01-02", "2025-01-03")], 2.0)]
    assert r.latestOffset() == {"next": 6} and rest.BarsStream(options).latestOffset() == {"next": 6}
    waits = []
    rows = list(rest.bars_of(options, fake_days, "A", own[0].windows, 2.0, waits.append))
    assert len(rows) == 4 and waits == [2.0] * 4 and [x[-3] for x in rows] == [0, 1, 2, 3]
    r.partitions({"next": 3}, {"next": 6})
    assert r.latestOffset() == {"next": 8} == rest.BarsStream(options).latestOffset()
    for bad in ({"progress": ""}, {"windowsPerBatch": "0"}, {"ratePerMinute": "-1"}):
        with pytest.raises(ValueError):
            rest.BarsStream(options | bad)


def test_backfill_goes_on_after_failures(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "cp"))
    options = {"symbols": "ok,bad", "start": "2025-01-02", "end": "2025-01-06", "transport": f"{__name__}:fake_days"}
    for _ in range(2):  # a second run replaces the bars and appends to the failures
        got = backfill_bars(spark, options, str(tmp_path / "bars"), str(tmp_path / "failures"))
        assert sorted(map(tuple, got.collect())) == [("BAD", 2, 1), ("OK", 4, 0)]
    bars = tables.read_bars(spark, str(tmp_path / "bars")).groupBy("symbol", "date").count().collect()
    assert sorted(map(tuple, bars)) == [("BAD", "2025-01-02", 2), ("OK", "2025-01-02", 2), ("OK", "2025-01-03", 2)]
    failed = spark.read.option("header", True).csv(str(tmp_path / "failures")).collect()
    assert [(r.symbol, r.date) for r in failed] == [("BAD", "2025-01-03")] * 2 and "403" in failed[0].error


def test_windows():
    assert rest.windows("2024-11-29", "2024-12-03", "day") == [("2024-11-29", "2024-11-30"), ("2024-12-02", "2024-12-03")]
    assert rest.windows("2024-11-15", "2025-01-10", "month") == [("2024-11-15", "2024-12-01"), ("2024-12-01", "2025-01-01"), ("2025-01-01", "2025-01-10")]
    assert rest.windows("2024-11-15", "2025-01-10", "year") == [("2024-11-15", "2025-01-01"), ("2025-01-01", "2025-01-10")]
    assert rest.windows("2025-01-10", "2025-01-10", "month") == [] and rest.windows(None, None) == [(None, None)]


def test_run_names_and_statuses(spark):
    assert rollup.run_id("bars_1m", "1min", "2025-11-01", None) == "qa_bars_1m_1min_2025-11-01_ALL_XNYS"
    rows = spark.createDataFrame([("PASS",), (" warn ",), ("FAIL",), ("?",), (None,)], "overall_status string")
    assert [r[0] for r in rows.select(rollup.handoff_status()).collect()] == ["passed", "warning", "failed", "available", "available"]


def test_backfill_keeps_the_last(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "cp"))
    (tmp_path / "raw").mkdir()
    for i, close in enumerate(("1.5", "1.7")):
        row = {"symbol": "a", "timestamp": "2025-01-02T09:00:00Z", "open": "1", "high": "2", "low": "1", "close": close, "volume": "1", "ordinal": i}
        (tmp_path / f"raw/{i}.json").write_text(json.dumps(row) + "\n")
        run_backfill(spark, str(tmp_path / "raw"), str(tmp_path / "bars"), str(tmp_path / "state")).awaitTermination(60)
    assert [r.close for r in tables.read_bars(spark, str(tmp_path / "bars")).collect()] == [1.7]
