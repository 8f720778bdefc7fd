"""Exchanges' calendars against their public yearly counts and closed days."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.functions import calendars
from tickloom.operators import gaps

COUNTS = {
    "XNYS": {2019: 252, 2020: 253, 2021: 252, 2022: 251, 2023: 250, 2024: 252}, "XLON": {2019: 253, 2020: 254, 2021: 253, 2022: 250, 2023: 251, 2024: 254}, "XETR": {2021: 255, 2022: 257, 2023: 255, 2024: 254},
    "XTKS": {2017: 247, 2018: 245, 2019: 241, 2020: 243, 2021: 245, 2022: 244, 2023: 246, 2024: 245}, "XTSE": {2021: 251, 2022: 250, 2023: 250, 2024: 252}, "XASX": {2021: 254, 2022: 251, 2023: 252, 2024: 254},
}
CLOSED = {
    ("XLON", 2020): "01-01 04-10 04-13 05-08 05-25 08-31 12-25 12-28", ("XLON", 2022): "01-03 04-15 04-18 05-02 06-02 06-03 08-29 09-19 12-26 12-27", ("XETR", 2024): "01-01 03-29 04-01 05-01 12-24 12-25 12-26 12-31",
    ("XTKS", 2019): "01-01 01-02 01-03 01-14 02-11 03-21 04-29 04-30 05-01 05-02 05-03 05-06 07-15 08-12 09-16 09-23 10-14 10-22 11-04 12-31",
    ("XTKS", 2015): "01-01 01-02 01-12 02-11 04-29 05-04 05-05 05-06 07-20 09-21 09-22 09-23 10-12 11-03 11-23 12-23 12-31", ("XASX", 2022): "01-03 01-26 04-15 04-18 04-25 06-13 09-22 12-26 12-27", ("XTSE", 2021): "01-01 02-15 04-02 05-24 07-01 08-02 09-06 10-11 12-27 12-28",
}


@pytest.fixture(scope="module")
def sessions(spark):
    rows = gaps.exchange_sessions(spark, "2015-01-01", "2024-12-31").collect()
    return {name: {r.session_date: r for r in rows if r.exchange == name} for name in calendars.EXCHANGES}


@pytest.mark.parametrize("name", COUNTS)
def test_yearly_counts(sessions, name):
    assert {y: sum(d.year == y for d in sessions[name]) for y in COUNTS[name]} == COUNTS[name]
    assert [r.idx for r in sessions[name].values()] == list(range(len(sessions[name])))


@pytest.mark.parametrize("name, year", CLOSED)
def test_closed_days(sessions, name, year):
    days = [dt.date(year, 1, 1) + dt.timedelta(i) for i in range(365 + (year % 4 == 0))]
    got = [d.strftime("%m-%d") for d in days if d.weekday() < 5 and d not in sessions[name]]
    # Coming of Age Day and the third of January fall on weekends in some of these years.
    assert " ".join(got) == CLOSED[name, year]


def test_times_are_utc(sessions):
    def told(name, *day):
        r = sessions[name][dt.date(*day)]
        return [x and x.strftime("%H:%M") for x in (r.open_utc, r.close_utc, r.break_start_utc, r.break_end_utc)] + [r.minutes, r.traded_minutes]

    assert told("XNYS", 2024, 1, 5) == ["14:30", "21:00", None, None, 390, 390] and told("XNYS", 2024, 7, 3) == ["13:30", "17:00", None, None, 210, 210]
    assert told("XLON", 2024, 6, 5) == ["07:00", "15:30", None, None, 510, 510] and told("XLON", 2017, 12, 22) == ["08:00", "12:30", None, None, 270, 270] and told("XLON", 2024, 12, 31)[1] == "12:30"
    assert told("XETR", 2024, 1, 5) == ["08:00", "16:30", None, None, 510, 510] and told("XETR", 2023, 12, 29)[4] == 300 and told("XETR", 2023, 12, 28)[4] == 510
    assert told("XTKS", 2024, 11, 1) == ["00:00", "06:00", "02:30", "03:30", 360, 300] and told("XTKS", 2024, 11, 5) == ["00:00", "06:30", "02:30", "03:30", 390, 330]
    assert told("XASX", 2024, 1, 5) == ["23:00", "05:00", None, None, 360, 360] and told("XASX", 2024, 7, 5)[:2] == ["00:00", "06:00"] and told("XASX", 2022, 12, 23)[4] == 250
    assert told("XTSE", 2024, 12, 24) == ["14:30", "18:00", None, None, 210, 210]


def test_modes_of_exchanges(spark):
    days, note = gaps.expected_days("lse", "2024-12-23", "2024-12-31")
    assert note is None and [d.day for d in spark.range(1).select(days.alias("d")).first().d] == [23, 24, 27, 30, 31]
    assert gaps.expected_days("XHKG", "2024-01-01", "2024-01-02")[1] == gaps.FALLBACK_NOTE
    assert gaps.expected_bars(spark, "2024-12-23", "2025-01-01", mode="XLON").first() == (5, 510 + 270 + 510 + 510 + 270)
    assert gaps.calendar(spark, "TSX", "2024-12-24", "2024-12-27").collect() == [(0, dt.date(2024, 12, 24), 210), (1, dt.date(2024, 12, 27), 390)]
    with pytest.raises(ValueError, match="XHKG"):
        gaps.exchange_sessions(spark, "2024-01-01", "2024-01-02", ("XHKG",))


def test_coverage_joins_the_table(spark, tmp_path):
    gaps.exchange_sessions(spark, "2024-01-01", "2024-01-12", ("XNYS", "XTKS")).write.parquet(str(tmp_path / "calendars"))
    calendar = spark.read.parquet(str(tmp_path / "calendars"))
    listing = spark.createDataFrame([("A", "XNYS"), ("B", "XTKS"), ("C", "XTKS"), ("D", "XXXX"), ("E", None)], "symbol string, exchange string")
    days = [("A", "2024-01-02"), ("A", "2024-01-02"), ("A", "2024-01-06"), ("A", "2023-12-29"), ("B", "2024-01-02"), ("B", "2024-01-04"), ("D", "2024-01-04"), ("Z", "2024-01-04"), (None, "2024-01-04"), ("A", None)]
    bars = spark.createDataFrame(days, "symbol string, d string").withColumn("d", F.col("d").cast("date"))
    got = {r.symbol: tuple(r)[1:] for r in gaps.exchange_coverage(bars, listing, calendar).collect()}
    assert got == {
        "A": ("XNYS", 3, 9, 1, 8, 1, 1 / 9, "missing_days=8"), "B": ("XTKS", 2, 6, 1, 5, 1, 1 / 6, "missing_days=5"), "C": ("XTKS", 0, 6, 0, 6, 0, 0.0, "NO_ROWS; missing_days=6"),
        "D": ("XXXX", 1, 0, 0, 0, 1, None, "no_calendar"), "E": (None, 0, 0, 0, 0, 0, None, "NO_ROWS; no_calendar"),
    }
    times = [("A", "2024-01-02 14:30:00"), ("A", "2024-01-02 14:30:30"), ("A", "2024-01-02 20:59:00"), ("A", "2024-01-02 21:00:00"), ("B", "2024-01-04 00:00:00"), ("B", "2024-01-04 02:30:00"), ("B", "2024-01-04 03:30:00"), ("B", "2024-01-04 06:00:00"), ("D", "2024-01-04 01:00:00"), ("A", "2025-01-04 01:00:00")]
    minutes = gaps.exchange_minutes(spark.createDataFrame(times, "symbol string, at string").select("symbol", F.col("at").cast("timestamp").alias("ts_utc")), listing, calendar)
    assert sorted(map(tuple, minutes.collect())) == [("A", "XNYS", 9, 3510, 2, 1), ("B", "XTKS", 6, 1800, 2, 2), ("C", "XTKS", 6, 1800, 0, 0), ("D", "XXXX", 0, 0, 0, 1), ("E", None, 0, 0, 0, 0)]


def test_a_session_over_two_utc_days(spark):
    calendar = spark.createDataFrame([("X", "2024-01-02", "2024-01-01 23:00:00", "2024-01-02 05:00:00"), ("X", "2024-01-03", "2024-01-02 23:00:00", "2024-01-03 05:00:00")], "exchange string, session_date string, a string, z string")
    calendar = calendar.select("exchange", F.col("session_date").cast("date").alias("session_date"), F.col("a").cast("timestamp").alias("open_utc"), F.col("z").cast("timestamp").alias("close_utc"), *(F.lit(None).cast("timestamp").alias(c) for c in ("break_start_utc", "break_end_utc")), F.lit(360).alias("traded_minutes"))
    bars = spark.createDataFrame([("A", t) for t in ("2024-01-01 23:30:00", "2024-01-02 04:00:00", "2024-01-02 06:00:00", "2024-01-02 23:00:00", "2024-01-03 04:59:00")], "symbol string, at string").select("symbol", F.col("at").cast("timestamp").alias("ts_utc"))
    got = gaps.exchange_minutes(bars, spark.createDataFrame([("A", "X")], "symbol string, exchange string"), calendar).collect()
    assert list(map(tuple, got)) == [("A", "X", 2, 720, 4, 1)]
