"""Sessions of calendars as column expressions: every day, weekdays, and exchanges by their public rules.

Rules are dates, weekdays of a month, days from Easter, equinoxes, days that stand in for one on a weekend, and lists of what
follows no rule. New York's early closes hold from 2013 on; EXCHANGES says from when the others' rules do.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

EVERY, WEEKDAY = ("ALL", "ALL_DAYS"), ("WEEKDAY",)
FULL = 390
# Days on which the exchange stayed closed for other reasons than its holidays.
CLOSED = ["2001-09-11", "2001-09-12", "2001-09-13", "2001-09-14", "2004-06-11", "2007-01-02", "2012-10-29", "2012-10-30", "2018-12-05", "2025-01-09"]


def _on(d: Column, month: int, day: int) -> Column:
    return (F.month(d) == month) & (F.dayofmonth(d) == day)


def _observed(d: Column, month: int, day: int, friday: bool = True) -> Column:
    """The day itself; the Monday after, if it is a Sunday; with friday, the day before, if it is a Saturday."""
    found = _on(d, month, day) | ((F.weekday(d) == 0) & _on(F.date_sub(d, 1), month, day))
    return found | ((F.weekday(d) == 4) & _on(F.date_add(d, 1), month, day)) if friday else found


def _in_week(d: Column, month: int, weekday: int, first: int) -> Column:
    """The month's one such weekday (Monday: 0) among the seven days from the first."""
    return (F.month(d) == month) & (F.weekday(d) == weekday) & F.dayofmonth(d).between(first, first + 6)


def easter(year: Column) -> Column:
    """Easter Sunday: the Gregorian computus."""

    def whole(x: Column, n: int) -> Column:
        return F.floor(x / n)

    golden, century, of = year % 19, whole(year, 100), year % 100
    leap = century - whole(century, 4) - whole(century - whole(century + 8, 25) + 1, 3)
    epact = (19 * golden + leap + 15) % 30
    sunday = (32 + 2 * (century % 4) + 2 * whole(of, 4) - epact - of % 4) % 7
    days = epact + sunday - 7 * whole(golden + 11 * epact + 22 * sunday, 451) + 114
    return F.make_date(year.cast("int"), whole(days, 31).cast("int"), (days % 31 + 1).cast("int"))


def is_holiday(d: Column) -> Column:
    """Whether the New York exchange stays closed on this weekday."""
    year = F.year(d)
    days = [
        _observed(d, 1, 1, friday=False), (year >= 1998) & _in_week(d, 1, 0, 15), _in_week(d, 2, 0, 15), d == F.date_sub(easter(year), 2), _in_week(d, 5, 0, 25),
        (year >= 2022) & _observed(d, 6, 19), _observed(d, 7, 4), _in_week(d, 9, 0, 1), _in_week(d, 11, 3, 22), _observed(d, 12, 25), d.isin([F.lit(x).cast("date") for x in CLOSED]),
    ]
    found = days[0]
    for x in days[1:]:
        found = found | x
    return found


def _moved(d: Column, month: int, day: int, saturday: int, sunday: int) -> Column:
    """The day itself, or so many days on from it if it is a Saturday, a Sunday."""
    found = _on(d, month, day)
    for weekday, by in ((5, saturday), (6, sunday)):
        found = found | ((F.weekday(F.date_sub(d, by)) == weekday) & _on(F.date_sub(d, by), month, day))
    return found


def _dates(d: Column, *days: str) -> Column:
    return d.isin([F.lit(x).cast("date") for x in days])


def _easter(d: Column, days: int) -> Column:
    return d == F.date_add(easter(F.year(d)), days)


def _london(d: Column) -> list[Column]:
    return [
        _moved(d, 1, 1, 2, 1), _easter(d, -2), _easter(d, 1), _in_week(d, 5, 0, 1) & ~_dates(d, "2020-05-04"), _in_week(d, 5, 0, 25) & ~_dates(d, "2002-05-27", "2012-05-28", "2022-05-30"),
        _in_week(d, 8, 0, 25), _moved(d, 12, 25, 2, 2), _moved(d, 12, 26, 2, 2),
    ]


def _frankfurt(d: Column) -> list[Column]:
    year = F.year(d)
    return [*(_on(d, m, n) for m, n in ((1, 1), (5, 1), (12, 24), (12, 25), (12, 26), (12, 31))), _easter(d, -2), _easter(d, 1), year.between(2015, 2021) & _easter(d, 50), year.between(2014, 2021) & _on(d, 10, 3)]


def _toronto(d: Column) -> list[Column]:
    return [
        _moved(d, 1, 1, 2, 1), (F.year(d) >= 2008) & _in_week(d, 2, 0, 15), _easter(d, -2), _in_week(d, 5, 0, 18), _moved(d, 7, 1, 2, 1), _in_week(d, 8, 0, 1), _in_week(d, 9, 0, 1), _in_week(d, 10, 0, 8),
        _moved(d, 12, 25, 2, 2), _moved(d, 12, 26, 2, 2),
    ]


def _sydney(d: Column) -> list[Column]:
    return [_moved(d, 1, 1, 2, 1), _moved(d, 1, 26, 2, 1), _easter(d, -2), _easter(d, 1), _on(d, 4, 25), _in_week(d, 6, 0, 8), _moved(d, 12, 25, 2, 2), _moved(d, 12, 26, 2, 2)]


def _equinox(d: Column, month: int, at_1980: float) -> Column:
    """The equinox's day of March or September in Japan: a formula for 1980 to 2099."""
    years = F.year(d) - 1980
    return (F.month(d) == month) & (F.dayofmonth(d) == F.floor(F.lit(at_1980) + 0.242194 * years) - F.floor(years / 4))


def _japan(d: Column) -> Column:
    """Japan's holidays by law, on any weekday, without those that stand in for one on a Sunday."""
    year = F.year(d)
    games = year.isin(2020, 2021)
    days = [
        _on(d, 1, 1), _in_week(d, 1, 0, 8), _on(d, 2, 11), (year >= 2020) & _on(d, 2, 23), (year <= 2018) & _on(d, 12, 23), _equinox(d, 3, 20.8431), _on(d, 4, 29), _on(d, 5, 3), _on(d, 5, 4), _on(d, 5, 5),
        ~games & _in_week(d, 7, 0, 15), (year >= 2016) & ~games & _on(d, 8, 11), _in_week(d, 9, 0, 15), _equinox(d, 9, 23.2488), ~games & _in_week(d, 10, 0, 8), _on(d, 11, 3), _on(d, 11, 23),
        _dates(d, "2019-04-30", "2019-05-01", "2019-05-02", "2019-10-22", "2020-07-23", "2020-07-24", "2020-08-10", "2021-07-22", "2021-07-23", "2021-08-08"),
    ]
    return reduce(or_, days)


def _tokyo(d: Column) -> list[Column]:
    """Holidays, the next day after a row of them with a Sunday in it, a day between two of them, and the turn of the year."""
    row = F.lit(False)
    for k in range(4, 0, -1):
        before = F.date_sub(d, k)
        row = _japan(before) & ((F.weekday(before) == 6) | row)
    return [_japan(d), row, _japan(F.date_sub(d, 1)) & _japan(F.date_add(d, 1)), _on(d, 1, 2), _on(d, 1, 3), _on(d, 12, 31)]


def minute(clock: str) -> int:
    """Minutes from midnight of HH:MM."""
    return int(clock[:2]) * 60 + int(clock[3:])


@dataclass(frozen=True)
class Exchange:
    """Local times as HH:MM. later: a closing time from a day on; early: the closing time of days that close early; break_: when trading rests."""

    zone: str
    opens: str
    closes: str
    holidays: Callable[[Column], list[Column]]
    closed: tuple[str, ...] = ()
    early: tuple[str, Callable[[Column], Column]] | None = None
    later: tuple[str, str] | None = None
    break_: tuple[str, str] | None = None

    def is_session(self, d: Column) -> Column:
        return (F.weekday(d) < 5) & ~reduce(or_, [*self.holidays(d), *([_dates(d, *self.closed)] if self.closed else [])])

    def close(self, d: Column) -> Column:
        """Minutes from local midnight to the close."""
        usual = F.lit(minute(self.closes))
        if self.later:
            usual = F.when(d >= F.lit(self.later[0]).cast("date"), minute(self.later[1])).otherwise(usual)
        return F.when(self.early[1](d), minute(self.early[0])).otherwise(usual) if self.early else usual


# The exchanges' public trading hours, holidays and closures. They hold from 1998 (XNYS), 2003 (XLON),
# 2010 (XETR, XTSE, XASX) and 2007 (XTKS) on; older days go by the same rules.
EXCHANGES = {
    "XNYS": Exchange("America/New_York", "09:30", "16:00", lambda d: [is_holiday(d)], early=("13:00", lambda d: _in_week(d, 11, 4, 23) | _on(d, 7, 3) | _on(d, 12, 24))),
    "XLON": Exchange("Europe/London", "08:00", "16:30", _london, ("1999-12-31", "2002-06-03", "2002-06-04", "2011-04-29", "2012-06-04", "2012-06-05", "2020-05-08", "2022-06-02", "2022-06-03", "2022-09-19", "2023-05-08"), ("12:30", lambda d: _moved(d, 12, 24, -1, -2) | _moved(d, 12, 31, -1, -2))),
    "XETR": Exchange("Europe/Berlin", "09:00", "17:30", _frankfurt, ("2007-05-28", "2017-10-31"), ("14:00", lambda d: _moved(d, 12, 30, -1, -2))),
    "XTSE": Exchange("America/Toronto", "09:30", "16:00", _toronto, ("2001-09-11", "2001-09-12"), ("13:00", lambda d: _on(d, 12, 24))),
    "XASX": Exchange("Australia/Sydney", "10:00", "16:00", _sydney, ("2022-09-22",), ("14:10", lambda d: _moved(d, 12, 24, -1, -2) | _moved(d, 12, 31, -1, -2))),
    "XTKS": Exchange("Asia/Tokyo", "09:00", "15:00", _tokyo, later=("2024-11-05", "15:30"), break_=("11:30", "12:30")),
}
ALIASES = {"NYSE": "XNYS", "LSE": "XLON", "ASX": "XASX", "JPX": "XTKS", "TSX": "XTSE"}
KNOWN = EVERY + WEEKDAY + tuple(EXCHANGES) + tuple(ALIASES)


def exchange(mode: str) -> Exchange | None:
    name = mode.strip().upper()
    return EXCHANGES.get(ALIASES.get(name, name))


def is_session(d: Column, mode: str) -> Column:
    """Whether a calendar expects this day; of a mode that isn't KNOWN, weekdays stand in."""
    if mode.strip().upper() in EVERY:
        return d.isNotNull()
    return of.is_session(d) if (of := exchange(mode)) else F.weekday(d) < 5


def session_minutes(d: Column, mode: str, breaks: bool = True) -> Column:
    """Minutes from a session's open to its close; without breaks, those in which trading rests don't count. Other calendars' sessions have FULL."""
    of = exchange(mode)
    if of is None:
        return F.lit(FULL)
    rest = 0 if breaks or of.break_ is None else minute(of.break_[1]) - minute(of.break_[0])
    return of.close(d) - minute(of.opens) - rest


def at_utc(d: Column, minutes: Column | int, zone: str) -> Column:
    """The instant that is so many minutes of local time after a day's midnight in a zone."""
    return F.to_utc_timestamp(F.timestamp_seconds(F.unix_date(d).cast("long") * 86400 + minutes * 60), zone)
