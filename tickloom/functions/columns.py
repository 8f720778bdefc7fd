"""Column functions that several operators share."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Minute boundaries from start to end."""
    a, b = (F.unix_timestamp(F.date_trunc("minute", col(c)).cast("timestamp")) for c in (start, end))
    return ((b - a) / 60).cast("long")


def in_window(ts: str | Column, start: datetime | str | None, end: datetime | str | None) -> Column:
    """start <= ts < end; a side that is None is open."""
    out = F.lit(True)
    if start is not None:
        out = out & (col(ts) >= F.lit(start).cast("timestamp_ntz"))
    return out if end is None else out & (col(ts) < F.lit(end).cast("timestamp_ntz"))


def in_dates(ts: str | Column, start: date | str, end: date | str) -> Column:
    """start <= day of ts <= end: both days count."""
    return F.to_date(col(ts)).between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def iso_date(c: str | Column) -> Column:
    """The date of yyyy-mm-dd text; null for other spellings."""
    c = F.trim(col(c))
    return F.when(c.rlike(ISO_DATE), F.try_to_date(c))


def cleaned(c: str | Column) -> Column:
    """Trimmed text; null if blank."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def symbol_of(c: str | Column) -> Column:
    return F.upper(cleaned(c))


def sessions(start: str | Column, end: str | Column) -> Column:
    """The weekdays from start to end, both included."""
    return F.filter(F.sequence(col(start), col(end)), lambda d: F.weekday(d) < 5)


def utc_text(ts: str | Column) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def is_utc_text(c: str | Column) -> Column:
    """Whether text is a time as YYYY-MM-DDTHH:MM:SSZ; null counts as none."""
    shaped = col(c).rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$")
    return F.coalesce(shaped & F.try_to_timestamp(col(c)).isNotNull(), F.lit(False))


def parsed_list(c: str | Column) -> Column:
    """Symbols of a text list: brackets and quotes are dropped; `,`, `|` and `;` separate."""
    parts = F.split(F.regexp_replace(col(c), r"[\[\]'\"]", ""), r"[,|;]")
    return F.filter(F.transform(parts, F.trim), lambda s: s != "")


def partitions_of(path: str | Column) -> Column:
    """The key=value parts of a path, as a map in the order of the keys."""
    parts = F.filter(F.split(col(path), "/"), lambda p: p.contains("="))
    pairs = F.transform(parts, lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), F.regexp_replace(p, r"^[^=]*=", "").alias("v")))
    return F.map_from_entries(F.array_sort(pairs))
