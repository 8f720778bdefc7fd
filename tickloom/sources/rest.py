"""Paged REST tables as Python data sources, with retries and backoff.

`rest_bars`: a partition for each symbol; options symbols (comma-separated), start, end, timeframe, windows (none, day -
weekdays -, month, year: pieces that are asked for one after another) and onError (fail, or record: a window that can't be
had gives one row with its error and no bars). As a stream, see BarsStream.
`rest_dividends`: a partition for each `symbolsPerRequest` symbols; a row for each page, whose body `flatten_payloads` takes
apart on the cluster; options symbols, types, start, end, limit (1 to 1000), sort (asc or desc).
Both: url, and transport, the `module:function` that gets a page: function(url, params) -> (status, body). The default is an
HTTP GET. Pages are JSON objects with a `next_page_token`, null or left out on the last."""

from __future__ import annotations

import importlib
import json
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..schemas import DIVIDEND_TYPES

SCHEMA = "symbol string, timestamp string, open double, high double, low double, close double, volume double, ordinal bigint, window_start string, error string"
PAGES = "symbols string, page int, body string"
MOST_TRIES, BASE, CAP, PAGE, MOST_ACTIONS = 5, 1.0, 30.0, 10_000, 1000


def http_get(url: str, params: dict) -> tuple[int, str]:
    from urllib.error import HTTPError
    from urllib.parse import urlencode
    from urllib.request import urlopen

    try:
        with urlopen(f"{url}?{urlencode(params)}", timeout=30) as r:
            return r.status, r.read().decode()
    except HTTPError as e:
        return e.code, ""


def fetched(get: Callable, url: str, params: dict, sleep: Callable = time.sleep) -> dict:
    """The body of a page; retries what may pass, waiting twice as long each time, with some jitter."""
    for i in range(MOST_TRIES):
        try:
            status, body = get(url, params)
        except OSError:
            status, body = 503, ""
        if status == 200:
            page = json.loads(body)
            if not isinstance(page, dict):
                raise RuntimeError(f"{url}: the page is no JSON object: {body[:100]}")
            return page
        if status != 429 and not 500 <= status <= 599:
            raise RuntimeError(f"{url}: status {status}")
        if i < MOST_TRIES - 1:
            sleep(min(CAP, BASE * 2**i) * (1 + random.random() / 4))
    raise RuntimeError(f"{url}: no answer after {MOST_TRIES} tries")


def pages(get: Callable, url: str, params: dict, sleep: Callable = time.sleep):
    params, token = {k: v for k, v in params.items() if v is not None}, None
    while True:
        page = fetched(get, url, params | ({"page_token": token} if token else {}), sleep)
        yield page
        token = page.get("next_page_token")
        if not token:
            return


def listed(text: str | None) -> list[str]:
    """The values of a comma-separated option, each once."""
    return list(dict.fromkeys(x.strip() for x in (text or "").split(",") if x.strip()))


def transport(options: dict) -> Callable:
    module, _, name = options.get("transport", f"{__name__}:http_get").partition(":")
    return getattr(importlib.import_module(module), name)


def wanted_symbols(options: dict) -> list[str]:
    symbols = listed(options.get("symbols", "").upper())
    if not symbols:
        raise ValueError("option symbols is needed")
    return symbols


@dataclass
class OneSymbol(InputPartition):
    symbol: str


@dataclass
class SomeSymbols(InputPartition):
    symbols: list[str]


def windows(start: str | None, end: str | None, unit: str = "none") -> list[tuple[str | None, str | None]]:
    """Half-open pieces of start to end: weekdays, or what lies in one calendar month or year."""
    if unit == "none":
        return [(start, end)]
    if unit not in ("day", "month", "year") or not start or not end:
        raise ValueError("windows are day, month or year, from start to end")
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    if unit == "day":
        days = [first + timedelta(i) for i in range((last - first).days)]
        return [(str(d), str(d + timedelta(1))) for d in days if d.weekday() < 5]
    begins = [date(y, m, 1) for y in range(first.year, last.year + 1) for m in (range(1, 13) if unit == "month" else (1,))]
    cuts = [first, *(d for d in begins if first < d < last), last] if first < last else []
    return [(str(a), str(z)) for a, z in zip(cuts, cuts[1:], strict=False)]


class BarsReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options, self.get = options, transport(options)

    def partitions(self):
        return [OneSymbol(s) for s in wanted_symbols(self.options)]

    def read(self, partition):
        yield from bars_of(self.options, self.get, partition.symbol, windows(self.options.get("start"), self.options.get("end"), self.options.get("windows", "none")))


def bars_of(o: dict, get: Callable, symbol: str, asked: list[tuple[str | None, str | None]], wait: float = 0.0, sleep: Callable = time.sleep) -> Iterator[tuple]:
    """Rows of a symbol's windows; a window's bars come all or not at all. wait: seconds before each page."""
    n, url = 0, f"{o.get('url', '')}/v2/stocks/{symbol}/bars"
    record = o.get("onError", o.get("onerror", "fail")) == "record"

    def paced(url: str, params: dict) -> tuple[int, str]:
        if wait:
            sleep(wait)
        return get(url, params)

    for start, end in asked:
        rows = []
        try:
            for page in pages(paced, url, {"start": start, "end": end, "timeframe": o.get("timeframe", "1Day"), "limit": PAGE}):
                for b in page.get("bars") or []:
                    rows.append((symbol, b["t"], *(float(b[k]) for k in "ohlcv"), n + len(rows), start, None))
        except Exception as e:
            if not record:
                raise
            rows = [(symbol, None, *[None] * 5, n, start, str(e)[:500])]
        yield from rows
        n += len(rows)


@dataclass
class SomeWindows(InputPartition):
    symbol: str
    windows: list[tuple[str | None, str | None]]
    wait: float


class BarsStream(DataSourceStreamReader):
    """All windows of all symbols as a stream: an offset is how many (window, symbol) pairs are done, window by window.

    Each batch takes windowsPerBatch more. The end of the last batch that was planned is kept in the file `progress`, so that
    a query that is started again goes on there: what a batch has fetched isn't fetched again, unless that batch failed.
    ratePerMinute: pages that all tasks of a batch ask for at most, shared evenly by them."""

    def __init__(self, options: dict):
        from .files import read_json

        self.options, self.get = options, transport(options)
        lower = {k.lower(): v for k, v in options.items()}
        if not (progress := lower.get("progress")):
            raise ValueError("option progress must name a file beside the checkpoint")
        self.progress, self.symbols = progress, wanted_symbols(options)
        self.windows = windows(options.get("start"), options.get("end"), options.get("windows", "none"))
        self.per, self.rate = int(lower.get("windowsperbatch", 64)), float(lower.get("rateperminute", 0))
        if self.per < 1 or self.rate < 0:
            raise ValueError("windowsPerBatch must be positive, ratePerMinute not negative")
        self.at = read_json(progress).get("next", 0)

    def initialOffset(self):
        return {"next": 0}

    def latestOffset(self):
        return {"next": min(self.at + self.per, len(self.windows) * len(self.symbols))}

    def partitions(self, start, end):
        from .files import write_json

        if end["next"] > self.at:
            self.at = end["next"]
            write_json({"next": self.at}, self.progress)
        own: dict[str, list] = {}
        for i in range(start["next"], end["next"]):
            window, symbol = divmod(i, len(self.symbols))
            own.setdefault(self.symbols[symbol], []).append(self.windows[window])
        return [SomeWindows(s, w, 60 * len(own) / self.rate if self.rate else 0.0) for s, w in own.items()]

    def read(self, partition):
        yield from bars_of(self.options, self.get, partition.symbol, partition.windows, partition.wait)


class RestBars(DataSource):
    @classmethod
    def name(cls):
        return "rest_bars"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return BarsReader(dict(self.options))

    def streamReader(self, schema):
        return BarsStream(dict(self.options))


class DividendsReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options, self.get = options, transport(options)
        self.types, self.limit, self.sort = listed(options.get("types")) or sorted(DIVIDEND_TYPES), int(options.get("limit", MOST_ACTIONS)), options.get("sort", "asc")
        self.each = int(options.get("symbolsPerRequest", options.get("symbolsperrequest", 50)))
        for bad, message in (
            (set(self.types) - set(DIVIDEND_TYPES), f"types must be of {', '.join(DIVIDEND_TYPES)}"), (not 1 <= self.limit <= MOST_ACTIONS, f"limit must be 1 to {MOST_ACTIONS}"),
            (self.sort not in ("asc", "desc"), "sort must be asc or desc"), (self.each < 1, "symbolsPerRequest must be positive"),
        ):
            if bad:
                raise ValueError(message)

    def partitions(self):
        symbols = wanted_symbols(self.options)
        return [SomeSymbols(symbols[i : i + self.each]) for i in range(0, len(symbols), self.each)]

    def read(self, partition):
        o, own = self.options, ",".join(partition.symbols)
        params = {"symbols": own, "types": ",".join(self.types), "start": o.get("start"), "end": o.get("end"), "limit": self.limit, "sort": self.sort}
        for i, page in enumerate(pages(self.get, f"{o.get('url', '')}/v1/corporate-actions", params)):
            yield own, i, json.dumps(page)


class RestDividends(DataSource):
    @classmethod
    def name(cls):
        return "rest_dividends"

    def schema(self):
        return PAGES

    def reader(self, schema):
        return DividendsReader(dict(self.options))
