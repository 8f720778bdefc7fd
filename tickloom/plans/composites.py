"""Composites: quality reports and exports with their artefacts, enforcement from them, ingest, event-window runs, handoff reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import in_window, parsed_list, partitions_of
from ..operators import dividends as dv
from ..operators import gaps, quality, rollup
from ..operators.event_windows import event_windows
from ..schemas import BAR_KEY
from ..session import stored
from ..sources import files, footers, tables
from ..sources.rest import RestDividends

# Columns of the artefacts, in their order.
SUMMARY = ("symbol", "timeframe", "min_ts", "max_ts", "row_count", "duplicate_keys", "ohlc_violation_count", "gap_count", "out_of_order_count", "last_updated", "notes")
BY_SYMBOL = (
    "run_id", "dataset_name", "bar_interval", "symbol", "start_ts", "end_ts", "rows_observed", "expected_bars", "coverage_pct", "duplicate_rows", "duplicate_keys", "gap_count", "gap_segments", "max_gap_len",
    "ohlc_violation_count", "first_ts", "last_ts", "notes",
)
GLOBAL = (
    "run_id", "dataset_name", "bar_interval", "start_ts", "end_ts", "total_rows", "unique_rows", "duplicate_rows", "total_duplicate_keys", "symbols_expected", "symbols_present", "symbols_missing", "total_gap_count",
    "total_ohlc_violation_count", "pct_symbols_below_coverage_threshold", "coverage_threshold", "overall_status",
)
DATASETS = {"bars_daily": "1D", "bars_1m": "1Min"}
#: Broken bars of each rule that a report shows.
SAMPLES = 50
#: Artefacts with a row for a key, or for a symbol's day.
GROWING = ("qa_duplicates", "qa_gaps_1m")


@dataclass(frozen=True)
class Report:
    exit_code: int
    reasons: list[str]
    written: list[str]


def _complete(bars: DataFrame) -> tuple[DataFrame, list[str]]:
    """bars with nulls for the canonical columns that they lack, and the names of these."""
    missing = tables.missing_columns(bars)
    kinds = {f.name: f.dataType for f in tables.BAR.fields}
    return bars.withColumns({c: F.lit(None).cast(kinds[c]) for c in missing}) if missing else bars, missing


def qa_report(bars: DataFrame | None, out: str, timeframe: str = "1Min", strict: bool = False, max_ohlc_violations: int = 0, now: str = "") -> Report:
    """Writes the quality report as CSV folders below out: qa_summary and the gaps always, duplicates and violations if there are any.

    bars: None for a dataset without files, which gets a summary of one row. strict: duplicates, more violations than are
    allowed and missing columns give exit code 1. now: the text of last_updated."""
    if bars is None:
        return _no_data(out, timeframe, now)
    bars, missing = _complete(bars)
    notes, written = F.lit(f"Missing canonical columns: {missing}" if missing else ""), []
    seen = Observation("qa_report")
    keys = stored(rollup.keyed(bars).observe(seen, F.sum("broken").alias("broken"), F.count_if(F.col("n") > 1).alias("duplicates")))  # the one pass over the bars
    totals = seen.get["broken"] or 0, seen.get["duplicates"] or 0
    summary = rollup.summary_of(keys)
    if timeframe == "1D":
        by_day = gaps.daily_gaps_by_symbol(keys.where(F.weekday("day") < 5), "day")
        side = by_day.select(F.col("symbol").alias("of"), F.col("missing_days").alias("missing"))
        summary = summary.drop("gap_count").join(side, F.col("symbol") == F.col("of"), "left").withColumn("gap_count", F.coalesce("missing", F.lit(0)).cast("long"))
        detail, name = by_day.orderBy(F.desc("missing_days"), F.desc("symbol")), "qa_gaps_daily"
    else:
        detail, name = gaps.minute_gaps_by_day(keys, rows="n").orderBy(F.desc("missing_minutes"), "symbol", "date"), "qa_gaps_1m"
    summary = summary.withColumns({"last_updated": F.lit(now), "notes": notes}).select(*SUMMARY).orderBy("timeframe", "symbol")
    parts = {"qa_summary": summary, name: detail}
    if totals[1]:
        parts["qa_duplicates"] = keys.where("n > 1").select(*BAR_KEY, F.col("n").alias("row_count")).orderBy(*BAR_KEY)
    if totals[0]:
        counts = F.array(*(F.struct(F.lit(k).alias("rule"), F.col(f"broken_{k}").alias("n")) for k in quality.report_rules()))
        rules = keys.where("broken > 0").select("symbol", F.inline(counts)).where("n > 0").groupBy("rule", "symbol").agg(F.sum("n").alias("violation_count"))
        order = [F.asc_nulls_last(c) for c in ("symbol", "ts_utc")]
        samples = quality.violation_samples(quality.on_days(bars, stored(quality.broken_days(keys, SAMPLES))), SAMPLES, order)  # reads a few days again
        parts |= {"qa_ohlc_violations": rules.orderBy(F.desc("violation_count"), "rule", "symbol"), "qa_ohlc_violations_samples": samples.select("rule", *tables.CANONICAL_BAR)}
    for name, df in parts.items():
        tables.write_csv(df, f"{out}/{name}", one=name not in GROWING)
        written.append(name)
    reasons = [f"duplicate_keys={totals[1]}"] if totals[1] else []
    reasons += [f"ohlc_violations={totals[0]} > {max_ohlc_violations}"] if totals[0] > max_ohlc_violations else []
    reasons += ["missing_canonical_columns"] if missing else []
    return Report(int(strict and bool(reasons)), reasons if strict else [], written)


def _no_data(out: str, timeframe: str, now: str) -> Report:
    spark = SparkSession.active()
    zero = {c: F.lit(0).cast("long") for c in SUMMARY[4:9]}
    row = spark.range(1).withColumns({"symbol": F.lit(None).cast("string"), "timeframe": F.lit(timeframe), "min_ts": F.lit(None).cast("timestamp"), "max_ts": F.lit(None).cast("timestamp"), **zero, "last_updated": F.lit(now), "notes": F.lit("no files")})
    tables.write_csv(row.select(*SUMMARY), f"{out}/qa_summary")
    return Report(0, [], ["qa_summary"])


@dataclass(frozen=True)
class Export:
    """What an export is of: window (end excluded), calendar, symbols that are expected (all that are present, if None)."""

    dataset: str
    interval: str = "1Min"
    start: str | None = None
    end: str | None = None
    calendar: str = "XNYS"
    symbols: tuple[str, ...] | None = None
    run: str | None = None

    @property
    def run_id(self) -> str:
        return self.run or rollup.run_id(self.dataset, self.interval, self.start, self.end, self.calendar)


def qa_export(bars: DataFrame, e: Export, thresholds: rollup.Thresholds = rollup.Thresholds()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """By-symbol, global and coverage tables of an export. Bars without a window expect no bars: their coverage is 0."""
    spark = bars.sparkSession
    bars, missing = _complete(bars)
    bars = stored(rollup.keyed(bars.where(in_window("ts_utc", e.start, e.end)))).withColumn("d", F.col("day"))  # the one pass over the bars
    inside = e.start is not None and e.end is not None
    expected, own = F.lit(0), None
    if inside:
        last = str(spark.sql("SELECT date_sub(CAST(:e AS date), 1)", args={"e": e.end}).first()[0])
        per = gaps.expected_bars(spark, e.start, e.end, mode=e.calendar)
        expected = per.select("minute_bars" if e.interval == "1Min" else "daily_bars").scalar()
    if e.interval != "1Min":
        a, z = (e.start, last) if inside else map(str, bars.agg(F.min("d"), F.max("d")).first())
        own = gaps.daily_gaps(bars, gaps.calendar(spark, e.calendar, a, z)) if a != "None" else None
    notes = [f"Missing canonical cols: {missing}"] if missing else []
    notes += ["symbols_expected not provided (derived from data)"] if e.symbols is None else []
    notes += [] if inside else ["start/end window not provided (expected_bars may be 0)"]
    notes += [gaps.FALLBACK_NOTE] if inside and gaps.expected_days(e.calendar, e.start, e.end)[1] else []
    stamp = {"run_id": F.lit(e.run_id), "dataset_name": F.lit(e.dataset), "bar_interval": F.lit(e.interval), "start_ts": F.lit(e.start).cast("string"), "end_ts": F.lit(e.end).cast("string")}
    metrics = stored(rollup.by_symbol_of(bars, expected, own))  # a row a symbol
    by_symbol = metrics.withColumns(stamp | {"notes": F.lit("; ".join(notes))}).select(*BY_SYMBOL)
    names = metrics.where("symbol IS NOT NULL").agg(F.array_sort(F.collect_set("symbol")).alias("present"))
    wanted = F.array(*map(F.lit, e.symbols)) if e.symbols else F.col("present")
    names = names.select(F.size("present").alias("symbols_present"), F.size(F.array_distinct(wanted)).alias("symbols_expected"), F.array_join(F.array_sort(F.array_except(wanted, "present")), ";").alias("symbols_missing"))
    total = rollup.qa_global(metrics, thresholds).drop("symbols_present").withColumnRenamed("pct_below", "pct_symbols_below_coverage_threshold")
    total = total.withColumns(stamp | {"coverage_threshold": F.lit(thresholds.min_coverage_pct)} | {c: names.select(F.col(c)).scalar() for c in ("symbols_present", "symbols_expected", "symbols_missing")})
    listed = spark.createDataFrame([(s,) for s in e.symbols], "symbol string") if e.symbols else metrics.where("symbol IS NOT NULL").select("symbol")
    coverage = gaps.coverage(bars, listed, e.calendar, e.start, last, rows="n") if inside else listed.limit(0)
    return by_symbol, total.select(*GLOBAL), coverage


def write_export(bars: DataFrame, e: Export, root: str, thresholds: rollup.Thresholds = rollup.Thresholds()) -> tuple[str, str]:
    """Writes an export as CSV folders below root/run_id; returns that folder and the overall status."""
    out, (by_symbol, total, coverage) = f"{root}/{e.run_id}", qa_export(bars, e, thresholds)
    for name, df in (("qa_summary_by_symbol", by_symbol.orderBy("symbol")), ("qa_summary_global", total), ("qa_coverage_by_symbol", coverage)):
        tables.write_csv(df, f"{out}/{name}")
    return out, read_metrics(bars.sparkSession, out)[1].first().overall_status


def _csv_schema(names: tuple[str, ...]) -> T.StructType:
    text = {"run_id", "dataset_name", "bar_interval", "symbol", "start_ts", "end_ts", "first_ts", "last_ts", "notes", "symbols_missing", "overall_status"}
    number = {"coverage_pct", "pct_symbols_below_coverage_threshold", "coverage_threshold"}
    return T.StructType([T.StructField(n, T.StringType() if n in text else T.DoubleType() if n in number else T.LongType()) for n in names])


def read_metrics(spark: SparkSession, run: str) -> tuple[DataFrame, DataFrame]:
    """By-symbol and global metrics of an export's folder; a missing table raises, as does a global one that hasn't one row."""
    for name in ("qa_summary_global", "qa_summary_by_symbol"):
        if not files.exists(f"{run}/{name}"):
            raise FileNotFoundError(f"no {name} in {run}")
    by_symbol, total = (spark.read.schema(_csv_schema(c)).option("header", True).csv(f"{run}/{n}") for n, c in (("qa_summary_by_symbol", BY_SYMBOL), ("qa_summary_global", GLOBAL)))
    if (n := total.count()) != 1:
        raise ValueError(f"{run}: the global summary has {n} rows")
    return by_symbol, total


def enforce_metrics(by_symbol: DataFrame, total: DataFrame, gates: rollup.Gates = rollup.Gates(), top: int = 10) -> rollup.Verdict:
    """The gates on an export's tables: missing symbols and violations go by the global row."""
    row = total.select(parsed_list("symbols_missing").alias("missing")).first()
    return rollup.enforce(by_symbol, gates, row.missing or None, top)


def enforce_artifacts(spark: SparkSession, run: str, gates: rollup.Gates = rollup.Gates(), top: int = 10) -> rollup.Verdict:
    """The gates on what an export wrote."""
    return enforce_metrics(*read_metrics(spark, run), gates, top)


def enforce_or_exit(verdict: rollup.Verdict, strict: bool) -> rollup.Verdict:
    """Raises SystemExit with the verdict's code if it failed and strict holds."""
    if strict and not verdict.passed:
        raise SystemExit(verdict.exit_code)
    return verdict


def verdict_text(verdict: rollup.Verdict, title: str, strict: bool) -> str:
    """Lines for a log: state, reasons, and the symbols that offend most."""
    state = "PASS" if verdict.passed else "FAIL" if strict else "WARN"
    lines = [f"{title}: {state}", *(f"- {r}" for r in verdict.reasons)]
    for o in verdict.offenders:
        told = ", ".join(f"{o[k]} {k.replace('_', ' ')}" for k in ("duplicate_keys", "ohlc_violation_count", "gap_count") if o[k])
        lines.append(f"  {o['symbol']}: {told}")
    return "\n".join(lines) + "\n"


def ingest_dividends(spark: SparkSession, options: dict[str, str], path: str) -> dict:
    """Fetches dividends, takes the responses apart, normalizes, deduplicates and replaces the snapshot at path; returns its metadata."""
    tables.safe_output(path)
    spark.dataSource.register(RestDividends)
    bodies = spark.read.format("rest_dividends").options(**options).load()
    flat = dv.flatten_payloads(bodies)
    fields = {f: F.get_json_object("raw", f"$.{f}") for f in dv.FIELDS}
    key = F.when(F.col("response_key").isNotNull(), F.concat(F.lit('{"_response_key":"'), F.col("response_key"), F.lit('",'), F.substring("raw", 2, 1 << 30))).otherwise(F.col("raw"))
    rows = flat.select(*(v.alias(k) for k, v in fields.items() if k != "type"), F.coalesce("action_type", fields["type"]).alias("type"), key.alias("raw"))
    return tables.write_snapshot(dv.normalize_dividends(rows), path, options.get("start"), options.get("end"), [t for t in options.get("types", "").split(",") if t] or None)


def run_event_windows(spark: SparkSession, bars: DataFrame, out: str, snapshot: str | None = None, mart: str | None = None, pre: int = 5, post: int = 5, kind: str = "contract", bars_path: str | None = None, **more) -> dict:
    """Event windows of a snapshot or a mart (one of them), written as the contract output (with its metadata), parquet or csv; returns a summary."""
    if (snapshot is None) == (mart is None):
        raise ValueError("name a snapshot or a mart")
    source = snapshot or mart
    dividends = tables.read_snapshot(spark, snapshot) if snapshot else tables.read_mart(spark, mart)
    windows = event_windows(dividends, bars, pre, post, dealt=kind == "contract", **more)
    counts = {"event_count": dividends.count(), "bar_count": bars.count()}
    said = {"source": source, "out": out, "pre": pre, "post": post, "symbol": more.get("symbol")} | counts
    if kind == "contract":
        return said | {"rows": tables.write_event_windows(windows, out, pre, post, source, bars_path, symbol=more.get("symbol"), counts=counts)["row_count"]}
    tables.write_table(windows, out, kind, [p for p in (source, bars_path) if p])
    reader = spark.read.option("header", True)
    return said | {"rows": (reader.csv if kind == "csv" else reader.parquet)(out).count()}


def dataset_inventory(listed: DataFrame) -> DataFrame:
    """For each dataset of a listing (relative_path): symbols and days from the folders' names, and files; nothing is read."""
    parts = partitions_of("relative_path")
    day = F.when(parts["date"].rlike(r"^\d{4}-\d{2}-\d{2}$"), parts["date"])
    rows = listed.select(F.substring_index("relative_path", "/", 1).alias("dataset"), parts["symbol"].alias("symbol"), day.alias("day"))
    return rows.groupBy("dataset").agg(F.array_sort(F.collect_set("symbol")).alias("symbols"), F.min("day").alias("date_min"), F.max("day").alias("date_max"), F.count("*").alias("file_count"))


def handoff_report(spark: SparkSession, curated: str, qa: str | None = None, row_counts: bool = False) -> dict:
    """What the next system finds: datasets below curated (symbols, days, files, rows if asked for) and the latest quality run with its status."""
    if not files.exists(curated):
        raise FileNotFoundError(f"no curated data at {curated}")
    found = {r.dataset: r.asDict() for r in dataset_inventory(files.listed(spark, curated)).where(F.col("dataset").isin(*DATASETS)).collect()}
    rows = {r.dataset: r.row_count for r in footers.row_counts(spark, curated).where(F.col("dataset").isin(*DATASETS)).collect()} if row_counts else {}
    datasets = {}
    for name in sorted(d for d in DATASETS if d in found or d in files.folders(curated)):
        own = found.get(name, {"symbols": [], "date_min": None, "date_max": None, "file_count": 0})
        datasets[name] = own | {"timeframe": DATASETS[name], "row_count": rows.get(name) if own["file_count"] else None}
        datasets[name].pop("dataset", None)
    days = [x for d in datasets.values() for x in (d["date_min"], d["date_max"]) if x]
    run = files.latest_run(qa) if qa else None
    status = "unknown"
    if run:
        status = "available"
        if files.exists(f"{qa}/{run}/qa_summary_global"):
            status = spark.read.option("header", True).csv(f"{qa}/{run}/qa_summary_global").select(rollup.handoff_status()).first()
            status = status[0] if status else "available"
    return {
        "report_type": "handoff", "schema_version": 1, "non_canonical": True, "curated_root": curated, "available_datasets": sorted(datasets), "datasets": datasets,
        "timeframes": sorted({d["timeframe"] for d in datasets.values()}), "symbols": sorted({s for d in datasets.values() for s in d["symbols"]}), "date_min": min(days, default=None), "date_max": max(days, default=None),
        "qa": {"status": status, "qa_root": qa, "latest_run_id": run, "artifacts": files.folders(f"{qa}/{run}") if run else []},
    }


def plan_summary(planned: DataFrame) -> DataFrame:
    """file_count and total_bytes of planned files."""
    return planned.agg(F.count("*").alias("file_count"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_bytes"))


def save_plan(listed: DataFrame, include: list[str], exclude: list[str] = ()) -> DataFrame:
    """Files (relative_path, size_bytes) at or below a prefix of include and none of exclude, by path; hidden files are left out."""
    path = F.col("relative_path")

    def below(prefixes) -> Column:
        out = F.lit(False)
        for p in dict.fromkeys(x.strip("/") for x in prefixes):
            out = out | (path == p) | path.startswith(f"{p}/") if p else F.lit(True)
        return out

    return listed.where(below(include) & ~below(exclude) & ~path.rlike(r"(^|/)[._]")).orderBy("relative_path")
