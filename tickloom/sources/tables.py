"""Curated bars, dividend snapshots and marts, event windows and CSV artefacts on disk."""

from __future__ import annotations

import re
from pathlib import PurePosixPath

import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..operators.dividends import action_order, dedup_dividends, mart_rows, snapshot_metadata, source_counts
from ..functions.columns import symbol_of
from ..operators.event_windows import OUTPUT, bucket_days, event_order, event_windows
from ..schemas import BAR, CANONICAL_BAR, DIVIDEND, DIVIDEND_KEY
from ..session import stored
from . import files, versions
from .listing import listing

MART = T.StructType([*DIVIDEND.fields, T.StructField("year", T.IntegerType())])
GUARDED = ("curated", "canonical")
#: Name of the metadata beside a table's data; Spark's readers pass over it.
SIDECAR = "_dataset.json"
ANCHOR = "ex_date"
#: Folders by which a scan is pruned at most: two short texts each.
FOLDERS = 500_000
#: A file of a Parquet folder: number of its task, then of the file in it.
PART = re.compile(r"part-(\d+)-.*c(\d+)(?:\.\w+)*\.parquet")
#: Rows that a task hands over at once.
BATCH = 16_384


def safe_output(path: str, inputs: list[str] = ()) -> str:
    """path, unless it lies in a curated or canonical folder, or overlaps an input."""
    own = PurePosixPath(path.removeprefix("file:")).parts
    if any(p in GUARDED for p in own):
        raise ValueError(f"{path} is reserved for curated data")
    for i in inputs:
        other = PurePosixPath(i.removeprefix("file:")).parts
        if own[: len(other)] == other or other[: len(own)] == own:
            raise ValueError(f"{path} overlaps the input {i}")
    return path


def _read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_bars(spark: SparkSession, root: str, symbol: str | None = None, date: str | None = None) -> DataFrame:
    """Curated bars below root (symbol=/date= folders); the filters prune folders."""
    bars = _read_or_empty(spark, root, BAR)
    for name, value in (("symbol", symbol), ("date", date)):
        bars = bars if value is None else bars.where(F.col(name) == value)
    return bars


def write_bars(bars: DataFrame, root: str) -> None:
    """Replaces just the (symbol, date) folders that bars has rows for."""
    bars.sparkSession.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")  # footers have no bounds of the older kind
    rows = bars.repartition("symbol", "date")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("symbol", "date").parquet(root)


def missing_columns(df: DataFrame) -> list[str]:
    return [c for c in CANONICAL_BAR if c not in df.columns]


def read_table(spark: SparkSession, path: str, schema: T.StructType, kind: str | None = None) -> DataFrame:
    """CSV with a header or Parquet, by suffix or kind."""
    kind = kind or {"parquet": "parquet", "pq": "parquet", "csv": "csv"}.get(path.rsplit(".", 1)[-1].lower())
    if kind is None:
        raise ValueError(f"can't tell the format of {path}")
    return spark.read.schema(schema).parquet(path) if kind == "parquet" else spark.read.schema(schema).option("header", True).csv(path)


def read_partition(spark: SparkSession, root: str, schema: T.StructType, limit: int | None = None, **values) -> DataFrame:
    """Rows of a table in key=value folders whose folder columns have these values; other folders aren't listed in the scan."""
    rows = spark.read.schema(schema).parquet(root)
    for name, value in values.items():
        rows = rows.where(F.col(name) == value)
    return rows if limit is None else rows.limit(limit)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", one: bool = True) -> None:
    """One CSV file, for results of a row a symbol; or one for each task, in order, for those that grow with the bars."""
    (df.coalesce(1) if one else df).write.mode(mode).option("header", True).csv(path)


def write_table(df: DataFrame, path: str, kind: str | None = None, inputs: list[str] = ()) -> None:
    """CSV with a header or Parquet, by suffix or kind; reserved folders and inputs are refused."""
    kind = kind or path.rsplit(".", 1)[-1].lower()
    if kind not in ("csv", "parquet"):
        raise ValueError(f"can't tell the format of {path}")
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.option("header", True).csv if kind == "csv" else writer.parquet)(safe_output(path, list(inputs)))


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return _read_or_empty(spark, versions.current(path), DIVIDEND)


def write_snapshot(dividends: DataFrame, path: str, start: str | None = None, end: str | None = None, types: list[str] | None = None, keep: int = 0) -> dict:
    """Replaces the snapshot by these dividends, deduplicated and in order; writes and returns its metadata. start and end: the days that were asked for.

    keep: versions that stay (see versions.replaced(): readers never see half a snapshot); 0 overwrites a plain folder."""
    if keep:
        return versions.replaced(safe_output(path), lambda p: write_snapshot(dividends, p, start, end, types), keep)
    n = dividends.count()
    rows = dedup_dividends(dividends).select(*DIVIDEND.names)
    rows.orderBy(*action_order()).write.mode("overwrite").parquet(safe_output(path))
    written = read_snapshot(dividends.sparkSession, path)
    found = snapshot_metadata(written).first().asDict() | source_counts(written).first().asDict(recursive=True)
    metadata = found | {
        "dataset": "dividends", "format": "parquet", "event_key": list(DIVIDEND_KEY), "ingest_start_date": start, "ingest_end_date": end, "action_types": sorted(types) if types is not None else found["action_types"],
        "source": found["sources"][0] if len(found["sources"]) == 1 else None, "input_record_count": n, "written_record_count": found["record_count"], "duplicate_record_count": n - found["record_count"],
    }
    files.write_json(metadata, f"{path}/{SIDECAR}")
    return metadata


def read_mart(spark: SparkSession, root: str) -> DataFrame:
    order = [F.asc_nulls_last(c) for c in ("symbol", "year", "ex_date", "process_date", "corporate_action_type", "corporate_action_id", "source_payload_hash")]
    return _read_or_empty(spark, versions.current(root), MART).orderBy(*order)


def mart_metadata(mart: DataFrame) -> DataFrame:
    """One row: row_count, symbol_count, year_count, symbols and years, in order."""
    symbols, years = (F.array_sort(F.collect_set(c)) for c in ("symbol", "year"))
    return mart.agg(F.count("*").alias("row_count"), symbols.alias("symbols"), years.alias("years")).select("row_count", F.size("symbols").alias("symbol_count"), F.size("years").alias("year_count"), "symbols", "years")


def write_mart(dividends: DataFrame, root: str, inputs: list[str] = (), source: str | None = None, start: str | None = None, end: str | None = None, keep: int = 0) -> dict:
    """Rewrites the mart, in folders symbol=/year=; writes and returns its metadata. Rows are checked before anything is replaced.

    keep: versions that stay (see versions.replaced(): readers never see half a mart); 0 overwrites a plain folder."""
    if keep:
        return versions.replaced(safe_output(root, list(inputs)), lambda p: write_mart(dividends, p, (), source, start, end), keep)
    rows = mart_rows(dividends)
    rows.repartition("symbol", "year").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("symbol", "year").parquet(safe_output(root, list(inputs)))
    found = mart_metadata(_read_or_empty(dividends.sparkSession, root, MART)).first().asDict()
    metadata = found | {
        "dataset": "dividend_mart", "dataset_role": "research_mart", "source_dataset_role": "deterministic_snapshot", "format": "parquet", "partition_columns": ["symbol", "year"], "event_anchor": ANCHOR,
        "source_snapshot_path": source, "ingest_start_date": start, "ingest_end_date": end, "input_record_count": found["row_count"], "written_record_count": found["row_count"], "schema_fields": MART.names,
    }
    files.write_json(metadata, f"{root}/{SIDECAR}")
    return metadata


def mart_from_snapshot(spark: SparkSession, snapshot: str, root: str) -> dict:
    """The mart of a snapshot, with the snapshot's window in its metadata."""
    window = files.read_json(f"{versions.current(snapshot)}/{SIDECAR}")
    return write_mart(read_snapshot(spark, snapshot), root, [snapshot], snapshot, window.get("ingest_start_date"), window.get("ingest_end_date"))


def validate_mart(spark: SparkSession, root: str) -> dict:
    """What the mart holds, and whether it fits its metadata: valid, errors, row_count, symbols, years and what the metadata says. Never raises for a bad mart."""
    errors: list[str] = []
    whole, root = root, versions.current(root)
    try:
        metadata = files.read_json(f"{root}/{SIDECAR}")
        if not isinstance(metadata, dict):
            raise ValueError("no object")
    except ValueError as e:
        metadata = {}
        errors.append(f"metadata is no JSON object: {e}")
    if not metadata and not errors:
        errors.append("metadata is missing")
    contract = {"dataset_role": "research_mart", "source_dataset_role": "deterministic_snapshot", "partition_columns": ["symbol", "year"], "event_anchor": ANCHOR}
    errors += [f"metadata {k} must be {v}" for k, v in contract.items() if metadata and metadata.get(k) != v]
    lacking = [c for c in MART.names if c not in (metadata.get("schema_fields") or [])]
    errors += [f"metadata schema_fields lack {lacking}"] if lacking else []
    found: dict = {"row_count": 0, "symbol_count": 0, "year_count": 0, "symbols": [], "years": []}
    try:
        mart = spark.read.parquet(root)
        gone = [c for c in MART.names if c not in mart.columns]
        errors += [f"data lack {gone}"] if gone else []
        if not gone:
            mart = spark.read.schema(MART).parquet(root)
            off = F.count_if(F.year(F.try_to_date("ex_date")) != F.col("year")).alias("years"), F.count_if(F.upper(F.trim("symbol")) != F.col("symbol")).alias("symbols")
            found, wrong = mart_metadata(mart).first().asDict(), mart.agg(*off).first()
            errors += [f"{n} rows lie in the folder of another {k}" for k, n in (("year", wrong["years"]), ("symbol", wrong["symbols"])) if n]
            counts = {k: found["row_count"] for k in ("row_count", "written_record_count", "input_record_count") if k in metadata} | {k: found[k] for k in ("symbol_count", "year_count", "symbols", "years")}
            errors += [f"metadata {k} is {metadata.get(k)}, data have {v}" for k, v in counts.items() if metadata and metadata.get(k) != v]
    except AnalysisException as e:
        errors.append(f"unreadable: {e.getCondition()}")
    said = {k: metadata.get(k) for k in ("dataset", "dataset_role", "source_dataset_role", "event_anchor", "partition_columns", "schema_fields")}
    return said | found | {"root": whole, "exists": files.exists(root), "valid": not errors, "errors": errors}


def bars_near(spark: SparkSession, root: str, dividends: DataFrame, pre: int = 5, post: int = 5) -> DataFrame:
    """Curated bars below root (symbol=/date= folders) of the folders that windows of these dividends meet: the others aren't read.

    Folders are listed, those of a symbol near one of its ex_dates are kept, and the scan is pruned by them when it runs.
    They are broadcast up to FOLDERS; beyond that the scan is pruned by nothing."""
    day = F.to_date(F.try_to_timestamp(F.col("ex_date").cast("string")))
    width = bucket_days(pre, post)
    ev = dividends.select(symbol_of("symbol").alias("of"), day.alias("at")).where("at IS NOT NULL").distinct()
    ev = ev.withColumn("bucket", F.explode(F.sequence(F.floor(F.unix_date(F.date_sub("at", pre)) / width), F.floor(F.unix_date(F.date_add("at", post)) / width))))
    found = listing(spark, root).select("symbol", "date").distinct().where("symbol IS NOT NULL AND date IS NOT NULL").withColumn("on", F.try_to_date("date")).withColumn("in", F.floor(F.unix_date("on") / width))
    near = (symbol_of("symbol") == F.col("of")) & (F.col("in") == F.col("bucket")) & F.col("on").between(F.date_sub("at", pre), F.date_add("at", post))
    wanted = stored(found.join(ev, near, "left_semi").select("symbol", "date"))
    bars, wanted = read_bars(spark, root), wanted.where("date > ''")  # a predicate, without which Spark prunes no scan by a join
    return bars.join(F.broadcast(wanted), ["symbol", "date"], "left_semi") if wanted.count() <= FOLDERS else bars


def snapshot_windows(spark: SparkSession, snapshot: str, bars: DataFrame | str, pre: int = 5, post: int = 5, **more) -> DataFrame:
    """Event windows of a snapshot's dividends with bars, or with the curated bars below a root."""
    dividends = read_snapshot(spark, snapshot)
    return event_windows(dividends, bars_near(spark, bars, dividends, pre, post) if isinstance(bars, str) else bars, pre, post, **more)


def mart_windows(spark: SparkSession, root: str, bars: DataFrame | str, pre: int = 5, post: int = 5, **more) -> DataFrame:
    """Event windows of a mart's dividends with bars, or with the curated bars below a root."""
    dividends = _read_or_empty(spark, versions.current(root), MART)
    return event_windows(dividends, bars_near(spark, bars, dividends, pre, post) if isinstance(bars, str) else bars, pre, post, **more)


def _in_order(path: str) -> list[str] | None:
    """Names of the Parquet files in a folder, by task and number: the order of their rows, if these were sorted when written. None if other files lie there."""
    fs, inner = files.located(path)
    found = [x.base_name for x in fs.get_file_info(pafs.FileSelector(inner)) if x.base_name[0] not in "._"]
    parts = {n: PART.fullmatch(n) for n in found}
    return sorted(found, key=lambda n: tuple(map(int, parts[n].groups()))) if all(parts.values()) else None


def _one_by_one(spark: SparkSession, path: str, names: list[str], columns: list[str]) -> DataFrame:
    """Columns of these files below path, a partition for each file, in their order, which a scan doesn't keep."""
    schema = spark.read.parquet(path).select(*columns).schema
    shape, wanted = to_arrow_schema(schema), schema.names

    def run(batches):
        for b in batches:
            for name in b.column("name").to_pylist():
                fs, inner = files.located(f"{path}/{name}")
                with fs.open_input_file(inner) as f, pq.ParquetFile(f, coerce_int96_timestamp_unit="us") as rows:
                    for x in rows.iter_batches(BATCH, columns=wanted):
                        yield x.select(wanted).cast(shape)

    # numbers of names are dealt to partitions in order, one to each
    return spark.range(0, len(names), 1, len(names)).select(F.element_at(F.lit(names), (F.col("id") + 1).cast("int")).alias("name")).mapInArrow(run, schema)


def write_event_windows(windows: DataFrame, path: str, pre: int, post: int, dividends: str | None = None, bars: str | None = None, timeframe: str = "1D", symbol: str | None = None, anchor: str = ANCHOR, counts: dict | None = None, keep: int = 0) -> dict:
    """Replaces the contract output by these windows, in order; writes and returns its metadata. The paths of the inputs must not overlap it.

    keep: versions that stay (see versions.replaced()); 0 overwrites a plain folder."""
    if anchor != ANCHOR:
        raise ValueError(f"unsupported anchor {anchor}; {ANCHOR} is supported")
    safe_output(path, [p for p in (dividends, bars) if p])
    if files.is_file(path):
        raise ValueError(f"{path} is a file, not a folder")
    if keep:
        return versions.replaced(path, lambda p: write_event_windows(windows, p, pre, post, dividends, bars, timeframe, symbol, anchor, counts), keep)
    windows.select(*OUTPUT).orderBy(*event_order()).write.mode("overwrite").parquet(path)
    n = windows.sparkSession.read.parquet(path).count()
    metadata = {
        "dataset": "dividend_event_windows", "format": "parquet", "source_dividend_path": dividends, "source_bar_path": bars, "event_anchor": anchor, "pre_window_days": pre, "post_window_days": post,
        "bar_timeframe": timeframe, "symbol_filter": symbol, "event_count": None, "bar_count": None, "joined_row_count": n, "row_count": n, "schema_fields": list(OUTPUT), "ordered_files": _in_order(path),
    } | (counts or {})
    files.write_json(metadata, f"{path}/{SIDECAR}")
    return metadata


def read_event_windows(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The contract output (or these columns of it), in its order; a missing one raises FileNotFoundError.

    Files that the metadata names, and no others, were sorted when written and are read one after the other; others are sorted."""
    try:
        path, columns = versions.current(path), columns or list(OUTPUT)
        rows = spark.read.parquet(path)
        names = files.read_json(f"{path}/{SIDECAR}").get("ordered_files")
        if names and names == _in_order(path):
            return _one_by_one(spark, path, names, columns)
        return rows.select(*OUTPUT).orderBy(*event_order()).select(*columns)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no event windows at {path}") from e


def inspect_mart(spark: SparkSession, root: str, metadata: dict | None = None) -> list[str]:
    """What is wrong with a mart; an empty list if nothing is. Never raises for a bad mart."""
    try:
        mart = spark.read.parquet(root)
    except AnalysisException as e:
        return [f"unreadable: {e.getCondition()}"]
    issues = [f"missing column {c}" for c in MART.names if c not in mart.columns]
    if not issues and metadata:
        got = mart.agg(F.count("*").alias("record_count"), F.countDistinct("symbol").alias("symbol_count")).first().asDict()
        issues += [f"{k}: {metadata[k]} recorded, {v} found" for k, v in got.items() if k in metadata and metadata[k] != v]
    return issues


def read_symbols(spark: SparkSession, path: str) -> DataFrame:
    """Upper-case symbols of a text file, a line each; blank lines and comments (#) are left out."""
    name = F.upper(F.trim("value"))
    return spark.read.text(path).where((name != "") & ~F.trim("value").startswith("#")).select(name.alias("symbol"))
