"""What Parquet footers tell of a table in folders: rows, and lowest and highest values, without reading a column.

Files are listed by tasks and their footers read by tasks, so that an answer costs a few kilobytes a file. A file of which a
footer doesn't tell enough (no statistics, as of INT96 timestamps, or a key that isn't the same in a whole row group) is
read; results are those of a scan in any case."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from . import files
from .listing import listing

TOLD = "relative_path string, symbol string, date string, row_group int, n_rows long, stats map<string,struct<low:string,high:string,n_nulls:long>>"
STATS = pa.map_(pa.string(), pa.struct([("low", pa.string()), ("high", pa.string()), ("n_nulls", pa.int64())]))
#: Files whose footers a task reads at least.
FILES = 200
MICROS = {"s": 1_000_000, "ms": 1000, "us": 1}


def _text(value, kind: pa.DataType) -> str | None:
    """A bound as text: timestamps as microseconds since 1970. None where it can't be told exactly, as for longer fractions."""
    if value is None:
        return None
    if pa.types.is_timestamp(kind):
        if kind.unit == "ns":
            whole, rest = divmod(pa.scalar(value, kind).value, 1000)
            return None if rest else str(whole)
        return str(pa.scalar(value, kind).value * MICROS[kind.unit])
    return str(value) if isinstance(value, str | int | bool) else None


def _told(path: str, columns: list[str]):
    fs, inner = files.located(path)
    with fs.open_input_file(inner) as f:
        meta = pq.read_metadata(f)
    schema, places = meta.schema.to_arrow_schema(), {meta.schema.column(i).path: i for i in range(meta.num_columns)}
    for g in range(meta.num_row_groups):
        own, stats = meta.row_group(g), []
        for c in columns:
            s = own.column(places[c]).statistics if c in places else None
            if s is None or not s.has_null_count:
                continue
            low, high = (_text(s.min, schema.field(c).type), _text(s.max, schema.field(c).type)) if s.has_min_max else (None, None)
            if low is not None and high is not None or s.null_count == own.num_rows:
                stats.append((c, {"low": low, "high": high, "n_nulls": s.null_count}))
        yield g, own.num_rows, stats


def footers(spark: SparkSession, root: str, columns: tuple[str, ...] = ("ts_utc", "timeframe"), pattern: str = r".*\.parquet") -> DataFrame:
    """TOLD: a row for each row group of the files below root, with the statistics of columns as far as the footer has them (null_count all: low and high null)."""
    names = list(columns)

    def run(batches):
        for b in batches:
            rows: list[tuple] = []
            for path, symbol, date in zip(*(b.column(c).to_pylist() for c in ("relative_path", "symbol", "date")), strict=True):
                rows += [(path, symbol, date, *x) for x in _told(f"{root.rstrip('/')}/{path}", names)]
            cols = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), STATS)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [f.split()[0] for f in TOLD.split(", ")])

    found = stored(listing(spark, root, pattern).select("relative_path", "symbol", "date"))
    tasks = max(1, min(found.count() // FILES, int(spark.conf.get("spark.sql.shuffle.partitions")) * 8))
    return found.repartition(tasks, "relative_path").mapInArrow(run, TOLD)


def row_counts(spark: SparkSession, root: str) -> DataFrame:
    """dataset (the first folder below root), file_count and row_count."""
    told = footers(spark, root, ()).groupBy("relative_path").agg(F.sum("n_rows").alias("n"))
    return told.groupBy(F.substring_index("relative_path", "/", 1).alias("dataset")).agg(F.count("*").alias("file_count"), F.sum("n").alias("row_count"))


def bounds(spark: SparkSession, root: str, schema: T.StructType, ts: str = "ts_utc", by: tuple[str, ...] = ("symbol", "timeframe")) -> DataFrame:
    """by, min_ts, max_ts and row_count of a table in symbol=/date= folders below root, as a scan gives them.

    by: folder columns, or columns that a row group has one value of; other files are read."""
    folders = [c for c in by if c in ("symbol", "date")]
    inner = [c for c in by if c not in folders]
    groups = footers(spark, root, (ts, *inner)).withColumn("at", F.col("stats")[ts])
    enough = F.col("at").isNotNull()
    for c in inner:
        s = F.col("stats")[c]
        enough = enough & F.coalesce((s["n_nulls"] == F.col("n_rows")) | ((s["n_nulls"] == 0) & (s["low"] == s["high"])), F.lit(False))
    whole = stored(groups.withColumn("enough", enough))
    unsaid = whole.groupBy("relative_path").agg(F.bool_and("enough").alias("enough")).where("NOT enough").select("relative_path")
    micros = [F.timestamp_micros(F.col("at")[k].cast("long")).alias(k) for k in ("low", "high")]
    parts = whole.join(unsaid, "relative_path", "left_anti").select(*folders, *(F.col("stats")[c]["low"].alias(c) for c in inner), *micros, "n_rows")
    if not unsaid.isEmpty():
        inside = files.located(root)[1].rstrip("/")
        path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        read = spark.read.schema(schema).parquet(root).withColumn("of", F.substring(path, F.instr(path, inside) + len(inside) + 1, F.lit(1 << 20)))
        rows = read.join(unsaid.withColumnRenamed("relative_path", "of"), "of", "left_semi").select(*by, F.col(ts).alias("low"), F.col(ts).alias("high"), F.lit(1).cast("long").alias("n_rows"))
        parts = parts.unionByName(rows)
    return parts.groupBy(*by).agg(F.min("low").alias("min_ts"), F.max("high").alias("max_ts"), F.sum("n_rows").alias("row_count"))
