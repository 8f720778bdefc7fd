"""Curated bars from a folder of raw files, or from the REST source, as they come: each batch is normalized and replaces its (symbol, date) folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.normalize import keep_last, normalize_bars
from ..schemas import BAR, BAR_KEY
from ..session import checkpointed, stored
from ..sources.rest import RestBars
from ..sources.tables import read_bars, write_bars

RAW = "symbol string, timestamp string, open string, high string, low string, close string, volume string, ordinal bigint"


def run_backfill(spark: SparkSession, raw: str, root: str, checkpoint: str, source: str = "files", timeframe: str = "1Min"):
    """Starts a query that handles all files now in raw (JSON lines) and ends; bars of a key that came before give way."""
    def merge(batch: DataFrame, _: int) -> None:
        new = normalize_bars(batch, F.upper(F.trim("symbol")), source, timeframe).withColumn("ordinal", F.lit(1))
        touched = new.select("symbol", "date").distinct()
        old = read_bars(batch.sparkSession, root).join(touched, ["symbol", "date"], "left_semi").withColumn("ordinal", F.lit(0))
        merged = keep_last(old.select(*new.columns).unionByName(new), BAR_KEY).select(*BAR.names)
        write_bars(checkpointed(merged), root)  # the old rows are read before their folders are replaced

    return spark.readStream.schema(RAW).json(raw).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_backfill(spark: SparkSession, options: dict[str, str], root: str, checkpoint: str, failures: str, source: str = "api", timeframe: str = "1Min"):
    """Starts a query that fetches windows batch by batch (see rest.BarsStream) and replaces the (symbol, date) folders that bars came for.

    Windows that fail are written to failures/batch=N as CSV and don't stop the rest. Stopped and started again with the same
    options and checkpoint it goes on where it was; it never ends by itself: query.processAllAvailable() waits for all windows."""
    spark.dataSource.register(RestBars)
    asked = {"windows": "day" if timeframe == "1Min" else "month", "timeframe": timeframe, "onError": "record", "progress": f"{checkpoint}/progress.json"} | options

    def write(batch: DataFrame, number: int) -> None:
        got = stored(batch)  # each window is asked for once
        bars = normalize_bars(got.where("error IS NULL").drop("window_start", "error"), F.col("symbol"), source, timeframe, guard="plan")
        write_bars(bars.select(*BAR.names), root)
        failed = got.where("error IS NOT NULL").select("symbol", F.col("window_start").alias("date"), "error")
        if not failed.isEmpty():
            failed.write.mode("overwrite").option("header", True).csv(f"{failures}/batch={number}")

    stream = spark.readStream.format("rest_bars").options(**asked).load()
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()
