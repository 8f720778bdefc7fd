"""Backfills of curated bars from the REST source: what fails is written beside and doesn't stop the rest, or stops all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.normalize import normalize_bars
from ..schemas import BAR
from ..session import checkpointed
from .rest import RestBars
from .tables import write_bars


def backfill_bars(spark: SparkSession, options: dict[str, str], root: str, failures: str, source: str = "api", timeframe: str = "1Min") -> DataFrame:
    """Replaces the (symbol, date) folders below root that bars came for; appends symbol, date and error of windows that
    failed to the CSV folder failures. Minute bars are asked for by weekday, others by month, unless options say otherwise.
    Returns rows and failures of each symbol. Symbols are spread over tasks; each page is fetched once (a checkpoint)."""
    spark.dataSource.register(RestBars)
    asked = {"windows": "day" if timeframe == "1Min" else "month", "timeframe": timeframe, "onError": "record"} | options
    got = spark.read.format("rest_bars").options(**asked).load()
    got = checkpointed(got)
    bars = got.where("error IS NULL").drop("window_start", "error")
    write_bars(normalize_bars(bars, F.col("symbol"), source, timeframe).select(*BAR.names), root)
    failed = got.where("error IS NOT NULL")
    if not failed.isEmpty():
        failed.select("symbol", F.col("window_start").alias("date"), "error").write.mode("append").option("header", True).csv(failures)
    return got.groupBy("symbol").agg(F.count_if(F.col("error").isNull()).alias("rows"), F.count_if(F.col("error").isNotNull()).alias("failures"))


def backfill_daily(spark: SparkSession, options: dict[str, str], root: str, source: str = "api") -> DataFrame:
    """Daily bars by month (or the windows that options say); the first window that fails raises, before anything is replaced. Returns rows of each symbol."""
    spark.dataSource.register(RestBars)
    got = checkpointed(spark.read.format("rest_bars").options(**({"windows": "month", "timeframe": "1Day", "onError": "fail"} | options)).load())
    write_bars(normalize_bars(got.drop("window_start", "error"), F.col("symbol"), source, "1D").select(*BAR.names), root)
    return got.groupBy("symbol").agg(F.count("*").alias("rows"))
