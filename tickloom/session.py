"""Session settings that all operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def configured(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, the folder that driver and executors share. Where it is unset, as in tests, a session on one machine gets a folder there; others raise."""
    context = spark.sparkContext
    place = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        place = f"file://{tempfile.mkdtemp(prefix='tickloom-')}"
        spark.conf.set("spark.checkpoint.dir", place)
    return place.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """df, computed once, written as Parquet in the shared folder and read again: later readers take the columns that they need."""
    path = f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
