"""File inventories and their reconciliation."""

from __future__ import annotations

import fnmatch
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import partitions_of
from ..sources.files import exists, located
from ..sources.listing import listing


def file_inventory(spark: SparkSession, root: str, pattern: str = "*.parquet", contents: bool = True) -> DataFrame:
    """relative_path, size_bytes, dataset, partitions and sha256 (or no contents are read) of files below root, listed and hashed by
    tasks; files stream through the hash in pieces. A missing root raises FileNotFoundError."""
    if not exists(root):
        raise FileNotFoundError(f"no folder at {root}")
    out = listing(spark, root, fnmatch.translate(pattern)).select("relative_path", "size_bytes")

    def hashed(batches):
        for b in batches:
            sums = []
            for path in b.column("relative_path").to_pylist():
                fs, inner = located(f"{root.rstrip('/')}/{path}")
                sha = hashlib.sha256()
                with fs.open_input_stream(inner, compression=None) as f:
                    while piece := f.read(1 << 20):
                        sha.update(piece)
                sums.append(sha.hexdigest())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sums, pa.string())], [*b.schema.names, "sha256"])

    if contents:
        out = out.repartition(spark.sparkContext.defaultParallelism * 4, "relative_path").mapInArrow(hashed, "relative_path string, size_bytes long, sha256 string")
    own = ["sha256"] if contents else []
    return out.select("relative_path", "size_bytes", F.substring_index("relative_path", "/", 1).alias("dataset"), partitions_of("relative_path").alias("partitions"), *own)


def dataset_summary(inventory: DataFrame) -> DataFrame:
    """dataset, file_count, total_bytes and its partition keys, joined by commas."""
    keys = F.coalesce(F.map_keys("partitions"), F.array().cast("array<string>"))
    rows = inventory.withColumn("key", F.explode_outer(keys))
    named = rows.groupBy("dataset").agg(F.array_join(F.array_sort(F.collect_set("key")), ",").alias("partition_keys"))
    return inventory.groupBy("dataset").agg(F.count("*").alias("file_count"), F.sum("size_bytes").alias("total_bytes")).join(named, "dataset")


def reconcile(expected: DataFrame, found: DataFrame) -> DataFrame:
    """relative_path and status of each file: ok, missing, extra, duplicate, size_mismatch or checksum_mismatch."""
    have = found.groupBy("relative_path").agg(F.count("*").alias("n"), F.first("size_bytes").alias("size_f"), F.first("sha256").alias("sha_f"))
    both = expected.select("relative_path", F.col("size_bytes").alias("size_e"), F.col("sha256").alias("sha_e")).join(have, "relative_path", "full_outer")
    status = (
        F.when(F.col("n").isNull(), "missing").when(F.col("size_e").isNull(), "extra").when(F.col("n") > 1, "duplicate")
        .when(F.col("size_e") != F.col("size_f"), "size_mismatch").when(F.col("sha_e") != F.col("sha_f"), "checksum_mismatch").otherwise("ok")
    )
    return both.select("relative_path", status.alias("status"))
