"""Small files beside datasets - JSON sidecars, run folders - and listings on any file system that pyarrow knows, local paths included."""

from __future__ import annotations

import json

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .listing import listing

LISTING = "relative_path string, size_bytes bigint"


def located(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:") and "://" not in path:
        path = "file://" + path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def exists(path: str) -> bool:
    fs, inner = located(path)
    return fs.get_file_info(inner).type != pafs.FileType.NotFound


def is_file(path: str) -> bool:
    fs, inner = located(path)
    return fs.get_file_info(inner).type == pafs.FileType.File


def deleted(path: str) -> None:
    fs, inner = located(path)
    if fs.get_file_info(inner).type == pafs.FileType.Directory:
        fs.delete_dir(inner)


def json_text(value: dict) -> str:
    """Sorted keys, two spaces, a line end: equal values give equal bytes."""
    return json.dumps(value, sort_keys=True, indent=2, separators=(",", ": ")) + "\n"


def write_json(value: dict, path: str) -> None:
    fs, inner = located(path)
    fs.create_dir(inner.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(inner) as f:
        f.write(json_text(value).encode())


def read_json(path: str) -> dict:
    """The sidecar's object; empty if there is no such file."""
    fs, inner = located(path)
    if fs.get_file_info(inner).type != pafs.FileType.File:
        return {}
    with fs.open_input_file(inner) as f:
        return json.loads(f.read())


def folders(root: str) -> list[str]:
    """Names of the folders directly below root, in order; hidden ones are left out."""
    fs, inner = located(root)
    if fs.get_file_info(inner).type != pafs.FileType.Directory:
        return []
    return sorted(x.base_name for x in fs.get_file_info(pafs.FileSelector(inner)) if x.type == pafs.FileType.Directory and not x.base_name.startswith((".", "_")))


def united(*paths: list[str]) -> list[str]:
    """All paths of the lists, each once, in the order in which they come first."""
    return list(dict.fromkeys(p for own in paths for p in own))


def listed(spark: SparkSession, root: str, pattern: str = r".*\.parquet", hidden: bool = False) -> DataFrame:
    """relative_path and size_bytes of the files below root, from names alone, listed by tasks. Hidden files are left out."""
    return listing(spark, root, pattern, hidden).select("relative_path", "size_bytes")


def readiness(spark: SparkSession, root: str, datasets: tuple[str, ...] = ("bars_daily", "bars_1m")) -> DataFrame:
    """dataset, file_count and whether it is ready (has files), of all datasets that are wanted."""
    files = listed(spark, root).groupBy(F.substring_index("relative_path", "/", 1).alias("dataset")).agg(F.count("*").alias("file_count"))
    wanted = spark.createDataFrame([(d,) for d in datasets], "dataset string")
    counted = wanted.join(files, "dataset", "left").withColumn("file_count", F.coalesce("file_count", F.lit(0).cast("long")))
    return counted.withColumn("ready", F.col("file_count") > 0)


def packs(root: str) -> list[str]:
    """Archive packs below root: folders with a manifest and a folder of shards."""
    return [p for p in folders(root) if is_file(f"{root}/{p}/manifest.json") and exists(f"{root}/{p}/shards")]


def latest_run(root: str) -> str | None:
    """The last folder by name, as runs are named by their settings and dates."""
    return max(folders(root), default=None)
