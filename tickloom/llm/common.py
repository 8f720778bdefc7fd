"""Helpers the operators share: tables, the cluster's shared folder, size-checked broadcasts, words."""

from __future__ import annotations

import ctypes
import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session

#: Rows and bytes of one Arrow batch, so that long texts do not gather in one Python worker.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20
#: Rows up to which a side is broadcast after it was counted.
BROADCAST_ROWS = 1_000_000
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """The same bounds for all operators: lazy results of several can run under one setting."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """A new folder that driver and executors share, in spark.checkpoint.dir. Where that is unset, as in tests, a session on one machine gets a folder there; others raise."""
    return f"{session.shared_dir(spark)}/{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: df written as Parquet in the shared folder and read again."""
    path = f"{shared_dir(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(columns: list[str], name: str) -> str:
    """name, with as many underscores behind it as no column has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def maybe_broadcast(df: DataFrame, rows: int | None = None, most: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if the stored df has few enough rows; else df, for a shuffled join."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= most else df


#: What empties the caches that operators keep in a Python worker, by operator.
_CACHES: dict[str, Callable[[], None]] = {}


def keeps(name: str, empty: Callable[[], None]) -> None:
    """Tells that an operator keeps a cache over tasks, and how it is emptied."""
    _CACHES[name] = empty


def claim(name: str) -> None:
    """Empties other operators' caches in this Python worker: of the stages of a pipeline one works at a time."""
    others = [empty for other, empty in _CACHES.items() if other != name]
    for empty in others:
        empty()
    if others and sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)  # gives what was freed back to the system


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs without ASCII white space, A-Z lower-cased; bytes.split() knows just \\x20 and \\x09-\\x0D."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer over an array of uint64."""
    h = (h ^ (h >> np.uint64(30))) * _MIX[1]
    h = (h ^ (h >> np.uint64(27))) * _MIX[2]
    return h ^ (h >> np.uint64(31))


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, ascending; fewer words make one shingle; none for no words."""
    if not words:
        return np.empty(0, np.uint64)
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(size, len(words))
    h = np.full(len(words) - n + 1, np.uint64(n if n < size else 0))
    for i in range(n):
        h = mixed(h * _MIX[0] + own[i : len(own) - n + 1 + i])
    return np.unique(h)


def batches(schema: pa.Schema, columns: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    for c in columns:
        yield pa.RecordBatch.from_arrays([c[f.name] if isinstance(c[f.name], pa.Array) else pa.array(c[f.name], f.type) for f in schema], schema=schema)
