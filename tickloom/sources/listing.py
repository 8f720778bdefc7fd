"""File listings as a PySpark Python data source, `file_listing`: names and sizes of the files below a folder; none is opened.

Planning goes down level by level until there are folders enough for `parts` partitions; tasks list what is below these, so
that no list of files is ever on the driver. Comparisons of dataset (the first folder), symbol and date (folders `symbol=`
and `date=`) are pushed down: a folder with another value isn't entered. The file systems are those of pyarrow.

Load a path anew for each query: Spark 4.1 keeps the filters that were pushed into a loaded table for its later queries.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, StringStartsWith

SCHEMA = "relative_path string, size_bytes bigint, dataset string, symbol string, date string"
ARROW = pa.schema([("relative_path", pa.string()), ("size_bytes", pa.int64()), ("dataset", pa.string()), ("symbol", pa.string()), ("date", pa.string())])
PARTS, ROWS = 64, 5000
#: How folders write a null.
NULL = "__HIVE_DEFAULT_PARTITION__"
#: Values that are told by folders' names, and the tests on them that can be pushed down.
FROM_FOLDERS = ("dataset", "symbol", "date")
TESTS = {
    EqualTo: lambda v, x: v == x, EqualNullSafe: lambda v, x: v == x, In: lambda v, x: v in x, StringStartsWith: lambda v, x: v.startswith(x),
    GreaterThan: lambda v, x: v > x, GreaterThanOrEqual: lambda v, x: v >= x, LessThan: lambda v, x: v < x, LessThanOrEqual: lambda v, x: v <= x,
}


@dataclass
class Folders(InputPartition):
    """Folders below the root, and whether what is below them belongs to the partition."""

    paths: list[tuple[str, bool]]


def told(relative: str) -> dict[str, str]:
    """What a folder's path says: the dataset, and the last symbol= and date= in it."""
    parts = relative.split("/") if relative else []
    out = {"dataset": parts[0]} if parts else {}
    pairs = [(k, v) for p in parts for k, mark, v in [p.partition("=")] if mark and k in ("symbol", "date")]
    return out | {k: unquote(v) for k, v in pairs if v != NULL}


class ListingReader(DataSourceReader):
    def __init__(self, options: dict):
        from .files import located

        self.fs, inner = located(options["path"])
        self.root = inner.rstrip("/") or "/"
        self.pattern, self.hidden = options.get("pattern", r".*\.parquet"), options.get("hidden", "false").lower() == "true"
        self.parts = int(options.get("parts", PARTS))
        self.tests: list[tuple[str, type, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if type(f) in TESTS and name in FROM_FOLDERS and f.value is not None:
                self.tests.append((name, type(f), f.value))
            yield f  # files may lie where no folder tells: Spark looks again

    def _wanted(self, relative: str) -> bool:
        known = told(relative)
        return all(TESTS[kind](known[name], value) for name, kind, value in self.tests if name in known)

    def _inside(self, relative: str) -> tuple[list[str], list[tuple[str, int]]]:
        """Folders to enter and files that match, directly in a folder."""
        found = self.fs.get_file_info(pafs.FileSelector(f"{self.root}/{relative}" if relative else self.root, allow_not_found=True))
        seen = [x for x in found if self.hidden or not x.base_name.startswith((".", "_"))]
        named = [(f"{relative}/{x.base_name}" if relative else x.base_name, x) for x in seen]
        folders = [p for p, x in named if x.type == pafs.FileType.Directory and self._wanted(p)]
        return sorted(folders), sorted((p, x.size) for p, x in named if x.type == pafs.FileType.File and re.fullmatch(self.pattern, x.base_name))

    def partitions(self):
        passed, level = [], [""]
        while level and len(level) < self.parts:
            following = [f for p in level for f in self._inside(p)[0]]
            passed += level
            level = following
        out = [Folders([(p, False) for p in passed])] if passed else []
        for i in range(min(self.parts, len(level))):
            out.append(Folders([(p, True) for p in level[i :: self.parts]]))
        return out

    def read(self, partition):
        rows: list[tuple] = []
        for path, below in partition.paths:
            stack = [path]
            while stack:
                folders, files = self._inside(own := stack.pop())
                stack += folders if below else []
                known = told(own)
                for name, size in files:
                    rows.append((name, size, known.get("dataset", name.split("/")[0]), known.get("symbol"), known.get("date")))
                    if len(rows) >= ROWS:
                        yield self._batch(rows)
                        rows = []
        yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [()] * len(ARROW)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, ARROW, strict=True)], schema=ARROW)


class ListingSource(DataSource):
    @classmethod
    def name(cls):
        return "file_listing"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return ListingReader(dict(self.options))


def listing(spark: SparkSession, root: str, pattern: str = r".*\.parquet", hidden: bool = False, parts: int = PARTS) -> DataFrame:
    """SCHEMA's columns of the files below root whose names match; no rows if there is no such folder. Hidden files and folders are left out unless wanted."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ListingSource)
    return spark.read.format("file_listing").options(pattern=pattern, hidden=str(hidden).lower(), parts=parts).load(root)
