"""WARC archives as a PySpark Python data source, `warc`.

Reading: whole files are packed into partitions by size; comparisons on columns that come from record headers (type,
page_id, target_uri, payload_digest, ...) are pushed into the reader, which parses each record's headers first and skips
the blocks of records that don't fit, or all payloads with option payload=false. Plain and gzip files are read.

Writing: each task writes files of its own, closed at `roll` bytes (so that a file stays a fair unit of reading); the
names of the tasks that succeeded make the manifest, files of failed attempts are ignored and deleted on abort.

Load a path anew for each query: Spark 4.1 keeps the filters that were pushed into a loaded table for its later queries.

Columns: see SCHEMA; the writer takes those of WRITTEN, in any order, extra columns are ignored. A null payload is empty.
Mode append adds files, overwrite replaces the manifest and then deletes the files that it named. A record that is cut
off, or whose length is no number, raises with its file and place.

Of rows with equal payloads and the same largest page_id each is a response; null page_ids count as smaller than others.
Rows whose page_ids are all null, too, are responses. An empty table gives an archive without records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull,
    LessThan, LessThanOrEqual, StringStartsWith, WriterCommitMessage,
)

from .common import bound_batches, maybe_broadcast, shared_dir, stored, table
from .files import joined, located, made, reader

SCHEMA = "record_id string, type string, date string, target_uri string, page_id long, payload_digest string, payload_bytes long, refers_to long, http_headers string, payload binary, file string, offset long"
ARROW = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("date", pa.string()), ("target_uri", pa.string()), ("page_id", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("http_headers", pa.string()), ("payload", pa.binary()), ("file", pa.string()), ("offset", pa.int64())])
WRITTEN = ("type", "target_uri", "page_id", "refers_to", "payload_bytes", "payload_digest", "payload")
#: Columns that are known once a record's headers are parsed.
FROM_HEADERS = {"record_id", "type", "date", "target_uri", "page_id", "payload_digest", "refers_to"}
ROLL, PLAN, DATE, MIN_REVISIT = 128 << 20, 64 << 20, "2024-01-01T00:00:00Z", 1000
MANIFEST = "_manifest.json"
TESTS = {
    EqualTo: lambda v, x: v is not None and v == x, EqualNullSafe: lambda v, x: v == x, In: lambda v, x: v is not None and v in x, IsNull: lambda v, _: v is None, IsNotNull: lambda v, _: v is not None,
    GreaterThan: lambda v, x: v is not None and v > x, GreaterThanOrEqual: lambda v, x: v is not None and v >= x, LessThan: lambda v, x: v is not None and v < x,
    LessThanOrEqual: lambda v, x: v is not None and v <= x, StringStartsWith: lambda v, x: v is not None and v.startswith(x),
}


@dataclass
class Files(InputPartition):
    paths: list[str]


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, int]] = field(default_factory=list)


def _number(text: str | None) -> int | None:
    return int(text) if text and text.lstrip("-").isdigit() else None


def _digest(text: str | None) -> str | None:
    """Hexadecimal of a `sha1:` header, whose value is base32 or hexadecimal."""
    value = (text or "").rpartition(":")[2]
    return (value.lower() if len(value) == 40 else base64.b32decode(value).hex()) if value else None


def _headers(f) -> dict[str, str] | None:
    """The next record's headers by lower-case name; None at the end of the file."""
    line = f.readline()
    while line in (b"\r\n", b"\n"):
        line = f.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record where one should begin: {line[:40]!r}")
    out, last = {}, None
    while (line := f.readline()).strip():
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[0] in " \t" and last:
            out[last] += " " + text.strip()
        else:
            name, _, value = text.partition(":")
            out[last := name.strip().lower()] = value.strip()
    return out


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.payload = options["path"], options.get("payload", "true").lower() == "true"
        self.plan_bytes = int(options.get("partitionbytes", options.get("partitionBytes", PLAN)))
        self.tests: list[tuple[str, type, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if type(f) in TESTS and name in FROM_HEADERS:
                self.tests.append((name, type(f), getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        fs, inner = located(self.path)
        name = joined(inner, MANIFEST)
        if fs.get_file_info(name).type == pafs.FileType.File:
            files = [(joined(self.path, n), size) for n, size in json.loads(fs.open_input_file(name).read())]
        else:
            info = fs.get_file_info(inner)
            found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(inner, recursive=True))
            start = self.path[: len(self.path) - len(inner)] if self.path.endswith(inner) else ""
            files = [(start + x.path, x.size) for x in found if x.path.endswith((".warc", ".warc.gz")) and not x.base_name.startswith(("_", "."))]
        out, held, total = [], [], 0
        for path, size in sorted(files):
            if held and total + size > self.plan_bytes:
                out.append(Files(held))
                held, total = [], 0
            held.append(path)
            total += size
        return [*out, *([Files(held)] if held else [])] or [Files([])]

    def read(self, partition):
        rows, held = [], 0
        for path in partition.paths:
            for row in self._records(path):
                rows.append(row)
                held += len(row["payload"] or b"") + 200
                if held > 4 << 20 or len(rows) >= 1000:
                    yield pa.RecordBatch.from_pylist(rows, schema=ARROW)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=ARROW)

    def _records(self, path: str):
        raw = reader(path)
        f = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw
        with raw:
            while True:
                at = f.tell()
                head = _headers(f)
                if head is None:
                    return
                begin, size = f.tell(), _number(head.get("content-length", "0"))
                if size is None or size < 0:
                    raise ValueError(f"{path}: the record at {at} has no valid length")
                row = {"record_id": head.get("warc-record-id"), "type": head.get("warc-type"), "date": head.get("warc-date"), "target_uri": head.get("warc-target-uri"), "page_id": _number(head.get("x-page-id")), "payload_digest": _digest(head.get("warc-payload-digest")), "refers_to": _number(head.get("x-refers-to-page-id"))}
                if all(TESTS[kind](row[name], value) for name, kind, value in self.tests):
                    http, n = None, size
                    if head.get("content-type", "").startswith("application/http"):
                        lines = []
                        while (line := f.readline()).strip() and f.tell() < begin + size:
                            lines.append(line)
                        http = b"".join(lines).decode("utf-8", "replace")
                        n = begin + size - f.tell()
                        told = next((x.partition(":")[2] for x in http.split("\r\n") if x.lower().startswith("content-length:")), None)
                    full = row["type"] != "revisit" or http is None
                    payload = f.read(n) if self.payload and full else None
                    if payload is not None and len(payload) < n:
                        raise ValueError(f"{path}: the record at {at} is cut off")
                    yield row | {"payload_bytes": n if full else _number((told or "").strip()), "http_headers": http, "payload": payload, "file": path, "offset": at}
                f.seek(begin + size + 4)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool = False):
        self.overwrite = overwrite
        self.path, self.roll, self.gzip = options["path"], int(options.get("roll", ROLL)), options.get("compression", "none").lower() == "gzip"

    def write(self, iterator):
        from pyspark import TaskContext

        fs, inner = located(self.path)
        fs.create_dir(inner, recursive=True)
        part, out, sink, size, name = TaskContext.get().partitionId(), Written(), None, 0, ""
        for b in iterator:
            for row in b.select([n for n in WRITTEN if n in b.schema.names]).to_pylist():
                if sink is None:
                    name = f"part-{part:06d}-{len(out.files):04d}-{uuid.uuid4().hex}.warc" + ".gz" * self.gzip
                    sink, size = fs.open_output_stream(joined(inner, name), compression=None), 0
                data = record(row, f"{name}:{size}")
                data = gzip.compress(data, 6, mtime=0) if self.gzip else data
                sink.write(data)
                size += len(data)
                if size >= self.roll:
                    sink.close()
                    out.files.append((name, size))
                    sink = None
        if sink is not None:
            sink.close()
            out.files.append((name, size))
        return out

    def commit(self, messages):
        fs, inner = located(self.path)
        made(self.path)
        name, before = joined(inner, MANIFEST), []
        if fs.get_file_info(name).type == pafs.FileType.File:
            before = json.loads(fs.open_input_file(name).read())
        with fs.open_output_stream(name) as f:
            f.write(json.dumps(([] if self.overwrite else before) + [x for m in messages if m for x in m.files]).encode())
        for old, _ in before if self.overwrite else []:
            fs.delete_file(joined(inner, old))

    def abort(self, messages):
        fs, inner = located(self.path)
        for m in messages:
            for name, _ in m.files if m else []:
                fs.delete_file(joined(inner, name))


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite):
        return WarcWriter(dict(self.options), overwrite)


def record(row: dict, place: str = "") -> bytes:
    """One WARC/1.1 record; of a revisit just the HTTP headers, which keep the payload's length. place: where it is written, which makes the ids of repeated rows differ."""
    payload = row.get("payload") or b""
    kind, page, uri = row.get("type") or "response", row.get("page_id"), (row.get("target_uri") or "").replace("\r", "%0D").replace("\n", "%0A")
    digest = row.get("payload_digest") or hashlib.sha1(payload).hexdigest()
    n = row["payload_bytes"] if row.get("payload_bytes") is not None else len(payload)
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode() + (payload if kind != "revisit" else b"")
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}:{uri}:{digest}:{kind}:{place}')}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    lines += [f"X-Page-ID: {page}"] if page is not None else []
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] + ([f"X-Refers-To-Page-ID: {row['refers_to']}"] if row.get("refers_to") is not None else [])
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def register(spark: SparkSession) -> None:
    bound_batches(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def with_revisits(pages: DataFrame, smallest: int = MIN_REVISIT) -> DataFrame:
    """Records of pages (page_id, url, html): of those with equal payloads of at least `smallest` bytes, the one with the largest page_id is the response.

    The largest ids of payloads that come again are counted on digests alone and broadcast if they are few; else joined by digest."""
    raw = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.col("url").alias("target_uri"), raw.alias("payload")).withColumns({"payload_digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")})
    again = rows.where(F.col("payload_bytes") >= smallest).groupBy("payload_digest").agg(F.max("page_id").alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = rows.join(maybe_broadcast(stored(again, "again")), "payload_digest", "left")
    revisit = (F.col("payload_bytes") >= smallest) & F.col("head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head"))
    return rows.select(F.when(revisit, "revisit").otherwise("response").alias("type"), "target_uri", "page_id", F.when(revisit, F.col("head")).alias("refers_to"), "payload_bytes", "payload_digest", F.when(~revisit, F.col("payload")).alias("payload"))


def op4_warc(spark, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back."""
    register(spark)
    path = f"{shared_dir(spark)}/warc"
    with_revisits(table(spark, sf_dir, "pages")).write.format("warc").mode("append").save(path)
    back = spark.read.format("warc").load(path).where(F.col("type").isin("response", "revisit"))
    return back.select("page_id", "payload_bytes", F.coalesce(F.sha1("payload"), "payload_digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")


SQL = {
    "op4_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
h AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS head FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> head THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> head THEN head END AS refers_to
FROM h"""
}
