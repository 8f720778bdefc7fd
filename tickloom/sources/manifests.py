"""Manifests of archive packs as tables: one JSON document with a list of files and one of shards, of any length.

Written: tasks render sorted ranges of entries into pieces, one task streams head, pieces and tail into the document, whose
counts are aggregates. Read: the document is cut where entries begin and tasks parse their parts; only what isn't an entry
comes to the driver. That needs the layout in which manifests are written (sorted keys, two spaces); others are parsed whole
up to WHOLE bytes, larger ones raise ValueError. Entries that break the contract come with an error in place of their values.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored
from . import files

PIECE, STEP, WHOLE, SHOWN = 8 << 20, 64 << 10, 64 << 20, 20
# What a manifest says of itself, of restoring, and of its standing.
KIND = {"schema_version": 1, "artifact_type": "archive_backup_pack", "canonical_status": "derived_non_canonical", "checksum_algorithm": "sha256", "shard_strategy": "size_limited_zip"}
RESTORE = {
    "expected_layout": "restore files under the recorded source_dataset_root", "paths_are_relative": True, "overwrite_policy_options": ["fail_if_exists", "overwrite"], "compatibility_schema_version": 1,
    "source_root_semantics": "workspace_relative",
}
NOTES = ["Archive backup packs are derived transfer artifacts, not canonical datasets."]
HEX = re.compile(r"[0-9a-f]{64}")
STAMP = re.compile(r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z")
FILES = "relative_path string, size_bytes long, checksum string, dataset_name string, partitions map<string,string>"
SHARDS = "shard_name string, relative_path string, shard_index long, file_count long, uncompressed_bytes long, archive_bytes long, checksum string"
ENTRIES = f"kind string, error string, file struct<{FILES}>, shard struct<{SHARDS}>"
BEGIN = b"\n    {\n"


@dataclass
class Manifest:
    header: dict  #: the document without its two lists
    files: DataFrame  #: FILES and error
    shards: DataFrame  #: SHARDS and error


def relative(path: str) -> str:
    """A path below a root in the one form that manifests use: slashes, without empty and `.` parts. Absolute, home and drive paths, empty ones and `..` raise."""
    raw = path.strip() if isinstance(path, str) else ""
    parts = [p for p in raw.replace("\\", "/").split("/") if p not in ("", ".")]
    if not parts or raw[0] in "~/\\" or re.match(r"[A-Za-z]:", raw) or ".." in parts:
        raise ValueError(f"{path!r} is no path below a root")
    return "/".join(parts)


def backup_name(root: str, created_at: str) -> str:
    """The id of a pack by its root and time."""
    slug = re.sub(r"[^a-z0-9]+", "_", root.lower()).strip("_") or "dataset"
    return f"backup_{re.sub('[-:Z]', '', created_at).replace('T', '_')}_{slug}"


def _count(value, least: int = 0) -> int:
    if type(value) is not int or value < least:
        raise ValueError(f"{value!r} is no count")
    return value


def _checksum(value) -> str | None:
    if value is not None and not (isinstance(value, str) and HEX.fullmatch(value)):
        raise ValueError(f"{value!r} is no sha256")
    return value


def entry_row(o) -> dict:
    """One entry of either list as a row of ENTRIES."""
    kind = "shard" if isinstance(o, dict) and "shard_index" in o else "file"
    try:
        if o.get("checksum_algorithm", "sha256") not in ("sha256", None):
            raise ValueError("the checksum is of another kind")
        own = {"relative_path": relative(o["relative_path"]), "checksum": _checksum(o.get("checksum"))}
        if kind == "file":
            own |= {"size_bytes": _count(o["size_bytes"]), "dataset_name": o.get("dataset_name"), "partitions": dict(sorted((o.get("partitions") or {}).items()))}
        else:
            if "/" in relative(o["shard_name"]):
                raise ValueError(f"{o['shard_name']!r} is no file name")
            own |= {"shard_name": o["shard_name"], "archive_bytes": None if o.get("archive_bytes") is None else _count(o["archive_bytes"])} | {k: _count(o[k]) for k in ("shard_index", "file_count", "uncompressed_bytes")}
        return {"kind": kind, "error": None, kind: own}
    except (KeyError, TypeError, ValueError, AttributeError) as e:
        named = o.get("relative_path") if isinstance(o, dict) else o
        return {"kind": kind, "error": f"{named}: {e}", kind: None}


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def _pieces(path: str) -> list[tuple[int, int]]:
    """Byte ranges of the document, each but the first from the begin of an entry on."""
    fs, inner = files.located(path)
    size, cuts = fs.get_file_info(inner).size, [0]
    with fs.open_input_file(inner) as f:
        for nominal in range(PIECE, size, PIECE):
            at, held = max(nominal, cuts[-1]), b""
            f.seek(at)
            while (found := held.find(BEGIN)) < 0 and (more := f.read(STEP)):
                held += more
            if found >= 0 and at + found + 1 > cuts[-1]:
                cuts.append(at + found + 1)
    return list(zip(cuts, [*cuts[1:], size], strict=True))


def _parsed(text: bytes) -> Iterator[tuple[str, str]]:
    """('entry', its JSON) and ('rest', other lines) of a part of the document."""
    rest, entry = [], None
    for line in text.decode().splitlines(keepends=True):
        if entry is None and line == "    {\n":
            entry = [line]
        elif entry is not None:
            entry.append(line)
            if line.rstrip("\n") in ("    }", "    },"):
                yield "entry", "".join(entry).rstrip(",\n")
                entry = None
        else:
            rest.append(line)
    yield "rest", "".join(rest + (entry or []))


def read_manifest(spark: SparkSession, path: str) -> Manifest:
    """The manifest at a path. What is no JSON object raises ValueError."""
    if not files.is_file(path):
        raise FileNotFoundError(f"no manifest at {path}")
    fs, inner = files.located(path)
    with fs.open_input_file(inner) as f:
        laid_out, size = f.read(4) == b'{\n  ', f.size()
    schema = _arrow(ENTRIES + ", at long, rest string")

    def rows_of(at: int, text: bytes) -> Iterator[dict]:
        for kind, own in _parsed(text):
            if kind == "entry":
                yield entry_row(json.loads(own)) | {"at": at}
            else:
                yield {"kind": "rest", "at": at, "rest": own}

    def run(batches):
        for b in batches:
            for a, z in zip(b.column("a").to_pylist(), b.column("z").to_pylist(), strict=True):
                fs, inner = files.located(path)
                with fs.open_input_file(inner) as f:
                    f.seek(a)
                    rows = list(rows_of(a, f.read(z - a)))
                for i in range(0, len(rows), 2000):
                    yield pa.RecordBatch.from_pylist(rows[i : i + 2000], schema=schema)

    try:
        if laid_out:
            cuts = _pieces(path)
            parts = spark.createDataFrame(cuts, "a long, z long").repartition(len(cuts), "a")
            table = stored(parts.mapInArrow(run, ENTRIES + ", at long, rest string"))
            header = json.loads("".join(r.rest for r in sorted(table.where("kind = 'rest'").select("at", "rest").collect())))
        elif size > WHOLE:
            raise ValueError(f"a manifest of {size} bytes needs sorted keys and an indent of two spaces")
        else:
            with fs.open_input_file(inner) as f:
                header = json.loads(f.read())
            lists = [header.get(k) if isinstance(header, dict) else None for k in ("files", "shards")]
            rows = [entry_row(o) for own in lists if isinstance(own, list) for o in own]
            table = spark.createDataFrame([(r["kind"], r["error"], r.get("file"), r.get("shard")) for r in rows], ENTRIES)
            if isinstance(header, dict):
                header |= {k: [] for k, own in zip(("files", "shards"), lists, strict=True) if isinstance(own, list)}
    except json.JSONDecodeError as e:
        raise ValueError(f"the manifest is no JSON: {e}") from e
    except Exception as e:
        if "JSONDecodeError" in str(e):
            raise ValueError("the manifest is no JSON") from e
        raise
    if not isinstance(header, dict):
        raise ValueError("the manifest is no JSON object")
    return Manifest(header, table.where("kind = 'file'").select("file.*", "error"), table.where("kind = 'shard'").select("shard.*", "error"))


def manifest_errors(m: Manifest) -> list[str]:
    """What breaks the manifest's contract: kinds, texts, entries (the first few), repeated paths, and counts that aren't those of its files and shards."""
    h = m.header
    errors = [f"{k} must be {v!r}" for k, v in KIND.items() if h.get(k) != v]
    if h.get("files") != [] or h.get("shards") != []:
        return [*errors, "files and shards must be lists of objects"]
    if not isinstance(h.get("backup_id"), str) or not h.get("backup_id"):
        errors.append("backup_id must be a text")
    if not STAMP.fullmatch(str(h.get("created_at_utc"))):
        errors.append("created_at_utc must be YYYY-MM-DDTHH:MM:SSZ")
    restore = h.get("restore")
    if not isinstance(restore, dict) or restore.get("paths_are_relative") is not True or restore.get("compatibility_schema_version") != 1:
        errors.append("restore must have relative paths of version 1")
    try:
        relative(h.get("source_dataset_root"))
    except ValueError as e:
        errors.append(f"source_dataset_root: {e}")
    broken = m.files.where("error IS NOT NULL").select("error").unionByName(m.shards.where("error IS NOT NULL").select("error"))
    errors += [r.error for r in broken.orderBy("error").limit(SHOWN).collect()]
    twice = m.files.where("relative_path IS NOT NULL").groupBy("relative_path").count().where("count > 1")
    errors += [f"{r.relative_path} is listed twice" for r in twice.orderBy("relative_path").limit(SHOWN).collect()]
    n, total = m.files.agg(F.count("*"), F.coalesce(F.sum("size_bytes"), F.lit(0))).first()
    names = sorted(r.dataset_name for r in m.files.where("dataset_name IS NOT NULL").select("dataset_name").distinct().collect())  # a few
    s = m.shards.agg(F.count("*").alias("n"), F.countDistinct("shard_index").alias("distinct"), F.min("shard_index").alias("least"), F.max("shard_index").alias("most"), F.sum("file_count").alias("files"), F.sum("uncompressed_bytes").alias("bytes")).first()
    errors += [f"{k} is {h.get(k)!r}, files give {v}" for k, v in (("file_count", n), ("total_uncompressed_bytes", total), ("included_datasets", names)) if h.get(k) != v]
    if s.n and (s.distinct != s.n or s.least != 0 or s.most != s.n - 1):
        errors.append("shards must be numbered from 0")
    if n and not s.n:
        errors.append("files need shards")
    errors += [f"shards' {k} add up to {v}, files to {w}" for k, v, w in (("file_count", s.files, n), ("uncompressed_bytes", s.bytes, total)) if s.n and v != w]
    return errors


def _rendered(entries: DataFrame, order: str, folder: str, kind: str) -> DataFrame:
    """place and path of the pieces into which tasks write ranges of entries, as they stand in the document."""

    def run(batches):
        from pyspark import TaskContext

        place, path, sink = TaskContext.get().partitionId(), f"{folder}/{kind}-{uuid.uuid4().hex}.part", None
        for b in batches:
            for o in b.to_pylist():
                if isinstance(o.get("partitions"), list):
                    o["partitions"] = dict(o["partitions"])
                text = json.dumps(o | {"checksum_algorithm": "sha256"}, sort_keys=True, indent=2, separators=(",", ": "))
                if sink is None:
                    fs, inner = files.located(path)
                    fs.create_dir(inner.rpartition("/")[0], recursive=True)
                    sink = fs.open_output_stream(inner, compression=None)
                else:
                    sink.write(b",\n")
                sink.write(("    " + text.replace("\n", "\n    ")).encode())
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pydict({"place": pa.array([place], pa.int64()), "path": [path]})

    return stored(entries.repartitionByRange(order).sortWithinPartitions(order).mapInArrow(run, "place long, path string"))


def write_manifest(header: dict, entries: DataFrame, shards: DataFrame, path: str) -> None:
    """Writes header (without lists), FILES' and SHARDS' rows as one document."""
    spark = entries.sparkSession
    folder = f"{path}.{uuid.uuid4().hex}"
    names = {"files": FILES, "shards": SHARDS}
    pieces = {kind: [r.path for r in sorted(_rendered(df.select(*(c.split()[0] for c in names[kind].split(", "))), order, folder, kind).collect())] for kind, df, order in (("files", entries, "relative_path"), ("shards", shards, "shard_index"))}
    marks = {kind: f"{kind}-{uuid.uuid4().hex}" for kind in names}
    text = files.json_text(header | {kind: marks[kind] for kind in names})
    head, rest = text.split(f'"{marks["files"]}"')
    middle, tail = rest.split(f'"{marks["shards"]}"')

    def join(batches):
        for _ in batches:
            fs, inner = files.located(path)
            part = f"{inner}.{uuid.uuid4().hex}.part"
            with fs.open_output_stream(part, compression=None) as sink:
                for before, kind in ((head, "files"), (middle, "shards")):
                    sink.write(before.encode())
                    for i, piece in enumerate(pieces[kind]):
                        sink.write(b",\n" if i else b"[\n")
                        with fs.open_input_stream(files.located(piece)[1], compression=None) as source:
                            while data := source.read(1 << 20):
                                sink.write(data)
                    sink.write(b"\n  ]" if pieces[kind] else b"[]")
                sink.write(tail.encode())
            fs.move(part, inner)
            yield pa.RecordBatch.from_pydict({"done": pa.array([1], pa.int64())})

    try:
        spark.range(1, numPartitions=1).mapInArrow(join, "done long").collect()
    finally:
        files.deleted(folder)
