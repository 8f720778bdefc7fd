"""Archive packs: a folder of ZIP shards and a manifest. Tasks write, verify and restore shards; files stream through them.

Shards are equal for equal files: members in order, times of 1980, mode 0600. The manifest names every file and shard with
its size and SHA-256; its lists are tables that tasks write, read and join, so that no list of files is on the driver. A
restore verifies all members in a staging folder before it moves anything into place."""

from __future__ import annotations

import hashlib
import uuid
import zipfile
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import partitions_of
from ..operators.inventory import reconcile
from ..operators.shards import shard_plan
from ..session import stored
from . import files, manifests
from .manifests import manifest_errors, read_manifest, relative

MANIFEST, SHARDS, SHARD_MB, PIECE, MOST_TASKS = "manifest.json", "shards", 512, 1 << 20, 10_000
# The policies for files that exist, and the names of shards.
POLICIES = ("fail", "replace", "merge")
SHARD_NAME = "shard-%06d.zip"
#: A row for each member, and one without a path for its shard.
WRITTEN = "shard long, relative_path string, size_bytes long, checksum string"
FOUND = "name string, relative_path string, size_bytes long, checksum string, error string"


@dataclass
class Pack:
    """What was planned or written: the manifest's header, and its lists as tables."""

    path: str
    header: dict
    files: DataFrame
    shards: DataFrame


class _Hashed:
    """A sink that zipfile can't seek in: what goes to it is hashed and counted."""

    def __init__(self, sink):
        self.sink, self.sha, self.n = sink, hashlib.sha256(), 0

    def write(self, data) -> int:
        self.sink.write(data)
        self.sha.update(data)
        self.n += len(data)
        return len(data)

    def flush(self) -> None:
        self.sink.flush()


def _copied(source, sink, sha=None) -> int:
    n = 0
    while piece := source.read(PIECE):
        sink.write(piece)
        n += len(piece)
        if sha is not None:
            sha.update(piece)
    return n


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = [(n, pa.int64() if k == "long" else pa.string()) for n, k in (f.split() for f in schema.split(", "))]
    cols = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(cols, kinds, strict=True)], [n for n, _ in kinds])


def write_shards(plan: DataFrame, root: str, out: str) -> DataFrame:
    """Writes a ZIP of each shard of a plan (relative_path, shard) into out; root holds the files. A task that is run again replaces its shards by equal ones."""
    spark = plan.sparkSession

    def run(batches):
        shard, archive, raw, part, inner, sink = None, None, None, None, None, None

        def closed():
            archive.close()
            raw.close()
            fs.move(part, inner)
            return shard, None, sink.n, sink.sha.hexdigest()

        for b in batches:
            made = []
            for of, path in zip(b.column("shard").to_pylist(), b.column("relative_path").to_pylist(), strict=True):
                if of != shard:
                    made += [closed()] if archive else []
                    fs, inner = files.located(f"{out}/{SHARD_NAME % of}")
                    shard, part = of, f"{inner}.{uuid.uuid4().hex}.part"
                    raw = fs.open_output_stream(part)
                    sink = _Hashed(raw)
                    archive = zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED)
                info = zipfile.ZipInfo(path, (1980, 1, 1, 0, 0, 0))
                info.compress_type, info.create_system, info.external_attr = zipfile.ZIP_DEFLATED, 3, 0o600 << 16
                from_fs, from_path = files.located(f"{root}/{path}")
                sha = hashlib.sha256()
                with from_fs.open_input_stream(from_path, compression=None) as source, archive.open(info, "w", force_zip64=True) as to:
                    made.append((of, path, _copied(source, to, sha), sha.hexdigest()))
            yield _rows(WRITTEN, made)
        if archive:
            yield _rows(WRITTEN, [closed()])

    fs, inner = files.located(out)
    fs.create_dir(inner, recursive=True)
    tasks = max(1, min(MOST_TASKS, (plan.agg(F.max("shard")).first()[0] or 0) + 1))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return plan.select("shard", "relative_path").repartition(tasks, "shard").sortWithinPartitions("shard", "relative_path").mapInArrow(run, WRITTEN)


def _dataset(root: str):
    """The first folder of a path, or the root's name where there is none or it is a partition."""
    first = F.substring_index("relative_path", "/", 1)
    return F.when(F.col("relative_path").contains("/") & ~first.contains("="), first).otherwise(F.lit(root.rstrip("/").rpartition("/")[2]))


def create_pack(spark: SparkSession, root: str, out: str, backup_id: str | None, created_at: str, shard_mb: int = SHARD_MB, dry_run: bool = False, metadata: dict | None = None, notes: list[str] | None = None, workspace: str | None = None) -> Pack:
    """Packs the Parquet files below root into out/backup_id. dry_run: plans alone, writes and hashes nothing.

    The manifest names root by its path below workspace (its own folder's name, if none is given). Without backup_id the
    pack is named by that and the time."""
    if not isinstance(shard_mb, int) or isinstance(shard_mb, bool) or shard_mb <= 0:
        raise ValueError("shard_mb must be a positive integer")
    if not manifests.STAMP.fullmatch(created_at):
        raise ValueError("created_at must be YYYY-MM-DDTHH:MM:SSZ")
    if not files.exists(root):
        raise FileNotFoundError(f"no dataset at {root}")
    plain, base = root.rstrip("/"), (workspace or root.rstrip("/").rpartition("/")[0]).rstrip("/")
    if not plain.startswith(f"{base}/"):
        raise ValueError(f"{root} is outside the workspace {workspace}")
    source = relative(plain.removeprefix(f"{base}/"))
    pack = f"{out}/{backup_id or manifests.backup_name(source, created_at)}"
    if files.folders(pack) or files.is_file(f"{pack}/{MANIFEST}"):
        raise FileExistsError(pack)
    plan = stored(shard_plan(files.listed(spark, root), shard_mb << 20))
    if dry_run:
        members = plan.select("shard", "relative_path", "size_bytes", F.lit(None).cast("string").alias("checksum"))
        archives = plan.select("shard").distinct().select("shard", F.lit(None).cast("long").alias("archive_bytes"), F.lit(None).cast("string").alias("checksum"))
    else:
        written = stored(write_shards(plan, root, f"{pack}/{SHARDS}"))
        members = written.where("relative_path IS NOT NULL")
        archives = written.where("relative_path IS NULL").select("shard", F.col("size_bytes").alias("archive_bytes"), "checksum")
    name = F.format_string(SHARD_NAME, "shard")
    entries = members.select("relative_path", "size_bytes", "checksum", _dataset(root).alias("dataset_name"), partitions_of("relative_path").alias("partitions"))
    totals = members.groupBy("shard").agg(F.count("*").alias("file_count"), F.sum("size_bytes").alias("uncompressed_bytes"))
    shards = totals.join(archives, "shard").select(name.alias("shard_name"), F.concat(F.lit(f"{SHARDS}/"), name).alias("relative_path"), F.col("shard").alias("shard_index"), "file_count", "uncompressed_bytes", "archive_bytes", "checksum")
    n, total, names = entries.agg(F.count("*"), F.coalesce(F.sum("size_bytes"), F.lit(0)), F.array_sort(F.collect_set("dataset_name"))).first()
    header = manifests.KIND | {
        "backup_id": pack.rpartition("/")[2], "created_at_utc": created_at, "source_dataset_root": source, "shard_size_mb": shard_mb, "included_datasets": names, "file_count": n, "total_uncompressed_bytes": total,
        "total_archive_bytes": None if dry_run else shards.agg(F.coalesce(F.sum("archive_bytes"), F.lit(0))).first()[0], "metadata": metadata or {}, "notes": manifests.NOTES if notes is None else notes, "restore": manifests.RESTORE,
    }
    if not dry_run:
        manifests.write_manifest(header, entries, shards, f"{pack}/{MANIFEST}")
    return Pack(pack, header, entries, shards)


def _manifest(spark: SparkSession, pack: str) -> manifests.Manifest:
    m = read_manifest(spark, f"{pack}/{MANIFEST}")
    if errors := manifest_errors(m):
        raise ValueError("; ".join(errors))
    return m


def _sink(staging: str | None, name: str):
    """Where a member goes: a file in staging, or nowhere."""
    if staging is None:
        return pa.MockOutputStream()
    fs, to = files.located(f"{staging}/{name}")
    fs.create_dir(to.rpartition("/")[0], recursive=True)
    return fs.open_output_stream(to, compression=None)


def _opened(pack: str, m: manifests.Manifest, staging: str | None = None) -> DataFrame:
    """Rows FOUND for the members of all shards, hashed as they are read; with staging, they are written there. Bad shards give a row with an error."""

    def run(batches):
        for b in batches:
            for path, size, checksum in zip(*(b.column(c).to_pylist() for c in ("relative_path", "archive_bytes", "checksum")), strict=True):
                rows: list[tuple] = []
                fs, inner = files.located(f"{pack}/{path}")
                try:
                    info, sha = fs.get_file_info(inner), hashlib.sha256()
                    if info.type != pafs.FileType.File:
                        raise ValueError("the shard is missing")
                    with fs.open_input_stream(inner, compression=None) as f:
                        while piece := f.read(PIECE):
                            sha.update(piece)
                    if size is not None and info.size != size or checksum is not None and sha.hexdigest() != checksum:
                        raise ValueError("the shard's size or checksum is another")
                    with fs.open_input_file(inner) as f, zipfile.ZipFile(f) as z:
                        for member in z.infolist():
                            if relative(member.filename) != member.filename:
                                raise ValueError(f"unsafe path {member.filename!r}")
                            sha = hashlib.sha256()
                            with z.open(member) as source, _sink(staging, member.filename) as out:
                                n = _copied(source, out, sha)
                            rows.append((path, member.filename, n, sha.hexdigest(), None))
                            if len(rows) >= 1000:
                                yield _rows(FOUND, rows)
                                rows = []
                except (ValueError, OSError, zipfile.BadZipFile) as e:
                    rows.append((path, None, None, None, str(e)))
                yield _rows(FOUND, rows)

    n = m.shards.count()
    return m.shards.select("relative_path", "archive_bytes", "checksum").repartition(max(1, min(MOST_TASKS, n)), "relative_path").mapInArrow(run, FOUND)


def _differences(m: manifests.Manifest, found: DataFrame) -> list[str]:
    """The first few of what is wrong with the members that were found."""
    wanted = m.files.select("relative_path", "size_bytes", F.col("checksum").alias("sha256"))
    # A manifest may say no checksum: then none is compared.
    bad = reconcile(wanted, found.where("relative_path IS NOT NULL").withColumnRenamed("checksum", "sha256")).where("status <> 'ok'")
    errors = found.where("error IS NOT NULL").select(F.concat_ws(": ", "name", "error").alias("error"))
    every = errors.unionByName(bad.select(F.concat_ws(": ", "relative_path", "status").alias("error")))
    return [r.error for r in every.orderBy("error").limit(manifests.SHOWN).collect()]


def validate_pack(spark: SparkSession, pack: str) -> dict:
    """Whether a pack is whole: valid, errors (the first few), and the manifest's counts. Nothing is changed; a bad pack never raises."""
    try:
        m = _manifest(spark, pack)
        errors = _differences(m, stored(_opened(pack, m)))
    except (ValueError, FileNotFoundError) as e:
        return {"valid": False, "errors": [str(e)], "backup_id": None, "file_count": 0, "shard_count": 0, "total_uncompressed_bytes": 0}
    return {"valid": not errors, "errors": errors, "backup_id": m.header["backup_id"], "file_count": m.header["file_count"], "shard_count": m.shards.count(), "total_uncompressed_bytes": m.header["total_uncompressed_bytes"]}


def inspect_pack(spark: SparkSession, pack: str) -> DataFrame:
    """dataset, file_count, total_bytes and partition keys of what the manifest lists; no shard is opened."""
    m = _manifest(spark, pack)
    keys = F.explode_outer(F.map_keys("partitions"))
    named = m.files.select("dataset_name", keys.alias("key")).groupBy("dataset_name").agg(F.array_join(F.array_sort(F.collect_set("key")), ",").alias("partition_keys"))
    return m.files.groupBy("dataset_name").agg(F.count("*").alias("file_count"), F.sum("size_bytes").alias("total_bytes")).join(named, "dataset_name").withColumnRenamed("dataset_name", "dataset")


def _sha256(path: str) -> str:
    fs, inner = files.located(path)
    sha = hashlib.sha256()
    with fs.open_input_stream(inner, compression=None) as f:
        while piece := f.read(PIECE):
            sha.update(piece)
    return sha.hexdigest()


def restore_pack(spark: SparkSession, pack: str, target: str, policy: str = "fail") -> int:
    """Restores a pack's files below target; returns how many were put there.

    policy: fail if one exists, replace it, or merge: keep it if it is the same, else fail. All shards are verified in a
    staging folder beside target before a file is moved; what fails leaves target as it was."""
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy}")
    m = _manifest(spark, pack)
    found = files.listed(spark, target, ".*", hidden=True).select("relative_path", F.lit(True).alias("there"))
    names = stored(m.files.select("relative_path", "size_bytes", "checksum").join(found, "relative_path", "left").withColumn("there", F.coalesce("there", F.lit(False))))
    n, least = names.where("there").agg(F.count("*"), F.min("relative_path")).first()
    if n and policy == "fail":
        raise FileExistsError(f"{target}: {least} and {n - 1} more exist")

    def other(batches):
        for b in batches:
            yield _rows("path string", [(p,) for p, c in zip(b.column("relative_path").to_pylist(), b.column("checksum").to_pylist(), strict=True) if c is None or _sha256(f"{target}/{p}") != c])

    if n and policy == "merge":
        n, least = stored(names.where("there").mapInArrow(other, "path string")).agg(F.count("*"), F.min("path")).first()
        if n:
            raise FileExistsError(f"{target}: {least} and {n - 1} more differ")
    staging = f"{target.rstrip('/')}.restore-{uuid.uuid4().hex}"

    def moved(batches):
        for b in batches:
            for p in b.column("relative_path").to_pylist():
                fs, to = files.located(f"{target}/{p}")
                fs.create_dir(to.rpartition("/")[0], recursive=True)
                if files.exists(f"{staging}/{p}"):  # not yet moved by an earlier attempt
                    fs.move(files.located(f"{staging}/{p}")[1], to)
            yield _rows("n long", [(len(b),)])

    try:
        errors = _differences(m, stored(_opened(pack, m, staging)))
        if errors:
            raise ValueError("; ".join(errors))
        wanted = names.where("NOT there") if policy == "merge" else names
        n = wanted.mapInArrow(moved, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    finally:
        files.deleted(staging)
    sizes = files.listed(spark, target, ".*", hidden=True).withColumnRenamed("size_bytes", "size")
    lost, least = names.join(sizes, "relative_path", "left").where("size IS NULL OR size <> size_bytes").agg(F.count("*"), F.min("relative_path")).first()
    if lost:
        raise OSError(f"{target}: {least} and {lost - 1} more were not restored")
    return n
