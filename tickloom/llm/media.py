"""Media columns: FLAC. Texts or other bytes become FLAC streams in a binary column; streams become PCM blocks.

Null payloads and empty ones are padded to one block; a very long payload is coded alone in its group. A stream that is
null, truncated or fails a checksum gets null PCM and the reason in `status`; others get `ok`. Extra columns are kept;
columns with the names of results are replaced. Repeated rows stay and get equal results; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import flac
from .common import bound_batches

BLOCKS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("first_sample", "n_samples", "byte_offset", "n_bytes")]))
DECODED = T.StructType([
    T.StructField("status", T.StringType()), T.StructField("bits", T.IntegerType()), T.StructField("pcm", T.BinaryType()),
    T.StructField("blocks", BLOCKS), T.StructField("feature", T.StringType()),
])
#: Payload bytes coded in one go; a longer payload is alone in its group.
GROUP_BYTES = 2 << 20


def padded(payload: bytes | None, multiple: int = flac.BLOCK) -> bytes:
    """The payload with spaces up to a positive multiple of a block."""
    payload = payload or b""
    return payload + b" " * (multiple - len(payload) if not payload else -len(payload) % multiple)


def _groups(values: list, size=len) -> Iterator[slice]:
    at = total = 0
    for i, v in enumerate(values):
        total += size(v or b"")
        if total >= GROUP_BYTES or i == len(values) - 1:
            yield slice(at, i + 1)
            at, total = i + 1, 0


def _feature(one: dict) -> str:
    """Loudness, peak, zero crossings and the kinds of subframes; a function of the stream alone."""
    x = np.frombuffer(one["pcm"], np.uint8).astype(np.int16) - 128 if one["bps"] == 8 else np.frombuffer(one["pcm"], "<i2")
    if not len(x):
        return "empty"
    names, counts = np.unique(one["kinds"].astype(str), return_counts=True)
    kinds = "/".join(f"{n}:{c}" for n, c in zip(names, counts, strict=True))
    level = float(np.sqrt(np.mean(x.astype(np.float64) ** 2)))
    return f"rms={level:.4f};peak={int(np.abs(x.astype(np.int32)).max())};zcr={np.count_nonzero(np.diff(x < 0)) / len(x):.4f};{kinds}"


def _result(df: DataFrame, fields: list[T.StructField]) -> T.StructType:
    names = {f.name.lower() for f in fields}
    return T.StructType([f for f in df.schema if f.name.lower() not in names] + fields)


def encode_flac(df: DataFrame, payload: str = "payload", out: str = "media") -> DataFrame:
    """Adds the FLAC stream of each row's bytes (a binary or string column), as 8-bit samples, padded by spaces to whole blocks."""
    bound_batches(df.sparkSession)
    df = df.withColumn(payload, F.col(payload).cast("binary"))
    schema = _result(df, [T.StructField(out, T.BinaryType())])
    keep = [f.name for f in schema][:-1]

    def run(it):
        for b in it:
            values = b.column(payload).to_pylist()
            for s in _groups(values):
                coded = flac.encode([padded(v) for v in values[s]])
                part = b.slice(s.start, s.stop - s.start)
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in keep), pa.array(coded, pa.binary())], [*keep, out])

    return df.mapInArrow(run, schema)


def decode_flac(df: DataFrame, media: str = "media") -> DataFrame:
    """Adds status, bits, pcm (8 bits unsigned, 16 signed little-endian), the blocks with their sample and byte offsets, and a feature."""
    bound_batches(df.sparkSession)
    fields = list(DECODED)
    schema = _result(df, fields)
    keep = [f.name for f in schema][: -len(fields)]

    def run(it):
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in fields]
        for b in it:
            values = b.column(media).to_pylist()
            for s in _groups(values):
                got = flac.decode([v if v is not None else b"" for v in values[s]])
                rows = [(x["error"], None, None, None, None) if "error" in x else ("ok", x["bps"], x["pcm"], [dict(zip(("first_sample", "n_samples", "byte_offset", "n_bytes"), t, strict=True)) for t in x["blocks"]], _feature(x)) for x in got]
                part = b.slice(s.start, s.stop - s.start)
                made = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in keep), *made], [*keep, *(f.name for f in fields)])

    return df.mapInArrow(run, schema)


def pcm_blocks(decoded: DataFrame, samples: int = 4608) -> DataFrame:
    """A row for each PCM block of so many samples: first_sample and n_samples, byte_offset of the frame to seek to, and pcm.

    Rows whose stream wasn't readable give none."""
    bound_batches(decoded.sparkSession)
    kept = [c for c in decoded.columns if c not in ("pcm", "blocks", "bits", "status", "feature", "first_sample", "n_samples", "byte_offset")]
    names = ["first_sample", "n_samples", "byte_offset", "pcm"]
    each = max(1, GROUP_BYTES // (2 * samples))  # blocks of a batch

    def run(it):
        for b in it:
            for i in range(len(b)):
                pcm, blocks = memoryview(b.column("pcm")[i].as_buffer()), b.column("blocks")[i].values
                width, first = b.column("bits")[i].as_py() // 8, blocks.field("first_sample").to_numpy()
                offset, total = blocks.field("byte_offset").to_numpy(), len(pcm) // width
                for at in range(0, total, samples * each):
                    own = np.arange(at, min(total, at + samples * each), samples)
                    n = np.minimum(total - own, samples)
                    seek = offset[np.searchsorted(first, own, side="right") - 1]
                    cut = [bytes(pcm[s * width : (s + k) * width]) for s, k in zip(own.tolist(), n.tolist(), strict=True)]
                    same = b.slice(i, 1).take(pa.array(np.zeros(len(own), np.int64)))
                    yield pa.RecordBatch.from_arrays([*(same.column(c) for c in kept), pa.array(own), pa.array(n), pa.array(seek), pa.array(cut, pa.binary())], [*kept, *names])

    schema = T.StructType([decoded.schema[c] for c in kept] + [T.StructField(c, T.LongType()) for c in names[:3]] + [T.StructField("pcm", T.BinaryType())])
    return decoded.where((F.col("status") == "ok") & (F.size("blocks") > 0)).select(*kept, "pcm", "blocks", "bits").mapInArrow(run, schema)


def op1_flac(spark, sf_dir: str) -> DataFrame:
    """Every document's bytes through FLAC and back; digests of what was read back."""
    from .common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("payload"))
    coded = encode_flac(docs).select("doc_id", F.octet_length("payload").cast("long").alias("n_bytes"), "media")
    back = decode_flac(coded)
    return back.select(
        "doc_id", "n_bytes", F.octet_length("pcm").cast("long").alias("payload_bytes"), F.sha2("pcm", 256).alias("payload_sha256"),
        F.crc32(F.substring("pcm", -16, 16)).alias("tail_crc32"), F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"),
        "feature", F.size("blocks").cast("long").alias("n_frames"),
    )
