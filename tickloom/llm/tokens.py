"""Token ids in Arrow IPC files of equal-length sequences: fixed-size lists of ids and of a mask, mapped without copies.

Documents are sorted by id over range partitions; each task encodes its range, ends each document with the end id and
writes one file of sequences (the last padded, its mask false there) and an index file (doc_id, start in the file,
n_tokens). A task that is run again writes files of other names; just those of the attempt that succeeded are in the
manifest. Memory: one Arrow batch, one record batch of sequences and a word cache of bounded bytes.

Texts are encoded as the library does it by default: what spells a special token is that token.

Null texts are empty: they are the end id alone. Null ids come first; repeated rows are written each time. Extra columns
are left out. An empty table gives no files.
"""

from __future__ import annotations

import math
import os
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bound_batches, claim, keeps, shared_dir, table
from .files import joined, located, made

LENGTH, ROWS, END, TOGETHER = 2048, 64, 0, 64
#: Bytes of the words that a worker keeps, what a word takes besides its characters and ids, and the marks of words met once.
CACHE_BYTES, ENTRY_BYTES, MARKS = 56 << 20, 190, 1 << 22
#: Bytes of text for a token file: files are as many as these need, no fewer than there are shuffle partitions of at least LEAST_BYTES.
FILE_BYTES, LEAST_BYTES = 256 << 20, 4 << 20
#: How byte-level vocabularies write a space.
SPACE = "\u0120"
#: All characters but the space that str.isspace() holds for.
SPACES = [chr(c) for c in range(33 + 0x3000) if chr(c).isspace() and c != 32]
MANIFEST = "part int, file string, index string, n_ids long, n_docs long"
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
#: A space between two characters that aren't white space: no token of a byte-level vocabulary reaches over it from the left.
CUT = re.compile(r"(?<=\S) (?=\S)")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _uneven(text: str) -> bool:
    """Whether a space stands at an end or beside other white space, so that not every space may be cut at."""
    if text[:1].isspace() or text[-1:].isspace() or "  " in text:
        return True
    return any(x + " " in text or " " + x in text for x in SPACES if x in text)


class Encoder:
    """Byte-level BPE by the tokenizers library. The ids of words that come again are kept, up to so many bytes; then all are dropped and gathered anew."""

    def __init__(self, path: str, cache: int = CACHE_BYTES):
        from tokenizers import Tokenizer

        self.of = Tokenizer.from_file(path)
        self.kind = np.uint16 if self.of.get_vocab_size() <= 1 << 16 else np.uint32
        self.known: dict[str, bytes] = {}
        self.met, self.held = bytearray(MARKS), 0
        self.most, self.order = cache, np.dtype(self.kind).newbyteorder("<")
        self.cuts = not any(x.lstrip or x.rstrip or any(map(str.isspace, x.content)) for x in self.of.get_added_tokens_decoder().values())
        self.begins = np.zeros(self.of.get_vocab_size(), bool)
        self.begins[[i for x, i in self.of.get_vocab().items() if x.startswith(SPACE)]] = True

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes of little-endian integers of self.kind.

        All words but a text's first are encoded with the space before them, those that come again once while they are kept."""
        if not self.cuts:
            return self._alone(texts)
        words: list[str] = []
        first = []
        for t in texts:
            first.append(len(words))
            words += CUT.split(t) if _uneven(t) else t.split(" ")
        if self.held > self.most:
            self.known, self.held = {}, 0
        known = self.known
        ids = list(map(known.get, words))
        for i, x in zip(first, self._alone([words[i] for i in first]), strict=True):
            ids[i] = x
        missed = [i for i, x in enumerate(ids) if x is None]
        new = list(dict.fromkeys(words[i] for i in missed))
        found = dict(zip(new, self._ids([" " + x for x in new]), strict=True))
        for i in missed:
            ids[i] = found[words[i]]
        marks, last = self.met, MARKS - 1
        for word, own in found.items():
            at = hash(word) & last
            if marks[at]:
                known[word] = own
                self.held += len(word) + len(own) + ENTRY_BYTES
            else:
                marks[at] = 1
        return [b"".join(ids[a:z]) for a, z in zip(first, [*first[1:], len(ids)], strict=True)]

    def _ids(self, texts: list[str]) -> list[bytes]:
        """The ids of words with a space before them, many in one text: a token that begins with a space begins a word."""
        own = [texts[i : i + TOGETHER] for i in range(0, len(texts), TOGETHER)]
        out: list[bytes] = []
        for words, e in zip(own, self.of.encode_batch_fast(["".join(x) for x in own], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, self.order)
            at = np.flatnonzero(self.begins[ids])
            if len(at) == len(words):
                raw, ends = ids.tobytes(), [*(at[1:] * ids.itemsize).tolist(), len(ids) * ids.itemsize]
                out += [raw[a:z] for a, z in zip([0, *ends], ends, strict=False)]
            else:
                out += self._alone(words)
        return out

    def _alone(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.order).tobytes() for e in self.of.encode_batch_fast(texts, add_special_tokens=False)]


_encoders: dict[str, Encoder] = {}
keeps("tokens", _encoders.clear)


def encoder_for(path: str) -> Encoder:
    """One for each Python worker, so that later tasks find the words of earlier ones."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class _Writer:
    """Sequences of one file, a record batch at a time."""

    def __init__(self, sink, kind, length: int, rows: int):
        item = pa.uint16() if kind == np.uint16 else pa.uint32()
        self.schema = pa.schema([("input_ids", pa.list_(item, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.out, self.item, self.length, self.rows = pa.ipc.new_file(sink, self.schema), item, length, rows
        self.kind, self.held, self.n, self.total = np.dtype(kind).newbyteorder("<"), [], 0, 0

    def add(self, ids: bytes) -> None:
        self.held.append(ids)
        self.n += len(ids)
        self.total += len(ids) // self.kind.itemsize
        full = self.length * self.rows * self.kind.itemsize
        if self.n >= full:
            data = b"".join(self.held)
            stop = len(data) // full * full
            for i in range(0, stop, full):
                self._put(np.frombuffer(data, self.kind, full // self.kind.itemsize, i), self.length * self.rows)
            self.held, self.n = [data[stop:]], len(data) - stop

    def _put(self, ids: np.ndarray, n: int) -> None:
        mask = np.zeros(len(ids), bool)
        mask[:n] = True
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(ids, self.item), self.length), pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)]
        self.out.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        ids = np.frombuffer(b"".join(self.held), self.kind)
        if len(ids):
            self._put(np.concatenate([ids, np.zeros(-len(ids) % self.length, self.kind)]), len(ids))
        self.out.close()


class TokenFile:
    """Random access to one file: sequences and token ranges as views of the mapped file."""

    def __init__(self, path: str):
        fs, inner = located(path)
        self.source = pa.memory_map(inner) if fs.type_name == "local" else fs.open_input_file(inner)
        self.of = pa.ipc.open_file(self.source)
        self.length = self.of.schema.field("input_ids").type.list_size
        self.rows = len(self.of.get_batch(0)) if self.of.num_record_batches else 1
        self.at, self.held = -1, None

    def _ids(self, i: int) -> np.ndarray:
        if i != self.at:
            self.at, self.held = i, self.of.get_batch(i).column(0).flatten().to_numpy()
        return self.held

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        batch, row = self.of.get_batch(i // self.rows), i % self.rows
        return self._ids(i // self.rows)[row * self.length : (row + 1) * self.length], np.asarray(batch.column(1)[row].values)

    def pieces(self, start: int, n: int):
        """Tokens start to start + n, as views of the record batches that hold them."""
        each = self.rows * self.length
        while n > 0:
            i, a = divmod(start, each)
            got = self._ids(i)[a : a + n]
            yield got
            start, n = start + len(got), n - len(got)


def write_tokens(docs: DataFrame, folder: str, vocabulary: str, length: int = LENGTH, files: int | None = None, end: int = END) -> DataFrame:
    """Writes docs (doc_id, text) into folder; returns the manifest, a row for each file, in the order of doc_id."""
    spark = docs.sparkSession
    bound_batches(spark)
    if files is None:
        n = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
        files = max(math.ceil(n / FILE_BYTES), min(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / LEAST_BYTES)), 1)
    tie = F.xxhash64("text")
    rows = docs.select("doc_id", "text").repartitionByRange(files, F.col("doc_id").asc_nulls_first(), tie).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)

    def run(it):
        from pyspark import TaskContext

        claim("tokens")
        part, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        encoder = writer = None
        for b in it:
            if not len(b):
                continue
            if writer is None:
                fs, inner = located(folder)
                fs.create_dir(inner, recursive=True)
                encoder = encoder_for(vocabulary)
                tail = np.array([end], np.dtype(encoder.kind).newbyteorder("<")).tobytes()
                file, index = f"tokens-{part:06d}-{name}.arrow", f"docs-{part:06d}-{name}.arrow"
                sinks = [fs.open_output_stream(joined(inner, x)) for x in (file, index)]
                writer, places, n_docs = _Writer(sinks[0], encoder.kind, length, ROWS), pa.ipc.new_file(sinks[1], INDEX), 0
            texts = [t or "" for t in b.column("text").to_pylist()]
            starts, counts = [], []
            for ids in encoder.encode(texts):
                starts.append(writer.total)
                writer.add(ids + tail)
                counts.append(writer.total - starts[-1])
            places.write_batch(pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64())], schema=INDEX))
            n_docs += len(b)
        if writer is not None:
            for x in (writer, places, *sinks):
                x.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "file": joined(folder, file), "index": joined(folder, index), "n_ids": writer.total, "n_docs": n_docs}], schema=pa.schema([("part", pa.int32()), ("file", pa.string()), ("index", pa.string()), ("n_ids", pa.int64()), ("n_docs", pa.int64())]))

    made(folder)
    place = joined(folder, "manifest")
    rows.mapInArrow(run, MANIFEST).write.parquet(place)
    return spark.read.schema(MANIFEST).parquet(place)


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    spark: SparkSession = manifest.sparkSession
    start = F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    files = manifest.withColumn("base", start).select("file", "index", "base").repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "file")

    def run(it):
        for b in it:
            for row in b.to_pylist():
                ids = TokenFile(row["file"])
                fs, inner = located(row["index"])
                places = pa.ipc.open_file(fs.open_input_file(inner))
                for i in range(places.num_record_batches):
                    own = places.get_batch(i)
                    sums = []
                    for a, n in zip(own.column("start").to_pylist(), own.column("n_tokens").to_pylist(), strict=True):
                        crc = 0
                        for x in ids.pieces(a, n):
                            crc = zlib.crc32(x.astype("<u4").tobytes(), crc)
                        sums.append(crc)
                    starts = pa.array(own.column("start").to_numpy() + row["base"], pa.int64())
                    yield pa.RecordBatch.from_arrays([own.column("doc_id"), starts, own.column("n_tokens"), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_tokens(spark, sf_dir: str) -> DataFrame:
    """All documents written as token ids and read back."""
    docs = table(spark, sf_dir, "documents")
    return read_documents(write_tokens(docs, f"{shared_dir(spark)}/tokens", default_vocabulary()))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus as token files; returns what they hold of each document."""
    return read_documents(write_tokens(docs, f"{shared_dir(spark)}/tokens", default_vocabulary()))
