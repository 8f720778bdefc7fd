"""Cross-tokenizer alignment: how the tokens of two vocabularies cover the same bytes.

A is byte-level BPE of the tokenizers library and reads a space and the text; B is a sentencepiece model, which adds that
space itself. Inside mapInPandas two pointers merge the cumulative byte ends of both token lists: where both end, a group
ends. All A and B tokens of a group are linked with each other. Spark counts in how many documents an id pair is linked,
takes each id's highest count on either side, and joins both back to the documents' links.

Texts are cut at single spaces between other characters, where tokens of both vocabularies end, so that words that come
again need no second alignment; a text of which a word can't be told in the bytes of both is aligned whole. A document is
described by its distinct pairs and their numbers, never by all its links. Pairs that many documents hold are few: counts
of the commonest are broadcast (at most BROADCAST_PAIRS of them, by a histogram of the counts); all others are joined by
pair, each with no more rows than the documents that hold it.

Null and empty texts have no tokens, and neither have texts whose bytes the tokens of A or B don't spell: zeros, and no
groups. Ids don't need to be unique: each row is a document. Extra columns are left out. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, claim, keeps, stored, table
from .pieces import Memo, cut, lots

BROADCAST_PAIRS = 400_000
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
#: Bits of a word's numbers of tokens and of groups, which are added as one integer; a text with longer words is aligned whole.
BITS = 21


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, others from U+0100 on in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def merged(ends_a: list[int], ends_b: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """Groups as ranges of tokens (first and end in A, in B), from the cumulative ends of two token lists over the same bytes."""
    i = j = from_a = from_b = 0
    while i < len(ends_a) and j < len(ends_b):
        a, b = ends_a[i], ends_b[j]
        i, j = i + (a <= b), j + (b <= a)
        if a == b:
            yield from_a, i, from_b, j
            from_a, from_b = i, j


class Aligner:
    """Alignments for two vocabularies in one Python worker."""

    def __init__(self, path_a: str, path_b: str, cache: int | None = None):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a, self.b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        letters = byte_letters()
        self.bytes_a: list[bytes] = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in own], np.int64) for own in (self.bytes_a, self.bytes_b))
        self.names = [str(i) for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.memo = Memo(self._words, *(() if cache is None else (cache,)))

    def _merge(self, words: list[str]) -> list[tuple] | None:
        """Of each word, with a space before it: n_a, n_b, n_groups, its groups as text, its links as pairs. The words make one
        text, in which tokens of both vocabularies end at each word's end. None if the tokens don't spell that text so."""
        text = " ".join(words)
        (encoded,) = self.a.encode_batch_fast([" " + text], add_special_tokens=False)
        ids_a, ids_b, raw = encoded.ids, self.b.encode(text), b" " + text.encode()
        if b"".join(map(self.bytes_b.__getitem__, ids_b)) != raw or b"".join(map(self.bytes_a.__getitem__, ids_a)) != raw:
            return None
        ends_a, ends_b = np.cumsum(self.sizes_a[ids_a]).tolist(), np.cumsum(self.sizes_b[ids_b]).tolist()
        stops = iter(np.cumsum([len(w.encode()) + 1 for w in words]).tolist())
        names, size_b, out = self.names, len(self.bytes_b), []
        groups, links, stop, first_a, first_b = [], [], next(stops), 0, 0
        for a, z, c, y in merged(ends_a, ends_b):
            if z - a == 1 == y - c:
                links.append(ids_a[a] * size_b + ids_b[c])
                groups.append(names[ids_a[a]] + "|" + names[ids_b[c]])
            else:
                own_a, own_b = ids_a[a:z], ids_b[c:y]
                links += [i * size_b + j for i in own_a for j in own_b]
                groups.append(",".join(map(names.__getitem__, own_a)) + "|" + ",".join(map(names.__getitem__, own_b)))
            if ends_a[z - 1] == stop:
                out.append((z - first_a, y - first_b, len(groups), ";".join(groups).encode(), np.array(links, np.int64)))
                groups, links, stop, first_a, first_b = [], [], next(stops, -1), z, y
        return out if len(out) == len(words) else None

    def _together(self, words: list[str]) -> list:
        """What _merge() tells of each word; () for those that can't be told so."""
        got = self._merge(words)
        if got is None:
            half = len(words) // 2
            return self._together(words[:half]) + self._together(words[half:]) if half else [()]
        return [(x[0] | x[1] << BITS * 2 | x[2] << BITS * 4, x[3], x[4].tobytes()) if not max(x[:3]) >> BITS else () for x in got]

    def _words(self, words: list[str]) -> list:
        """Of each word its numbers as one, its groups as text, and its links as bytes; () where it must be seen with its text."""
        plain = [i for i, w in enumerate(words) if w and not w[0].isspace() and not w[-1].isspace()]
        out: list = [None] * len(words)
        for begin, end in lots([words[i] for i in plain], 32 << 10):
            own = plain[begin:end]
            for i, x in zip(own, self._together([words[i] for i in own]), strict=True):
                out[i] = x
        return [x if x is not None else self._together([w])[0] for x, w in zip(out, words, strict=True)]

    def align(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, bytes, np.ndarray, np.ndarray]]:
        """n_a, n_b, n_groups, n_links, groups as text, distinct pairs, and how often each is linked."""
        own = [cut(t) if t and self.cuts else [] for t in texts]
        found, at = self.memo.of([w for x in own for w in x]), 0
        low = (1 << BITS * 2) - 1
        for text, words in zip(texts, own, strict=True):
            parts = found[at : at + len(words)]
            at += len(words)
            if not text:
                got = None
            elif words and all(parts):
                numbers, groups, links = zip(*parts, strict=True)
                n = sum(numbers)
                got = n & low, n >> BITS * 2 & low, n >> BITS * 4, b";".join(groups), np.frombuffer(b"".join(links), np.int64)
            else:
                got = next(iter(self._merge([text]) or ()), None)
            if got is None:
                yield 0, 0, 0, 0, b"", np.empty(0, np.int64), np.empty(0, np.int64)
            else:
                pairs, times = np.unique(got[4], return_counts=True)
                yield got[0], got[1], got[2], len(got[4]), got[3], pairs, times


_aligners: dict[tuple[str, str], Aligner] = {}
keeps("alignment", _aligners.clear)


def aligner_for(path_a: str, path_b: str) -> Aligner:
    """One for each Python worker, so that later tasks find the words of earlier ones."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


def align(docs: DataFrame, path_a: str, path_b: str, groups: bool = False) -> DataFrame:
    """A row for each of docs (doc_id, text): row (unique), doc_id, n_a, n_b, n_groups, n_links, groups_sha256, its distinct
    pairs (A id * pieces of B + B id), times (the links of each), and, if wanted, groups as text (`a1,a2|b1;a3|b2,b3`).

    Rows are numbered here: store the result before it is used twice."""
    bound_batches(docs.sparkSession)
    schema = "row long, doc_id string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>" + ", groups string" * groups

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("alignment")
        aligner = aligner_for(path_a, path_b)
        for frame in frames:
            texts = [t if isinstance(t, str) else None for t in frame["text"]]
            for a, z in lots([t or "" for t in texts], 1 << 20):
                got = list(zip(*aligner.align(texts[a:z]), strict=True))
                columns = {"row": frame["row"].iloc[a:z].array, "doc_id": frame["doc_id"].iloc[a:z].array} | dict(zip(COUNTS, got[:4], strict=True))
                columns["groups_sha256"] = [hashlib.sha256(x).hexdigest() if x else "" for x in got[4]]
                columns |= {"pairs": got[5], "times": [t.astype(np.int32) for t in got[6]]}
                yield pd.DataFrame(columns | ({"groups": [x.decode() for x in got[4]]} if groups else {}))

    # Ids are texts on the way, as pandas would make floats of long ones beside nulls.
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("string").alias("doc_id"), "text")
    return numbered.mapInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """pair, a, b, documents (that hold the pair linked), best_a and best_b: whether that is the highest count of its A id, of its B id."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("documents"))
    counts = stored(counts.withColumns({"a": F.floor(F.col("pair") / size_b), "b": F.col("pair") % size_b}), "pairs")
    for side in "ab":
        most = counts.groupBy(side).agg(F.max("documents").alias("most"))
        counts = counts.join(most, side).withColumn(f"best_{side}", F.col("documents") == F.col("most")).drop("most")
    return stored(counts.select("pair", "a", "b", "documents", "best_a", "best_b"), "counted")


def scored(aligned: DataFrame, counts: DataFrame, most: int = BROADCAST_PAIRS) -> DataFrame:
    """The stored rows of align() without their pairs, with n_best and n_best_b (links whose count is the highest of their A, of their B id) and count_sum over links."""
    sizes = {r.power: r.n for r in counts.groupBy(F.floor(F.log2("documents")).alias("power")).agg(F.count("*").alias("n")).collect()}  # 64 at most
    power, held = 64, 0
    while power > 0 and held + sizes.get(power - 1, 0) <= most:
        power -= 1
        held += sizes.get(power, 0)
    least = 1 << power
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    wanted = counts.select("pair", "documents", "best_a", "best_b")

    def sums(joined: DataFrame) -> DataFrame:
        return joined.groupBy("row").agg(
            F.sum(F.when(F.col("best_a"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.when(F.col("best_b"), F.col("times")).otherwise(0)).alias("n_best_b"), F.sum(F.col("documents") * F.col("times")).alias("count_sum"),
        )

    common = F.broadcast(wanted.where(F.col("documents") >= least))
    if power == 0:
        found = sums(links.join(common, "pair"))
    else:
        rare = links.join(common, "pair", "left_anti").join(wanted.where(F.col("documents") < least), "pair")
        found = sums(links.join(common, "pair")).unionByName(sums(rare)).groupBy("row").agg(*(F.sum(c).alias(c) for c in ("n_best", "n_best_b", "count_sum")))
    out = aligned.drop("pairs", "times").join(found, "row", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_best", "n_best_b", "count_sum")})


def op13_alignment(spark, sf_dir: str) -> DataFrame:
    """All documents aligned, with what their links' counts over the corpus say of them."""
    a, b = default_vocabularies()
    aligned = stored(align(table(spark, sf_dir, "documents"), a, b), "aligned")
    counts = pair_counts(aligned, pieces_of(b))
    return scored(aligned, counts).select("doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256", "n_best_b")


def pieces_of(path_b: str) -> int:
    """The pieces of a sentencepiece model, by which pairs are numbered."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
