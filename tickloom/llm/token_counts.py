"""Token counts: how many tokens a tokenizer makes of each text, and nothing else of them.

Arrow functions get batches of bounded rows and bytes. Texts are split where no token, special string, or normalization
reaches over: at ASCII white space for vocabularies that drop it, at single spaces between other characters for
byte-level and sentence-piece ones, whose tokens hold spaces in front. What can't be split so (other kinds, and for
sentence pieces texts with U+2581) is encoded whole. Pieces go to the library in lots of about the same bytes and only
lengths come back, so that memory is bounded by a lot's; counts of words that come again are kept up to a bound in bytes.
A text's count is the sum of its pieces'.

Kinds: `.json` of the tokenizers library, where special strings inside texts are that token, as is its default; `.model`
of sentencepiece. No begin or end tokens are added, nothing is truncated or padded.

Null and empty texts have no tokens. Repeated rows are counted each; other columns are kept, those named n_bytes,
n_tokens, or over_limit are replaced. An empty table gives no rows.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, claim, keeps, table
from .pieces import Memo, cut, lots

LIMIT = 2048


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _steps(part: dict | None, kind: str) -> list[dict]:
    """The steps of a normalizer or pre-tokenizer, which may be a sequence."""
    return [] if part is None else part[kind] if part["type"] == "Sequence" else [part]


def splitting(told: dict) -> str:
    """How texts may be split for a vocabulary of the tokenizers library: 'words' at ASCII white space, 'spaces' where cut() does, 'never'."""
    added = [x["content"] for x in told["added_tokens"]]
    if any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in told["added_tokens"]) or any(c.isspace() for x in added for c in x):
        return "never"
    cleaned = all(x["type"] in ("NFC", "NFD", "Lowercase") or x["type"] == "Replace" and x["pattern"] == {"Regex": "\\s+"} and x["content"] == " " for x in _steps(told["normalizer"], "normalizers"))
    first = next(iter(_steps(told["pre_tokenizer"], "pretokenizers")), {"type": None})
    if first["type"] == "Split" and first["invert"] and first["behavior"] == "Removed" and "[^\\s" in str(first["pattern"].get("Regex")) and " " not in first["pattern"]["Regex"] and cleaned:
        return "words"
    if first["type"] == "ByteLevel" and first["use_regex"] and not first["add_prefix_space"] and told["normalizer"] is None:
        return "spaces"
    return "never"


class Counter:
    """Counts for one vocabulary in one Python worker."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            self.of = sentencepiece.SentencePieceProcessor(model_file=path)
            inner = any("▁" in self.of.id_to_piece(i).lstrip("▁") for i in range(self.of.get_piece_size()))
            kept = self.of.decode(self.of.encode(" a  \ufb01 ")) == " a  \ufb01 "  # else texts are normalized
            self.split, self.lengths = "never" if inner or not kept else "pieces", self._pieces
        else:
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            self.of = Tokenizer.from_file(path)
            self.of.no_truncation()
            self.of.no_padding()
            self.split, self.lengths = splitting(json.loads(self.of.to_str())), self._encoded
        self.memo = Memo(self._counted)

    def _encoded(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.of.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.of.encode(texts, num_threads=1)]

    def _counted(self, words: list) -> list[int]:
        out: list[int] = []
        for a, z in lots(words):
            out += self.lengths([w.decode() if isinstance(w, bytes) else w for w in words[a:z]])
        return out

    def pieces(self, text: str) -> list:
        if self.split == "words":
            return text.encode().split()  # at ASCII white space alone
        if not text or self.split == "never" or self.split == "pieces" and "▁" in text:  # which that library can't tell from a space
            return [text] if text else []
        first, *others = cut(text)
        # A sentence-piece vocabulary puts the space before each text itself.
        return [first, *(others if self.split == "pieces" else [" " + x for x in others])]

    def counts(self, texts: list[str]) -> list[int]:
        own = [self.pieces(t) for t in texts]
        if self.split == "never":
            return [sum(self._counted(x)) for x in own]
        n, out, at = self.memo.of([w for x in own for w in x]), [], 0
        for x in own:
            out.append(sum(n[at : at + len(x)]))
            at += len(x)
        return out


_counters: dict[str, Counter] = {}
keeps("token_counts", _counters.clear)


def counter_for(path: str) -> Counter:
    """One for each Python worker, so that later tasks find the words of earlier ones."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """docs with n_bytes (of UTF-8), n_tokens and over_limit (more than limit tokens)."""
    bound_batches(docs.sparkSession)

    @F.arrow_udf("long")
    def n_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        claim("token_counts")
        counter = counter_for(vocabulary)
        for texts in batches:
            yield pa.array(counter.counts([t or "" for t in texts.to_pylist()]), pa.int64())

    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    counted = docs.drop("n_bytes", "n_tokens", "over_limit").withColumns({"n_bytes": n_bytes, "n_tokens": n_tokens("text")})
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op12_token_counts(spark, sf_dir: str) -> DataFrame:
    """All documents with their tokens counted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, default_vocabulary()).select("doc_id", "n_bytes", "n_tokens", "over_limit")
