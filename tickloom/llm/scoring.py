"""Language-model scores of documents: a smoothed unigram base, and the marginal likelihood of the subword lattice.

All documents' words make one table of distinct words with their training counts. Piece probabilities start from the
scores of an existing vocabulary; one step of expectation-maximization over all training words (their lattices weighted by
their counts) fits them, smoothed by the start. A document's probability is the product over its words of the sum over
all segmentations, with an end that comes as often as documents end.

The score is not that of a model that exists: the vocabulary file at hand holds merge ranks instead of unigram scores, so
its prior is Zipf's law over them, and the model is what one step of expectation-maximization makes of it.

Frequent words - as many as a bounded table holds, picked by the corpus-wide counts - are looked up in tasks; a
document's other words are joined to the word table, where no word is frequent any more. Null and empty texts have their
end alone. Repeated rows and null ids are scored like others (rows have keys of their own). With no training documents
each count is 0. Extra columns are left out.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import lattice
from .common import bound_batches, stored, table, words_of

#: Words that tasks look up without a join; at most this many.
FREQUENT = 1 << 17
#: Expected pieces that the vocabulary's own scores count as.
PRIOR = 1000.0
WORDS = pa.schema([("word", pa.binary()), ("train", pa.int64()), ("every", pa.int64())])


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _spelled(word: bytes) -> str:
    return lattice.START + word.decode("utf-8", "surrogatepass")


def word_table(docs: DataFrame) -> DataFrame:
    """word, train, every: how often each word comes in training documents (column `train`) and in all of docs."""

    def run(it):
        for b in it:
            train, every = Counter(), Counter()
            for text, use in zip(b.column("text").to_pylist(), b.column("train").to_pylist(), strict=True):
                words = words_of(text)
                every.update(words)
                if use:
                    train.update(words)
            words = list(every)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([train[w] for w in words], pa.int64()), pa.array(list(every.values()), pa.int64())], schema=WORDS)

    counted = docs.select("text", "train").mapInArrow(run, "word binary, train long, every long")
    return counted.groupBy("word").agg(F.sum("train").alias("train"), F.sum("every").alias("every"))


_vocabularies: dict[str, lattice.Vocabulary] = {}


def vocabulary(path: str) -> lattice.Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = lattice.Vocabulary(path)
    return _vocabularies[path]


def fit(words: DataFrame, path: str, steps: int = 1, prior: float = PRIOR) -> np.ndarray:
    """Log probabilities of the vocabulary's pieces by expectation-maximization over all training words."""
    v = vocabulary(path)
    logp = np.log(v.prior)
    for _ in range(steps):
        current = words.sparkSession.sparkContext.broadcast(logp)

        def run(it, current=current):
            v, total = vocabulary(path), None
            for b in it:
                got = lattice.expectations(v, current.value, [_spelled(w) for w in b.column("word").to_pylist()], b.column("train").to_numpy().astype(float))
                total = got if total is None else total + got
            if total is not None:
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["piece", "n"])

        found = words.where("train > 0").select("word", "train").mapInArrow(run, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).toPandas()
        expected = v.prior * prior
        expected[found["piece"].to_numpy(int)] += found["n"].to_numpy()
        logp = np.log(expected / expected.sum())
        current.destroy()
    return logp


def scored_words(words: DataFrame, path: str, logp: np.ndarray) -> DataFrame:
    """Adds marginal: each word's log10 probability over all segmentations."""
    current = words.sparkSession.sparkContext.broadcast(logp)

    def run(it):
        v = vocabulary(path)
        for b in it:
            got = lattice.marginals(v, current.value, [_spelled(w) for w in b.column("word").to_pylist()]) / np.log(10)
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in WORDS.names), pa.array(got)], [*WORDS.names, "marginal"])

    return words.select(*WORDS.names).mapInArrow(run, "word binary, train long, every long, marginal double")


def _frequent(words: DataFrame, most: int) -> dict[bytes, tuple[int, float]]:
    """The words above the least count that leaves at most `most`; counts come in quarter octaves, so the driver sees few rows."""
    level = F.floor(F.log2("every") * 4)
    sizes = sorted((r["level"], r["n"]) for r in words.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect())
    total, least = 0, None
    for at, n in reversed(sizes):
        total += n
        if total > most:
            break
        least = at
    return {} if least is None else {bytes(r[0]): (r[1], r[2]) for r in words.where(level >= least).select("word", "train", "marginal").collect()}


def score(docs: DataFrame, path: str, steps: int = 1, most: int = FREQUENT) -> DataFrame:
    """docs (doc_id, text, train) with n_tokens, n_known, train_tokens, base_score and score (log10)."""
    spark = docs.sparkSession
    bound_batches(spark)
    docs = docs.select("doc_id", "text", "train")
    counted = stored(word_table(docs), "counted")
    words = stored(scored_words(counted, path, fit(counted, path, steps)), "words")
    n_words, known = words.agg(F.coalesce(F.sum("train"), F.lit(0)), F.count_if(F.col("train") > 0)).first()
    ends = docs.where("train").count()
    total, distinct = n_words + ends, known + (ends > 0)
    below = total + 0.5 * (distinct + 1)
    p_end = (ends + 0.5) / (total + 1)
    go_on, stop = float(np.log10(1 - p_end)), float(np.log10(p_end))
    base_end = float(np.log10((ends + 0.5) / below))
    frequent = spark.sparkContext.broadcast({w: (int(c > 0), float(np.log10((c + 0.5) / below)), m + go_on) for w, (c, m) in _frequent(words, most).items()})
    rest = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))

    def run(it):
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 33
        for b in it:
            known, out = frequent.value, []
            for text in b.column("text").to_pylist():
                words, left, n, base, full = Counter(words_of(text)), [], 0, base_end, stop
                for w, c in words.items():
                    got = known.get(w)
                    if got is None:
                        left.append({"word": w, "n": c})
                    else:
                        n, base, full = n + c * got[0], base + c * got[1], full + c * got[2]
                out.append((at, words.total() + 1, n + (ends > 0), base, full, left))
                at += 1
            cols = list(zip(*out, strict=True)) or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), rest]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("train"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["doc_id", "train", "row", "n_tokens", "n_known", "base_score", "score", "rest"])

    kind = dict(docs.dtypes)["doc_id"]
    parts = stored(docs.mapInArrow(run, f"doc_id {kind}, train boolean, row long, n_tokens long, n_known long, base_score double, score double, rest array<struct<word: binary, n: bigint>>"), "parts")
    base = F.log10((F.col("train") + 0.5) / F.lit(float(below)))
    more = (
        parts.select("row", F.inline("rest")).join(words.select("word", "train", "marginal"), "word").groupBy("row")
        .agg(F.sum(F.when(F.col("train") > 0, F.col("n")).otherwise(0)).alias("k"), F.sum(F.col("n") * base).alias("b"), F.sum(F.col("n") * (F.col("marginal") + go_on)).alias("s"))
    )
    zero = F.lit(0)
    return parts.drop("rest").join(more, "row", "left").select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("k", zero)).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("b", zero)).alias("base_score"), (F.col("score") + F.coalesce("s", zero)).alias("score"),
    )


def op10_lattice_score(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents; those of four folds out of five train."""
    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return score(docs.select("doc_id", "text", F.coalesce(fold != 1, F.lit(True)).alias("train")), default_vocabulary())
