"""The pipeline on a small corpus, each stage against a plain version on what its predecessor kept."""

import collections
import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import decontamination, tokens
from tickloom.llm.common import words_of

from .test_operators import ROWS, TEXTS, brute_components


def test_pipeline(spark, tmp_path):
    from tokenizers import Tokenizer

    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(i, t, lang, s, n) for i, t, lang, s, n, *_ in ROWS] + [(200, "12 34", "en", "a", 5)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    leak = " ".join(TEXTS[-2].split()[700:740])
    spark.createDataFrame([(1, leak)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path}/{name}"
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append(docs.collect())
    languages, copies, leaks, mixed, written = kept
    assert {r.doc_id for r in languages} & {0, 1, 2, 200} == set() and len(languages) >= len(rows) - 8
    components = brute_components([(r.doc_id, r.text) for r in languages], 5, (80, 100))
    assert {r.doc_id for r in copies} - {None} == {c for i, _, c in components} - {None}
    Q = decontamination._shingles(decontamination.words(leak), 5)
    clean = [r for r in copies if len(Q & decontamination._shingles(decontamination.words(r.text), 5)) < 0.8 * len(Q)]
    assert sorted(map(str, leaks)) == sorted(map(str, clean)) and 100 not in {r.doc_id for r in leaks}
    times = collections.Counter((r.doc_id, r.text) for r in mixed)
    assert max(times.values()) <= 3 and set(times) <= {(r.doc_id, r.text) for r in leaks}
    words, taken = collections.Counter(), collections.Counter()
    for r in leaks:
        words[r.source] += len(words_of(r.text))
    for r in mixed:
        taken[r.source] += len(words_of(r.text))
    assert abs(sum(taken.values()) - sum(words.values())) <= 0.1 * sum(words.values())
    t = Tokenizer.from_file(tokens.default_vocabulary())
    crc = lambda s: zlib.crc32(np.array(t.encode(s, add_special_tokens=False).ids + [0], "<u4").tobytes())
    assert collections.Counter((r.doc_id, r.ids_crc32) for r in written) == collections.Counter((r.doc_id, crc(r.text)) for r in mixed)
    starts = sorted((r.start, r.n_tokens) for r in written)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))
    run = corpus_pipeline.run(spark, str(tmp_path)).select(F.count("*"), F.sum("n_tokens")).first()
    assert tuple(run) == (len(written), sum(r.n_tokens for r in written))
