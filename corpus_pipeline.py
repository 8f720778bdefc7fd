"""A corpus pipeline: each stage gets what its predecessor kept; all but the last return the columns of documents."""

from __future__ import annotations

from tickloom.llm import decontamination, language, mixing, ngram_join, tokens
from tickloom.llm.common import stored

STAGES = [
    ("language_id", language.stage),
    ("ngram_jaccard_join", ngram_join.stage),
    ("benchmark_decontamination", decontamination.stage),
    ("mixing_to_target_weights", mixing.stage),
    ("token_files", tokens.stage),
]
#: Languages are predicted by a trained network, which SQL can't express; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark, sf_dir: str):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
