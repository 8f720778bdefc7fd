"""Language ID by a bidirectional gated recurrent network over bytes: a language for every position, pooled to the document.

The network is trained on the driver on a bounded sample of labelled rows: PER_LANG documents of each language at most,
fewer if there are so many languages that this makes more than SAMPLE (one of each at least), WINDOWS pieces of WINDOW
characters of each, picked by hashes of doc_id. Prediction runs over whole texts in segments that overlap.

Texts that are null, empty or without a letter are `und` with score 0; so are all if there is no labelled row. Null
labels aren't learned. Rows with a null doc_id don't train. Repeated rows get equal predictions. An empty table gives no
rows. The pipeline's stage rejects texts without letters and those whose language isn't clear; with no labelled row to
learn from it can judge no language, and rejects just texts without letters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, claim, maybe_broadcast, stored, table, unused
from .gru import BiGru

PER_LANG, SAMPLE, WINDOWS, WINDOW = 300, 60_000, 3, 300
UND = "und"
#: Score below which the pipeline rejects a document.
LEAST = 0.3
OUT = pa.schema([("lang_pred", pa.string()), ("score", pa.float64()), ("position_share", pa.float64())])


def fold(k: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % k


def sample(docs: DataFrame, per: int = PER_LANG, most: int = SAMPLE) -> tuple[list[str], list[bytes], np.ndarray]:
    """Languages, pieces of text and the pieces' languages, of docs (doc_id, text, lang)."""
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL AND length(text) > 0")
    counts = stored(rows.groupBy("lang").count(), "languages")
    n = counts.count()
    if not n:
        return [], [], np.empty(0, int)
    per = max(1, min(per, most // n))
    rate = counts.select("lang", (2.0 * per / F.col("count")).alias("rate"))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(5), "doc_id"), 12) / F.lit(float(1 << 52))
    wide = F.greatest(F.length("text") - WINDOW, F.lit(1))
    pieces = F.array(*(F.substr("text", (1 + F.pmod(F.xxhash64(F.lit(i), "doc_id"), wide.cast("long"))).cast("int"), F.lit(WINDOW)) for i in range(WINDOWS)))
    drawn = rows.join(maybe_broadcast(rate, n), "lang").where(draw < F.col("rate")).select("lang", draw.alias("draw"), "doc_id", pieces.alias("pieces")).collect()
    by: dict[str, list] = {}
    for r in sorted(drawn, key=lambda r: (r["lang"], r["draw"], r["doc_id"], r["pieces"])):
        if len(own := by.setdefault(r["lang"], [])) < per:
            own.append([p.encode("utf-8", "surrogatepass") for p in r["pieces"]])
    langs = sorted(by)
    return langs, [p for k in langs for own in by[k] for p in own], np.array([i for i, k in enumerate(langs) for own in by[k] for _ in own], int)


def train(docs: DataFrame, steps: int = 300) -> BiGru | None:
    langs, texts, y = sample(docs)
    if not langs:
        return None
    model = BiGru(langs)
    if len(langs) > 1:
        model.train(texts, y, steps)
    return model


def predict(df: DataFrame, model: BiGru | None, text: str = "text", runs: bool = False) -> DataFrame:
    """df with lang_pred, score (mean probability over letters) and position_share (share of letters labelled alike);
    with runs, also the labelled byte ranges. Columns of these names are replaced."""
    bound_batches(df.sparkSession)
    extra = [*OUT.names, *(["runs"] if runs else [])]
    keep = [c for c in df.columns if c not in extra]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
    held = df.sparkSession.sparkContext.broadcast(model)

    def run(it):
        claim("language")
        m = held.value
        for b in it:
            texts = b.column(text).to_pylist()
            known = [m is not None and t is not None and any(map(str.isalpha, t)) for t in texts]
            got = iter(m.label([t.encode("utf-8", "surrogatepass") for t, k in zip(texts, known, strict=True) if k], runs) if m else [])
            rows = []
            for k in known:
                if not k:
                    rows.append((UND, 0.0, 0.0, []))
                    continue
                mean, votes, marks = next(got)
                best = int(mean.argmax())
                rows.append((m.labels[best], float(min(1, mean[best])), float(votes[best] / max(1, votes.sum())), [{"start": s, "end": e, "lang": m.labels[c]} for s, e, c in marks or []]))
            cols = [list(c) for c in zip(*rows, strict=True)] or [[]] * 4
            made = [pa.array(c, f.type) for c, f in zip(cols, OUT, strict=False)] + ([pa.array(cols[3], kind)] if runs else [])
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in keep), *made], [*keep, *extra])

    from pyspark.sql import types as T

    schema = T.StructType([df.schema[c] for c in keep]).add("lang_pred", "string").add("score", "double").add("position_share", "double")
    return df.select(*keep).mapInArrow(run, schema.add("runs", T.DataType.fromDDL("array<struct<start:bigint,end:bigint,lang:string>>")) if runs else schema)


def op8_language(spark, sf_dir: str) -> DataFrame:
    """The language of every document; learned from three folds out of four."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.select("doc_id", "text", "lang").where(fold(4) != 2))
    rows = docs.select("doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "text")
    return predict(rows, model).drop("text")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those without letters or of no clear language go (just the former, if there is nothing to learn from)."""
    model = train(docs.select("doc_id", "text", "lang").where(fold(4) != 2))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    own = {c: unused([*docs.columns, *OUT.names], c) for c in docs.columns if c.lower() in OUT.names}
    told = predict(docs.withColumnsRenamed(own), model).where((F.col("lang_pred") != UND) & (F.col("score") >= LEAST))
    return told.select(*(F.col(own.get(c, c)).alias(c) for c in docs.columns))
