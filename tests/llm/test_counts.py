"""Whitening, token counts and cross-tokenizer alignment against plain versions."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm import alignment, pieces, token_counts, whitening

from .test_operators import ROWS, SCHEMA

A, B, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"))
ODD = [
    " lead", "trail ", "two  spaces", " \n ", "a\tb c 　d", "▁ low ▁line", "<|endoftext|> x<|startoftext|>y <s> </s> <unk>", "e ́ é ẛ̣", "nul \x00 \x1c sep", "你好 世界你好",
    "don't we'll I'M 12345 ½ ǅ", "\U0001f600 \U0001f468‍\U0001f469", "ﬁne ﷺ x", "ΣΣ ΣαΣ a", "\r\n a \r b", "a\u0085b   c", "﻿bom ​ x", "x" * 3000 + " y", "İ İ",
]


def random_texts(n: int) -> list[str]:
    rng = random.Random(5)
    letters = list("aeb t  \n\t'.,1<|>▁́ 　你\U0001f600") + [" the", "<|endoftext|>", " <s>", "'s ", "\x1c", "\x85", "n't"]
    return ["".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) for _ in range(n)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("counts"))
    rows = [*ROWS, *((500 + i, t, "en", "a", len(t), *["clash"] * 10) for i, t in enumerate(ODD)), (2**60 + 1, "a long id", "en", "a", 9, *["clash"] * 10), (700, "some words " * 30_000, "en", "a", 0, *["clash"] * 10)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    return path, [(r[0], r[1]) for r in rows]


def test_op12_query(spark, folder):
    path, rows = folder
    library = Tokenizer.from_file(WORDS)
    want = collections.Counter()
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False))
        want[i, len((t or "").encode()), n, n > 2048] += 1
    got = token_counts.op12_token_counts(spark, path)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert collections.Counter(map(tuple, got.collect())) == want


@pytest.mark.parametrize("path, split", [(WORDS, "words"), (A, "spaces"), (B, "pieces")])
def test_counts_of_pieces_add_up(path, split):
    counter = token_counts.Counter(path)
    assert counter.split == split
    texts = ODD + random_texts(3000)
    if path == B:
        want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    else:
        want = [len(Tokenizer.from_file(path).encode(t, add_special_tokens=False)) for t in ODD] + [len(e) for e in Tokenizer.from_file(path).encode_batch(texts[len(ODD) :], add_special_tokens=False)]
    assert counter.counts(texts) == want
    assert counter.counts(texts) == want  # from memory
    counter.split = "never"
    assert counter.counts(texts) == want


def test_vocabularies_that_cannot_be_split():
    told = {"added_tokens": [], "normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "use_regex": True, "add_prefix_space": True}}
    assert token_counts.splitting(told) == "never"
    told["pre_tokenizer"]["add_prefix_space"] = False
    assert token_counts.splitting(told) == "spaces"
    told["added_tokens"] = [{"content": "<x>", "lstrip": True, "rstrip": False, "single_word": False}]
    assert token_counts.splitting(told) == "never"
    assert token_counts.splitting({"added_tokens": [], "normalizer": None, "pre_tokenizer": None}) == "never"


def test_counts_keep_columns(spark):
    docs = spark.createDataFrame([("a b", "x", "y"), (None, "x", None)], "text string, n_tokens string, memo string")
    got = token_counts.count_tokens(docs, WORDS, limit=1)
    assert got.columns == ["text", "memo", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, got.collect()), key=str) == [("a b", "y", 3, 2, True), (None, None, 0, 0, False)]
    assert token_counts.count_tokens(docs.limit(0), WORDS).collect() == []


def test_memo_and_lots():
    asked = []
    memo = pieces.Memo(lambda words: asked.append(words) or [len(w) for w in words], most=3000)
    assert memo.of(["a", "bb", "a"]) == [1, 2, 1] and memo.of(["bb"]) == [2] and memo.of(["bb"]) == [2] and asked == [["a", "bb"], ["bb"], []]
    assert memo.of([f"w{i}" for i in range(1000)] * 2) == memo.of([f"w{i}" for i in range(1000)] * 2)
    assert memo.held > memo.most and memo.of(["bb"]) == [2] and memo.held <= memo.most
    assert list(pieces.lots(["x" * 50] * 5, 140)) == [(0, 2), (2, 4), (4, 5)] and list(pieces.lots(["x" * 500, "y"], 140)) == [(0, 1), (1, 2)] and list(pieces.lots([])) == []


def plain_alignment(text: str | None, a: Tokenizer, b, letters):
    """Ids and groups of a text by marking each byte at which a token ends."""
    if not text:
        return None
    raw = (" " + text).encode()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
    if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
        return None

    def ends(tokens):
        return {sum(map(len, tokens[: i + 1])): i + 1 for i in range(len(tokens))} if len(tokens) < 300 else dict(zip(np.cumsum(list(map(len, tokens))).tolist(), range(1, len(tokens) + 1), strict=True))

    ends_a, ends_b = ends(bytes_a), ends(bytes_b)
    groups, i, j = [], 0, 0
    for at in sorted(ends_a.keys() & ends_b.keys()):
        groups.append((ids_a[i : ends_a[at]], ids_b[j : ends_b[at]]))
        i, j = ends_a[at], ends_b[at]
    return ids_a, ids_b, groups


def brute(rows):
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = alignment.byte_letters()
    found = [(i, plain_alignment(t, a, b, letters)) for i, t in rows]
    links = [collections.Counter((x, y) for own_a, own_b in x[2] for x in own_a for y in own_b) if x else collections.Counter() for _, x in found]
    counts = collections.Counter(p for own in links for p in own)
    best_a, best_b = collections.Counter(), collections.Counter()
    for (x, y), n in counts.items():
        best_a[x], best_b[y] = max(best_a[x], n), max(best_b[y], n)
    for (i, x), own in zip(found, links, strict=True):
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in x[2]) if x else ""
        yield (
            i, *((len(x[0]), len(x[1]), len(x[2])) if x else (0, 0, 0)), own.total(), sum(n for p, n in own.items() if counts[p] == best_a[p[0]]), sum(n * counts[p] for p, n in own.items()),
            hashlib.sha256(text.encode()).hexdigest() if x else "", sum(n for p, n in own.items() if counts[p] == best_b[p[1]]),
        )


def test_op13_query(spark, folder):
    path, rows = folder
    got = alignment.op13_alignment(spark, path)
    assert got.columns[:8] == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = collections.Counter(brute(rows))
    assert collections.Counter(map(tuple, got.collect())) == want
    assert sum(x[1] == 0 for x in want) >= 3 and any(x[3] < min(x[1:3]) for x in want)


def test_random_texts_align_as_a_whole():
    aligner, whole = alignment.Aligner(A, B, cache=20_000), alignment.Aligner(A, B)
    whole.cuts = False
    texts = ODD + random_texts(2000)
    for _ in range(2):
        for x, y in zip(aligner.align(texts), whole.align(texts), strict=True):
            assert x[:5] == y[:5] and x[5].tolist() == y[5].tolist() and x[6].tolist() == y[6].tolist()


def test_rare_pairs_are_joined_by_pair(spark, folder):
    path, _ = folder
    aligned = alignment.stored(alignment.align(spark.read.parquet(f"{path}/documents.parquet"), A, B, groups=True), "aligned")
    assert aligned.where("groups_sha256 <> '' AND sha2(groups, 256) <> groups_sha256").isEmpty()
    counts = alignment.pair_counts(aligned, alignment.pieces_of(B))
    assert counts.count() > 100
    one, other = (collections.Counter(map(tuple, alignment.scored(aligned, counts, most).collect())) for most in (10**6, 100))
    assert one == other
    assert alignment.scored(aligned.limit(0), counts.limit(0)).collect() == []


def test_merged_by_two_pointers():
    assert list(alignment.merged([1, 3, 6], [2, 3, 5, 6])) == [(0, 2, 0, 2), (2, 3, 2, 4)]
    assert list(alignment.merged([], [])) == [] and list(alignment.merged([4], [4])) == [(0, 1, 0, 1)]


@pytest.mark.parametrize("d", [1, 2, 7, 40])
def test_jacobi(d):
    x = np.random.default_rng(d).normal(size=(200, d)) * np.logspace(0, -5, d)
    c = x.T @ x / 200
    values, vectors = whitening.jacobi(c)
    assert np.allclose(values, np.linalg.eigvalsh(c)[::-1], rtol=1e-10) and np.abs(vectors.T @ vectors - np.eye(d)).max() < 1e-13
    assert np.abs(vectors @ np.diag(values) @ vectors.T - c).max() < 1e-13


def test_jacobi_small_eigenvalues_and_rounds():
    scale = np.logspace(0, -9, 10)
    c = np.outer(scale, scale) * (np.eye(10) + 0.1)  # well scaled: each eigenvalue keeps its digits
    values, _ = whitening.jacobi(c)
    exact = np.linalg.det(np.eye(10) + 0.1) * np.prod(scale) ** 2
    assert np.prod(values) == pytest.approx(exact, rel=1e-10)
    assert whitening.jacobi(np.zeros((3, 3)))[0].tolist() == [0, 0, 0] and whitening.jacobi(np.ones((2, 2)))[0].tolist() == [2, 0]
    for d in range(1, 12):
        pairs = [(p, q) for ps, qs in whitening.rounds(d) for p, q in zip(ps.tolist(), qs.tolist(), strict=True)]
        assert sorted(pairs) == [(p, q) for p in range(d) for q in range(p + 1, d)]


def test_op11_query(spark, tmp_path):
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(400, 40)) @ rng.normal(size=(40, 40)) * 0.3).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(i, x[5].tolist()) for i in range(400, 500)]  # a vector that comes again
    bad = [(900, None), (901, [None] + [0.0] * 39), (902, [float("nan")] * 40), (903, [float("-inf")] * 40), (904, []), (905, [1.0, 2.0])]
    spark.createDataFrame([(i, v, 1, "clash") for i, v in rows + bad], "vec_id bigint, embedding array<float>, label int, x string").repartition(7).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = whitening.op11_whitening(spark, str(tmp_path)).toPandas()
    grid = np.floor(64 * np.array([v for _, v in rows], np.float32).astype(np.float64)).astype(np.int64) + 1_000_000
    n, s = len(grid), grid.sum(axis=0)
    z = (n * grid - s) / n
    values, vectors = np.linalg.eigh(z.T @ z / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(got) == n * 32 and set(got.n) == {n} and sorted(set(got.component)) == list(range(1, 33))
    table = got.pivot(index="vec_id", columns="component", values="whitened").loc[[i for i, _ in rows]].to_numpy()
    plain = z @ vectors[:, :32] / np.sqrt(values[:32])
    signs = np.sign((table * plain).sum(axis=0))
    assert np.abs(table - plain * signs).max() < 1e-8
    assert got.drop_duplicates("vec_id").set_index("vec_id").deviation.to_dict() == {i: int(d) for (i, _), d in zip(rows, ((n * grid - s) ** 2).sum(axis=1), strict=True)}
    assert np.allclose(got.drop_duplicates("component").sort_values("component").explained, values[:32] / values.sum(), rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    assert got.dtypes.astype(str).to_dict() | {"component": "int32", "n": "int64", "deviation": "int64"} == got.dtypes.astype(str).to_dict()


def test_op11_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([(1, None)], "vec_id bigint, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = whitening.op11_whitening(spark, str(tmp_path))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and got.collect() == []


def test_whitening_of_flat_and_double_vectors(spark):
    one = spark.createDataFrame([(1, [5, 7])], "id int, v array<bigint>")
    fitted = whitening.fit(one, "v")
    assert [tuple(r) for r in fitted.apply(one, "v").select("whitened", "deviation").collect()] == [([None, None], 0)] and whitening.identity_error(fitted.apply(one, "v")) is None
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0], "kept", "gone") for i in range(9)], "id int, v array<double>, _whitened string, deviation string")
    fitted = whitening.fit(line, "v")
    out = fitted.apply(line, "v", k=2)
    assert out.columns == ["id", "v", "_whitened", "whitened", "deviation"] and {r._whitened for r in out.collect()} == {"kept"}
    assert all(r.whitened[1] is None and r.deviation is None and abs(abs(r.whitened[0]) - abs(r.id - 4) / np.sqrt(60 / 9)) < 1e-12 for r in out.collect())
    assert whitening.identity_error(out) < 1e-12


def test_large_sums_are_exact_or_refused(spark):
    rows = spark.createDataFrame([(i, [i * 1_000_000_000, -i]) for i in range(5)], "id long, v array<bigint>")
    got = {r.id: int(r.deviation) for r in whitening.fit(rows, "v").apply(rows, "v").collect()}
    assert got == {i: ((5 * i - 10) * 10**9) ** 2 + (5 * i - 10) ** 2 for i in range(5)}
    huge = spark.createDataFrame([(1, [1e30]), (2, [1.0])], "id long, v array<double>")
    with pytest.raises(ValueError, match="62 bits"):
        whitening.fit(huge.select(whitening.gridded("v").alias("x")), "x")
    assert whitening.fit(huge.where(F.lit(False)), "v") is None
