"""The queries as the driver calls them, against brute force, and cases that the operators' docstrings define."""

import collections
import hashlib
import json
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from tickloom.llm import decontamination, flac, gru, language, lattice, media, mixing, ngram_join, scoring, secrets, templates, tokens, warc, wrapper
from tickloom.llm.common import words_of
from tickloom.llm.dom import matched, parsed

from .test_operators import ROWS, SCHEMA, waterfill

LONG = "a long text \U0001f600 " * 20_000


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("queries"))
    rows = [*ROWS, (300, LONG, "en", "b", len(LONG), *["clash"] * 10), (300, LONG, "en", "b", len(LONG), *["clash"] * 10)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    return path, [(r[0], r[1] or "", r[3]) for r in rows]


def test_op1_query(spark, folder):
    path, rows = folder
    want = collections.Counter()
    for i, text, _ in rows:
        raw = text.encode()
        own = raw + b" " * (192 - len(raw) if not raw else -len(raw) % 192)
        coded = flac.encode([own])[0]
        want[i, len(raw), len(own), hashlib.sha256(own).hexdigest(), zlib.crc32(own[-16:]), len(coded), hashlib.sha256(coded).hexdigest()] += 1
    names = "doc_id n_bytes payload_bytes payload_sha256 tail_crc32 media_bytes media_sha256".split()
    got = media.op1_flac(spark, path).collect()
    assert collections.Counter(tuple(r[n] for n in names) for r in got) == want
    assert len({r.feature for r in got if r.doc_id == 300}) == 1


def test_op2_query(spark, folder):
    path, rows = folder
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = waterfill(sizes, {s: i % 3 + 1 for i, s in enumerate(order)}, 3)
    got = mixing.op2_mixing(spark, path).collect()
    of = {(i, len(words_of(t))): s for i, t, s in rows}
    assert collections.Counter((r.doc_id, r["size"]) for r in got) == collections.Counter((i, len(words_of(t))) for i, t, _ in rows)
    taken = collections.Counter()
    for r in got:
        s = of[r.doc_id, r["size"]]
        assert r.source_size == sizes[s] and r.target == pytest.approx(target[s]) and r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max([len(words_of(t)) for _, t, x in rows if x == s]) / 2
    assert sorted(map(str, got)) == sorted(map(str, mixing.op2_mixing(spark, path).collect()))


def test_mixing_fills_until_nothing_fits(spark):
    rows = [(i, "w " * n, "a") for i, n in enumerate([97, 41, 19, 11, 5, 3, 2, 1] * 40)] + [(1000, "w " * 9000, "b")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).where("source = 'a'").collect()
    assert abs(sum(r["size"] * r.copies for r in got) - got[0].target) <= 1


def test_mixing_of_many_small_documents_beside_a_long_one(spark):
    """As many jobs as for few documents, and a target that is met; columns keep their names and values."""
    own = ["rank", "base", "cut0", "take0", "chosen", "row", "class", "left", "_tie", "filled", "key", "size_class", "gap"]
    rows = [(i, "w " * (1 + i % 37), "a") for i in range(5000)] + [(9999, "w " * 60_000, "a"), (10_000, "w " * 100_000, "b")]
    jobs = []
    for some in (rows[-40:], rows):
        docs = spark.createDataFrame(some, "doc_id bigint, text string, source string").withColumns({c: F.lit(c) for c in own})
        spark.sparkContext.setJobGroup(f"mix{len(some)}", "mixing")
        got = mixing.mix(docs).collect()
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"mix{len(some)}")))
        assert all(r[c] == c for r in got for c in own)
        for s in "ab":
            of = [r for r in got if r.source == s]
            off = abs(sum(r["size"] * r.copies for r in of) - of[0].target)
            assert off <= (64 if len(some) > 100 and s == "a" else max(r["size"] for r in of))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] <= jobs[0] + 10


@pytest.mark.parametrize("seed", range(30))
def test_fill_of_size_classes(seed):
    """No class gives more than fits; what is missing is less than the smallest class with documents left over, or half of what else could be taken."""
    import random

    import pandas as pd

    rng = random.Random(seed)
    rows = [(int(np.log2(s)), s, rng.randint(1, 3)) for s in (rng.randint(1, 400) for _ in range(rng.randint(0, 60)))]
    left, over0, over1 = rng.randint(0, 3000) + rng.random(), rng.choice([0, 3500]), rng.choice([0, 4000])
    t = [(False, "s", c, i, i, float(s), n, 0, 0) for i, (c, s, n) in enumerate(rows)] + [(False, "s", -1, 0, -1, left, 1, over0, over1)]
    names = ["none", "of", "class", "place", "id", "size", "n", "over0", "over1"]
    mixed = list(t)
    rng.shuffle(mixed)
    frame = pd.DataFrame(t, columns=names)
    got = mixing.fill(pa.Table.from_pandas(pd.DataFrame(mixed, columns=names)))
    assert got.equals(mixing.fill(pa.Table.from_pandas(frame)))
    got = got.to_pandas()
    taken, over, unused = 0, 0, []
    for r in got.itertuples():
        taken += over0 * r.more0 + over1 * r.more1
        for i, (c, s, n) in enumerate(rows):
            if c == r[3]:
                k = n if pd.isna(r.id) or i < r.id else r.take if i == r.id else 0
                taken += k * s
                unused += [s] * (n - k)
    least = min((int(np.log2(s)) for s in unused), default=None)
    assert abs(taken - left) <= left + 1e-9
    if least is not None:
        assert abs(taken - left) < 2 ** (least + 1)
    elif not over0 and not over1:
        assert taken <= left + 1e-9 and taken == sum(s * n for _, s, n in rows)


def test_op5_query(spark, folder):
    from tokenizers import Tokenizer

    path, rows = folder
    t, start, want = Tokenizer.from_file(tokens.default_vocabulary()), 0, collections.Counter()
    for i, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = t.encode(text, add_special_tokens=False).ids + [0]
        want[i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        start += len(ids)
    got = tokens.op5_tokens(spark, path).collect()
    assert collections.Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == want


def test_op3_long_texts_and_many_matches(spark):
    text = ("token=abcdefghijkl " * 3000 + "\U0001f600" * 1000 + "0123456789abcdef0 ") * 2
    df = spark.createDataFrame([(1, text), (1, text), (2, "x" * 300_000)], "doc_id bigint, text string")
    got = secrets.find_secrets(df).collect()
    want = [(m.start(), m.end()) for m in re.finditer(r"token=[a-z]{12}|[0-9a-f]{16,}", text)]
    index = secrets.trigram_index(df)
    assert sorted(map(str, secrets.find_secrets(df, secrets.RULES[:4], index).collect())) == sorted(map(str, secrets.find_secrets(df, secrets.RULES[:4]).collect()))
    assert [[(s.start, s.end) for s in r.spans] for r in got if r.doc_id == 1] == [want] * 2 and [r.spans for r in got if r.doc_id == 2] == [None]


def test_warc_overwrites_and_refuses_damage(spark, tmp_path):
    warc.register(spark)
    page = lambda i, n=1200: spark.createDataFrame([(i, "http://h/", "x" * n)], "page_id bigint, url string, html string")
    path = f"file://{tmp_path}/w"
    for i in (1, 2):
        warc.with_revisits(page(i)).write.format("warc").mode("overwrite").save(path)
    assert [r.page_id for r in spark.read.format("warc").load(path).collect()] == [2] and len(list((tmp_path / "w").glob("*.warc"))) == 1
    warc.with_revisits(page(3)).write.format("warc").mode("append").save(path)
    assert sorted(r.page_id for r in spark.read.format("warc").load(path).collect()) == [2, 3]
    whole = next((tmp_path / "w").glob("*.warc")).read_bytes()
    for name, data, told in (("cut", whole[:-200], "cut off"), ("bad", re.sub(rb"\r\nContent-Length: \d+", b"\r\nContent-Length: many", whole, count=1), "no valid length")):
        (tmp_path / f"{name}.warc").write_bytes(data)
        with pytest.raises(PythonException, match=told):
            spark.read.format("warc").load(f"file://{tmp_path}/{name}.warc").collect()


def test_op4_ties_nulls_and_no_pages(spark, tmp_path):
    big = "y" * 1000
    rows = [(5, "u", big), (5, "u", big), (4, "u", big), (None, "v", big), (None, None, "small")]
    for name, own in (("a", rows), ("b", [])):
        spark.createDataFrame(own, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/{name}/pages.parquet")
    got = collections.Counter((r.page_id, r.record_type, r.refers_to) for r in warc.op4_warc(spark, f"{tmp_path}/a").collect())
    assert got == {(5, "response", None): 2, (4, "revisit", 5): 1, (None, "revisit", 5): 1, (None, "response", None): 1}
    assert warc.op4_warc(spark, f"{tmp_path}/b").count() == 0
    path = f"file://{tmp_path}/ids"
    pages = spark.createDataFrame(rows * 3, "page_id bigint, url string, html string")
    warc.with_revisits(pages).repartition(2).write.format("warc").mode("append").save(path)
    ids = [r.record_id for r in spark.read.format("warc").load(path).collect()]
    assert len(set(ids)) == len(ids) == 15  # repeated rows, too


def test_pcm_blocks_of_a_long_text(spark):
    df = spark.createDataFrame([(1, bytearray(b"abc" * 200_000)), (2, None)], "id int, payload binary")
    rows = media.pcm_blocks(media.decode_flac(media.encode_flac(df)).drop("payload"), 1000).orderBy("id", "first_sample").collect()
    own = [r for r in rows if r.id == 1]
    assert b"".join(bytes(r.pcm) for r in own) == media.padded(b"abc" * 200_000) and [r.first_sample for r in own] == list(range(0, len(own) * 1000, 1000))
    assert all(r.n_samples == len(r.pcm) and r.byte_offset > 0 for r in rows) and [r.n_samples for r in rows if r.id == 2] == [192]


def test_decontamination_in_many_passes(spark):
    own = [f"w{i}" for i in range(400)]
    docs = spark.createDataFrame([(1, " ".join(own)), (1, " ".join(own)), (2, None), (None, " ".join(own[:50])), (4, "else")], "doc_id bigint, text string").withColumn("sig", F.lit("kept"))
    bench = spark.createDataFrame([(i, " ".join(own[i : i + 12])) for i in range(0, 380, 10)] + [(999, None)], "item_id bigint, text string")
    got = decontamination.find_leaks(docs, bench, block=3)
    assert got.columns == ["doc_id", "text", "sig", "leaks"]
    assert sorted((r.doc_id or 0, len(r.leaks)) for r in got.collect()) == [(0, 4), (1, 38), (1, 38), (2, 0), (4, 0)]
    one = decontamination.find_leaks(docs, bench)
    plain = lambda df: collections.Counter((r.doc_id, tuple(sorted(map(str, r.leaks)))) for r in df.collect())
    assert plain(one) == plain(got)


# Wrapper induction


def _tree(html):
    return templates.tree(templates.shape_of(parsed(html))[0])[0]


def test_templates_hold_all_shapes():
    pages = ["<div class=a1><p>1<p>2</div><ul><li>x</ul>", "<div class=a22><p>1</div><span>t</span><section><p>z</section>", "<ul><li>x<li>y</ul><div class=b>q</div>"]
    shapes = [templates.shape_of(parsed(p))[0] for p in pages]
    assert shapes[0].split("\n") == ["-1 #root", "0 div a0", "0 ul", "1 p", "2 li"]
    text = templates.text_of(templates.merged(shapes))
    t = templates.Template(text)
    assert all(min(t.align(s)) >= 0 for s in shapes) and len(set(t.align(shapes[0]))) == 5
    assert templates.text_of(templates.merged([text, *shapes])) == text  # nothing is new
    for p in pages:  # the alignment is that of simple tree matching
        assert len(matched(t.root, _tree(p))) == len(templates.tree(templates.shape_of(parsed(p))[0]))


def test_slots_follow_the_alignment():
    t = templates.Template(templates.text_of(templates.merged([templates.shape_of(parsed(p))[0] for p in ("<div><h2>a</h2></div><p>x</p><div><ul><li>1</ul></div>", "<p>x</p><div><ul><li>1</ul></div>")])))
    a, b = parsed("<div><h2>a</h2></div><p>x</p><div><ul><li>1</ul></div>"), parsed("<p>x</p><div><ul><li>2<li>3</ul></div>")
    slots_a, slots_b = t.of(a), t.of(b)
    assert slots_a[id(a.elements()[2])] == slots_b[id(b.elements()[1])] != slots_a[id(a.elements()[0])]
    items = b.elements()[1].elements()[0].elements()
    assert slots_b[id(items[0])] == slots_b[id(items[1])]


def test_alignment_decides_what_is_content(spark):
    """No names tell anything: the same text is template in one place and content in another."""
    page = "<body><div>Daily News</div><div><span>{top}</span></div><div><h1>Title {i}</h1><p>{top}</p><p>Body {i}</p></div><div>Imprint</div></body>"
    rows = [(i, f"http://h/{i}", page.format(i=i, top="All about trees" if i % 2 else f"Only {i}")) for i in range(10)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in wrapper.extract(pages).collect()}
    assert got[0] == "Only 0\nTitle 0\nOnly 0\nBody 0" and got[1] == "Title 1\nAll about trees\nBody 1"
    assert wrapper.main_text(rows[1][2]).startswith("Daily News")


def test_wrapper_of_nothing_ties_and_long_pages(spark):
    schema = "page_id bigint, url string, html string"
    assert wrapper.extract(spark.createDataFrame([], schema)).count() == 0
    page = "<body><div>Shop</div><div>{0}</div></body>"
    rows = [(i, f"http://h/{i}", page.format(f"<p>Text {i}</p>" * (1 if i else 20_000))) for i in range(5)] + [(1, "http://h/1", page.format("<p>Text 1</p>"))] * 3
    got = collections.Counter((r.page_id, r.text, r.n_chars) for r in wrapper.extract(spark.createDataFrame(rows, schema)).collect())
    assert got == {(0, "\n".join(["Text 0"] * 20_000), 139_999): 1, (1, "Text 1", 6): 4, **{(i, f"Text {i}", 6): 1 for i in (2, 3, 4)}}


# Language


def test_labels_equal_whole_texts():
    """Segments with their context give what one run over the whole text gives."""
    rng = np.random.default_rng(2)
    m = gru.BiGru(["a", "b", "c"])
    m.train([bytes(rng.integers(97, 97 + 5 * (k + 1), 200, np.uint8)) for k in (0, 1, 2) for _ in range(20)], np.repeat([0, 1, 2], 20), 60)
    text = bytes(rng.integers(97, 112, 3000, np.uint8)) + b" 1 " * 50
    x = np.frombuffer(text, np.uint8)[:, None]
    prob, letters = m.positions(x)[:, 0], gru.LETTER[x[:, 0]]
    mean, votes, runs = m.label([text, b"zz"], True)[0]
    assert mean == pytest.approx(prob[letters].mean(0), abs=0.01) and abs(votes - np.bincount(prob[letters].argmax(1), minlength=3)).sum() <= 0.02 * len(text)
    assert runs[0][0] == 0 and runs[-1][1] == len(text) and all(a[1] == b[0] for a, b in zip(runs, runs[1:], strict=False))


def test_stage_without_labels(spark):
    docs = spark.createDataFrame([(1, "some words", None, "s", 1), (2, "12 3", None, "s", 1), (3, None, None, "s", 1), (4, "ü", None, "s", 1)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert sorted(r.doc_id for r in language.stage(spark, docs, "").collect()) == [1, 4]


def test_many_languages_are_all_learned(spark):
    rows = [(i, f"text {i} of this", f"l{i % 300:03d}") for i in range(900)]
    langs, texts, y = language.sample(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), most=600)
    assert len(langs) >= 250 and len(texts) == len(y) and max(collections.Counter(y.tolist()).values()) <= 2 * language.WINDOWS
    assert json.dumps(langs[0]) and pa


# N-gram join


@pytest.mark.parametrize("tile", [2048, 8])
def test_all_links_between_different_texts(spark, folder, tile):
    rows = {i: t for i, t, _ in folder[1] if i is not None}
    sets = {i: {tuple(w[j : j + 4]) for j in range(max(1, len(w) - 3))} for i, t in rows.items() if (w := words_of(t))}
    least: dict = {}
    for i in sorted(sets):
        least.setdefault(frozenset(sets[i]), i)
    heads = sorted(least.values())
    want = {(a, b) for a in heads for b in heads if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").where("doc_id IS NOT NULL")
    pairs, members = ngram_join.jaccard_pairs(docs.select("doc_id", "text"), tile=tile)
    assert {(r.a, r.b) for r in pairs.collect()} == want and len(want) > 5
    assert {(r.doc_id, r.of) for r in members.collect()} == {(i, least[frozenset(s)]) for i, s in sets.items()}


# Lattice scores


def test_long_words_go_in_stretches():
    v = lattice.Vocabulary(scoring.default_vocabulary())
    logp = np.log(v.prior)
    word = "▁" + "the quick brown fox é☃ jumps".replace(" ", "") * 20
    whole, parts = lattice.Lattice(v, [word], logp), lattice.LongWord(v, word, logp, 1)
    assert len(parts.starts) > 5 and parts.forward() == pytest.approx(whole.forward()[0])
    assert parts.expected(3.0) == pytest.approx(whole.expected(np.array([3.0])), abs=1e-9)


@pytest.mark.parametrize("stage", [language.stage, ngram_join.stage, decontamination.stage, mixing.stage])
def test_stages_keep_columns_of_any_name(spark, tmp_path, monkeypatch, stage):
    names = ["of", "gone", "leaks", "score", "lang_pred", "position_share", "rank", "base", "cut0", "take0", "size", "copies", "target", "source_size", "row", "key", "class", "sig", "id", "n", "hash", "draw", "chosen", "part", "found", "count"]
    texts = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(12)]
    rows = [(i, t, "en", "ab"[i % 2], 0, *(f"{c}{i}" for c in names)) for i, t in enumerate(texts)]
    rows += [(20, texts[3], "en", "a", 0, *(f"{c}20" for c in names)), rows[5]]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", "n_chars", *names])
    spark.createDataFrame([(i, t) for i, t in enumerate([texts[4], texts[5], "no such words here at all", "other words that nothing holds"])], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    monkeypatch.setattr(language, "train", lambda *_: gru.BiGru(["de", "en"]))
    monkeypatch.setattr(decontamination.find_leaks, "__defaults__", (decontamination.THRESHOLD, decontamination.SIZE, 1, decontamination.BLOCK_CHARS, "leaks"))
    monkeypatch.setattr(decontamination, "HELD", 1)  # many passes
    got = stage(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    kept = got.collect()
    assert kept and all(r[c] == f"{c}{r.doc_id}" for r in kept for c in names)
    if stage is ngram_join.stage:
        assert sorted(r.doc_id for r in kept) == list(range(12))
    if stage is decontamination.stage:
        assert sorted(r.doc_id for r in kept) == sorted(r[0] for r in rows if r[1] not in texts[4:6])
