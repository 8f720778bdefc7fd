"""Secret scans through a trigram inverted index, all in DataFrame operations.

Each rule's regular expression gives a Boolean trigram query. The index holds postings (trigram, document) of the trigrams
that the rules name; a rule's postings are intersected by counting, for each document, the trigrams of a conjunction that
it holds. Candidates are verified on their whole texts; rules without mandatory trigrams scan all texts. Just candidates'
texts are read again, by a broadcast of their keys if those were counted few, else by a join.

Positions are code points. Null and empty texts have no spans. A row's key is its id and a hash of its text: null ids
are allowed, repeated rows get equal results. An empty table gives no rows. Extra columns are left out. Texts of any
length are scanned whole; a text's matches of one rule are put in order by one task.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import maybe_broadcast, stored, table
from .trigrams import query


class Rule(NamedTuple):
    kind: str
    regex: str
    #: Group whose length counts, and the least length.
    group: int = 0
    least: int = 0


# The rules of the contract, then further ones. Case is written as in (?i:...) for the parts where it's ignored.
BASE = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
]
MORE = [
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{20,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    Rule("url_password", r"[a-z][a-z0-9+.-]{1,20}://[^\x20\x09-\x0D:/@]{1,64}:[^\x20\x09-\x0D:/@]{3,64}@"),
]
RULES = BASE + MORE


def _postings(keyed: DataFrame, vocabulary: list[str]) -> DataFrame:
    """trigram, doc_id, hash: which documents hold the trigrams of the vocabulary. Letters count in lower case."""
    low = keyed.select("doc_id", "hash", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in vocabulary)))
    return low.select("doc_id", "hash", F.explode(held).alias("trigram"))


def _candidates(postings: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """doc_id, hash, kinds: the rules one of whose conjunctions the document's postings fulfil."""
    rows = [F.struct(F.lit(t).alias("trigram"), F.lit(kind).alias("kind"), F.lit(i).alias("clause"), F.lit(len(c)).alias("need")) for kind, clauses in queries.items() for i, c in enumerate(clauses) for t in sorted(c)]
    wanted = postings.sparkSession.range(1).select(F.inline(F.array(*rows)))
    met = postings.join(F.broadcast(wanted), "trigram").groupBy("doc_id", "hash", "kind", "clause", "need").agg(F.size(F.collect_set("trigram")).alias("held"))
    return met.where("held = need").groupBy("doc_id", "hash").agg(F.collect_set("kind").alias("kinds"))


def _spans(rows: DataFrame, rules: list[Rule], use) -> DataFrame:
    """doc_id, hash, kind, start, end of the matches. Starts add up the lengths of what stands between matches and of the matches before."""
    def found(r: Rule) -> Column:
        gaps = F.transform(F.split("text", r.regex, -1), F.char_length)
        whole = F.transform(F.regexp_extract_all("text", F.lit(r.regex), F.lit(0)), F.char_length)
        part = F.transform(F.regexp_extract_all("text", F.lit(r.regex), F.lit(r.group)), F.char_length)
        return F.struct(F.lit(r.kind).alias("kind"), F.lit(r.least).alias("least"), F.when(use(r), F.arrays_zip(gaps.alias("gap"), whole.alias("size"), part.alias("part"))).alias("at"))

    each = rows.select("doc_id", "hash", F.inline(F.array(*map(found, rules))))
    each = each.select("doc_id", "hash", "kind", "least", F.posexplode("at").alias("pos", "m")).select("doc_id", "hash", "kind", "least", "pos", "m.*").where("size IS NOT NULL")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    once = each.repartition(parts, "doc_id", "hash", "kind").dropDuplicates(["doc_id", "hash", "kind", "pos"])  # repeated rows have equal matches
    end = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("doc_id", "hash", "kind").orderBy("pos")).cast("long")
    ended = once.withColumn("end", end)
    return ended.where("part >= least").select("doc_id", "hash", "kind", (F.col("end") - F.col("size")).alias("start"), "end")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))


def trigram_index(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """The stored postings (doc_id, hash, trigram) of the trigrams that the rules name: once for several scans of docs by these rules or some of them."""
    named = [query(r.regex) for r in rules]
    return stored(_postings(_keyed(docs), sorted({t for q in named if q for c in q for t in c})), "postings")


def find_secrets(docs: DataFrame, rules: list[Rule] = RULES, index: DataFrame | None = None) -> DataFrame:
    """doc_id, hash and spans (kind, start, end; in order of start, then of the rules) of docs (doc_id, text), null without any. index: their trigram_index, if there is one."""
    keyed = _keyed(docs)
    queries = {r.kind: query(r.regex) for r in rules}
    scanned = [r for r in rules if queries[r.kind] is None]
    indexed = [r for r in rules if queries[r.kind] is not None]
    parts = [_spans(keyed.where(F.col("text").rlike(r.regex)), [r], lambda _: F.lit(True)) for r in scanned]
    if indexed:
        postings = trigram_index(docs, indexed) if index is None else index
        candidates = stored(_candidates(postings, {r.kind: queries[r.kind] for r in indexed}), "candidates")
        few = maybe_broadcast(candidates.select(F.col("doc_id").alias("of"), F.col("hash").alias("as"), "kinds"))
        rows = keyed.join(few, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("hash") == F.col("as")))
        parts.append(_spans(rows, indexed, lambda r: F.array_contains("kinds", r.kind)))
    spans = parts[0]
    for p in parts[1:]:
        spans = spans.unionByName(p)
    order = F.array_position(F.array(*(F.lit(r.kind) for r in rules)), F.col("kind"))
    listed = F.sort_array(F.collect_list(F.struct("start", order.alias("rule"), "end", "kind")))
    grouped = spans.groupBy(F.col("doc_id").alias("of"), F.col("hash").alias("as")).agg(listed.alias("spans"))
    grouped = stored(grouped, "spans")
    many = grouped.agg(F.coalesce(F.sum(F.size("spans")), F.lit(0))).first()[0]  # a document can hold any number
    return keyed.select("doc_id", "hash").join(maybe_broadcast(grouped, many), F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("hash") == F.col("as")), "left").drop("of", "as")


def _of(kinds: list[str]):
    return lambda s: s["kind"].isin(kinds)


def _joined(kinds: list[str] | None = None) -> Column:
    spans = F.col("spans") if kinds is None else F.filter("spans", _of(kinds))
    return F.coalesce(F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","), F.lit(""))


def op3_secrets(spark, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = [r.kind for r in BASE]
    counts = [F.when(F.col("spans").isNull(), 0).otherwise(F.size(F.filter("spans", _of([k])))).cast("long").alias(f"n_{k}") for k in base]
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined().alias("spans"))


def _either_case(regex: str) -> str:
    """The regular expression with (?i:...) spelled out, so that just ASCII letters have two cases."""
    while (at := regex.find("(?i:")) >= 0:
        end = regex.index(")", at)
        regex = regex[:at] + "(?:" + "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in regex[at + 4 : end]) + regex[end:]
    return regex


def sql(rules: list[Rule] = RULES) -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    parts = []
    for i, r in enumerate(rules):
        x = quoted(_either_case(r.regex))
        parts.append(
            f"SELECT doc_id, {i} AS rule, '{r.kind}' AS kind, unnest(range(1, len(m) + 1)) AS i, g, m, p, {r.least} AS least FROM (SELECT doc_id, regexp_split_to_array(t, {x}) AS g,"
            f" regexp_extract_all(t, {x}) AS m, regexp_extract_all(t, {x}, {r.group}) AS p FROM d WHERE regexp_matches(t, {x}))"
        )
    base = ", ".join(f"'{r.kind}'" for r in BASE)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join(parts)}),
s AS (SELECT doc_id, rule, kind, length(p[i]) AS part, least, CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a, length(m[i]) AS n FROM f),
k AS (SELECT *, kind || ':' || a || ':' || (a + n) AS span FROM s WHERE part >= least),
c AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  coalesce(string_agg(span, ',' ORDER BY a, rule) FILTER (kind IN ({base})), '') AS base, string_agg(span, ',' ORDER BY a, rule) AS spans FROM k GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN c USING (doc_id)"""


SQL = {"op3_secrets": sql()}
