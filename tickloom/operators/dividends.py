"""Dividend actions: flatten, normalize, deduplicate, describe."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import cleaned, iso_date, symbol_of
from ..schemas import DIVIDEND, DIVIDEND_KEY, DIVIDEND_TYPES
from .normalize import COUNT, checked

DATES = ("process_date", "declaration_date", "ex_date", "record_date", "payable_date")
FIELDS = ("id", "symbol", "type", *DATES, "cash_amount", "stock_amount", "currency", "rate")
PAYLOAD = T.StructType([T.StructField(f, T.StringType()) for f in FIELDS])
#: What each date of a dividend is for; events are anchored at ex_date.
DATE_USES = {
    "declaration_date": "announcement", "ex_date": "entitlement; anchor of event studies", "record_date": "eligibility of holders",
    "payable_date": "cash flow", "process_date": "ingestion provenance",
}


def flatten_payloads(responses: DataFrame, body: str = "body") -> DataFrame:
    """Actions of nested responses (JSON text): a list, or groups by type, at the top or below corporate_actions.

    Adds action_type, the group, the place in it and the raw action; cash comes before stock."""
    def listed(path: str) -> Column:
        return F.from_json(F.get_json_object(body, path), "array<string>")

    empty = F.array().cast("array<string>")
    parts = []
    for i, (kind, group) in enumerate(((None, None), ("cash_dividend", "cash_dividends"), ("stock_dividend", "stock_dividends"))):
        nested, top = ("$.corporate_actions", None) if group is None else (f"$.corporate_actions.{group}", f"$.{group}")
        actions = listed(nested) if top is None else F.coalesce(listed(nested), listed(top))
        rows = responses.select("*", F.posexplode(F.coalesce(actions, empty)).alias("position", "raw"))
        own = F.get_json_object("raw", "$.type")
        parts.append(rows.withColumns({"group_order": F.lit(i), "response_key": F.lit(group), "action_type": F.coalesce(F.lit(kind), own)}))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def payload_hash(raw: Column) -> Column:
    """SHA-256 of the payload with sorted keys, by Spark's JSON of a variant (numbers as Spark writes them)."""
    return F.sha2(F.to_json(F.parse_json(raw)), 256)


def canonical_hash(df: DataFrame, raw: str = "raw", out: str = "source_payload_hash") -> DataFrame:
    """SHA-256 of Python's compact JSON with sorted keys: equal to hashes that were stored before."""
    import hashlib

    @F.pandas_udf("string")
    def digest(s):
        return s.map(lambda x: None if x is None else hashlib.sha256(json.dumps(json.loads(x), sort_keys=True, separators=(",", ":")).encode()).hexdigest())

    return df.withColumn(out, digest(raw))


def normalize_dividends(df: DataFrame, source: str = "api", strict: bool = True, guard: str = COUNT) -> DataFrame:
    """The fixed columns from id, symbol, type, dates, amounts (text or numbers), currency, rate and raw.

    A cash dividend's amount falls back to rate and its currency to USD. strict: blank ids, symbols, unknown types and
    malformed dates raise."""
    for c in FIELDS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    kind = cleaned(F.col("type").cast("string"))
    cash = kind == "cash_dividend"
    number = {c: F.expr(f"try_cast({c} AS double)") for c in ("cash_amount", "stock_amount", "rate")}
    if strict:
        rules = [(F.coalesce(cleaned(F.col("id").cast("string")), F.lit("")).eqNullSafe("") | symbol_of("symbol").isNull() | ~F.coalesce(kind.isin(*DIVIDEND_TYPES), F.lit(False)), "{n} actions lack an id, a symbol or a known type")]
        for d in DATES:
            text = cleaned(F.col(d).cast("string"))
            rules.append((text.isNotNull() & iso_date(text).isNull(), "{n} values of " + d + " aren't ISO dates"))
        df = checked(df, *rules, guard=guard, carrier="symbol")
    raw = F.col("raw") if "raw" in df.columns else F.to_json(F.struct(*FIELDS))
    return df.select(
        cleaned(F.col("id").cast("string")).alias("corporate_action_id"), symbol_of("symbol").alias("symbol"), kind.alias("corporate_action_type"), F.lit(source).alias("source"),
        *(F.date_format(iso_date(F.col(d).cast("string")), "yyyy-MM-dd").alias(d) for d in DATES), F.coalesce(number["cash_amount"], F.when(cash, number["rate"])).alias("cash_amount"),
        number["stock_amount"].alias("stock_amount"), F.coalesce(cleaned("currency"), F.when(cash, F.lit("USD"))).alias("currency"), payload_hash(raw).alias("source_payload_hash"), raw.alias("raw"),
    ).select(*DIVIDEND.names)


def normalize_batch(df: DataFrame, source: str = "api", strict: bool = True) -> DataFrame:
    """As normalize_dividends, in the order of actions; repeated actions stay."""
    return normalize_dividends(df, source, strict).orderBy(*action_order())


def date_uses(spark) -> DataFrame:
    """date_field, use and whether events are anchored there: a small dimension."""
    return spark.createDataFrame([(k, v, k == "ex_date") for k, v in DATE_USES.items()], "date_field string, use string, anchor boolean")


def checked_date_field(name: str) -> str:
    """name, if it is a date of dividends; others raise."""
    if name not in DATE_USES:
        raise ValueError(f"{name} is none of {', '.join(DATE_USES)}")
    return name


def dedup_dividends(df: DataFrame, key=DIVIDEND_KEY, by: str = "source_payload_hash") -> DataFrame:
    """The row with the greatest hash of each event key."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), by).alias("r")).select(*key, "r.*").select(*df.columns)


def action_order() -> list[Column]:
    blank = F.lit("")
    when = F.coalesce(F.nullif("ex_date", blank), F.nullif("process_date", blank), blank)
    return [F.asc_nulls_last("symbol"), when, F.asc_nulls_last("corporate_action_type"), F.asc_nulls_last("corporate_action_id")]


def snapshot_metadata(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("record_count"), F.array_join(F.array_sort(F.collect_set("corporate_action_type")), ",").alias("types"),
        F.count_if(F.col("currency").isNull()).alias("missing_currency"), F.countDistinct("symbol").alias("symbol_count"), F.min("ex_date").alias("min_ex_date"), F.max("ex_date").alias("max_ex_date"),
    )


def source_counts(df: DataFrame) -> DataFrame:
    """One row: sources and action_types, in order; cash dividends whose payload names no currency; actions of nested responses."""
    raw, cash = (lambda k: cleaned(F.get_json_object("raw", f"$.{k}"))), F.col("corporate_action_type") == "cash_dividend"
    nested = {k: (F.col("corporate_action_type") == f"{k}_dividend") & (raw("_response_key") == f"{k}_dividends") for k in ("cash", "stock")}
    return df.agg(
        F.array_sort(F.collect_set("source")).alias("sources"), F.array_sort(F.collect_set("corporate_action_type")).alias("action_types"), F.count_if(cash & raw("currency").isNull()).alias("currency_missing_for_cash_dividend_count"),
        *(F.count_if(c).alias(f"nested_{k}_dividend_count") for k, c in nested.items()),
    ).withColumn("nested_response_detected", (F.col("nested_cash_dividend_count") > 0) | (F.col("nested_stock_dividend_count") > 0))


def mart_rows(df: DataFrame, guard: str = COUNT) -> DataFrame:
    """Rows of the research mart: upper-case symbols and the year of ex_date; one bad row rejects all."""
    day = iso_date(F.col("ex_date").cast("string"))
    df = checked(df, (day.isNull() | symbol_of("symbol").isNull(), "{n} rows lack a symbol or a valid ex_date"), guard=guard, carrier="symbol")
    return df.withColumns({"symbol": symbol_of("symbol"), "year": F.year(day)})
