"""Bars and dividends derived from the driver's tables, as DataFrames and as common table expressions for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Windows of the queries that are about a window: coverage, session lists, the exchange's calendar of a year.
START, END = "2024-01-05", "2024-01-20"
YEAR_START, YEAR_END = "1996-01-01", "1996-12-31"

BARS_1M = """bars_1m AS (
SELECT upper(event_type) AS symbol, date_trunc('minute', ts) AS ts_utc, value AS open, value + ((event_id % 7) - 1) * 0.1 AS high, value - ((event_id % 5) - 1) * 0.1 AS low,
 value + ((event_id % 3) - 1) * 0.05 AS close, CAST((event_id % 11) - 1 AS BIGINT) AS volume, 'synthetic' AS source, '1Min' AS timeframe, event_id FROM events)"""
BARS_DAILY = """bars_daily AS (
SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS d, min_by(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low,
 max_by(o_totalprice, o_orderkey) AS close, COUNT(*) AS volume FROM orders GROUP BY o_orderpriority, CAST(o_orderdate AS DATE))"""
DIVIDENDS = """dividends AS (
SELECT concat('ca-', CAST(o_orderkey AS STRING)) AS corporate_action_id, o_orderpriority AS symbol, CASE WHEN o_orderkey % 2 = 0 THEN 'cash_dividend' ELSE 'stock_dividend' END AS corporate_action_type,
 CAST(o_orderdate AS DATE) AS ex_date, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice / 1E5 END AS cash_amount, CASE WHEN o_orderkey % 2 = 1 THEN 0.05 END AS stock_amount,
 CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'USD' END AS currency, o_orderkey FROM orders)"""
#: Columns of the base tables: with them a scan needs no look at the files beforehand.
BASES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
}
PARTS = {"bars_1m": (BARS_1M, "events"), "bars_daily": (BARS_DAILY, "orders"), "dividends": (DIVIDENDS, "orders")}


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(BASES[name]).parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql, base = PARTS[name]
    return spark.sql(f"WITH {sql} SELECT * FROM {name}".replace(f"FROM {base}", "FROM {base}"), base=base_table(spark, sf_dir, base))


def with_views(*names: str) -> str:
    return "WITH " + ",\n".join(PARTS[n][0] for n in names)
