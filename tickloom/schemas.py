"""Fixed schemas: empty results keep their types."""

from __future__ import annotations

from pyspark.sql import types as T

KINDS = {"string": T.StringType(), "timestamp": T.TimestampType(), "double": T.DoubleType(), "bigint": T.LongType(), "int": T.IntegerType()}


def _schema(text: str) -> T.StructType:
    return T.StructType([T.StructField(*(lambda n, k: (n, KINDS[k]))(*f.split())) for f in text.split(",")])


BAR = _schema("symbol string, timeframe string, source string, ts_utc timestamp, open double, high double, low double, close double, volume bigint, year int, date string")
BAR_KEY = ("symbol", "ts_utc", "timeframe")
CANONICAL_BAR = ("symbol", "timeframe", "source", "ts_utc", "open", "high", "low", "close", "volume")
DIVIDEND = _schema(
    "corporate_action_id string, symbol string, corporate_action_type string, source string, process_date string, declaration_date string, ex_date string, record_date string, "
    "payable_date string, cash_amount double, stock_amount double, currency string, source_payload_hash string, raw string"
)
DIVIDEND_KEY = ("symbol", "ex_date", "process_date", "corporate_action_type", "corporate_action_id")
DIVIDEND_TYPES = ("cash_dividend", "stock_dividend")
