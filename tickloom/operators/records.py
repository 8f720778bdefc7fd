"""Python records of dividends as a DataFrame of the fixed columns."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import asdict, is_dataclass

from pyspark.sql import DataFrame, SparkSession

from ..schemas import DIVIDEND


def canonical_json(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, default=str)


def dividend_frame(spark: SparkSession, records: Iterable | DataFrame) -> DataFrame:
    """Records (mappings or dataclasses) or a DataFrame with the 14 fixed columns, in their order; a missing one raises.

    A record's raw object becomes JSON with sorted keys. For what a caller holds in hand; larger inputs come as DataFrames."""
    if isinstance(records, DataFrame):
        missing = [c for c in DIVIDEND.names if c not in records.columns]
        if missing:
            raise ValueError(f"dividends lack {missing}")
        return records.select(*DIVIDEND.names)
    rows = []
    for r in records:
        row = asdict(r) if is_dataclass(r) else dict(r)
        missing = [c for c in DIVIDEND.names if c not in row]
        if missing:
            raise ValueError(f"dividends lack {missing}")
        if isinstance(row["raw"], Mapping):
            row["raw"] = canonical_json(row["raw"])
        rows.append(tuple(row[c] if row[c] is None or DIVIDEND[c].dataType.typeName() != "double" else float(row[c]) for c in DIVIDEND.names))
    return spark.createDataFrame(rows, DIVIDEND)
