"""The queries over bars and dividends against their SQL, on the driver's smallest tables."""

from pathlib import Path

import duckdb
import pytest

from tickloom.plans import catalogue

TABLES = Path("/root/testdata/sf0.001")


def _plain(x):
    if isinstance(x, float):
        return float(f"{x:.9g}")
    if isinstance(x, dict):
        return tuple(sorted((k, _plain(v)) for k, v in x.items()))
    if isinstance(x, list | tuple):
        return tuple(map(_plain, x))
    return x if x is None or isinstance(x, int | str) else str(x)


def _rows(names: list[str], rows) -> list[str]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(repr([_plain(r[i]) for i in order]) for r in rows)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES.glob("*.parquet"):
        con.execute(f"CREATE VIEW {t.stem} AS SELECT * FROM '{t}'")
    return con


@pytest.mark.skipif(not TABLES.exists(), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query(spark, db, name):
    got = catalogue.QUERIES[name](spark, str(TABLES))
    want = db.execute(catalogue.ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows(names, want.fetchall())
