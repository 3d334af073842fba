"""Every registered measurement query against its SQL, at the smallest size."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from canonflow.registry import ORACLES, QUERIES

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        c.execute(f"CREATE VIEW \"{p.stem}\" AS SELECT * FROM read_parquet('{p}')")
    return c


def _rows(df: pd.DataFrame) -> list[tuple]:
    def text(v):
        if pd.isna(v):
            return "null"
        return repr(round(float(v), 6)) if isinstance(v, (int, float)) or hasattr(v, "dtype") else str(v)

    return sorted(tuple(text(v) for v in row) for row in df[sorted(df.columns)].astype(object).itertuples(index=False))


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.skipif(not DATA.exists(), reason="the test tables aren't here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    ours, theirs = QUERIES[name](spark, str(DATA)).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert _rows(ours) == _rows(theirs)
