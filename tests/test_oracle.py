"""Every registered query against its SQL, on the smallest driver tables."""

from __future__ import annotations

import pathlib

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract

DATA = pathlib.Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in sorted(DATA.glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    yield con
    con.close()


def _rows(frame: pd.DataFrame) -> list[tuple]:
    ordered = frame[sorted(frame.columns)].astype(object)
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in ordered.itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_matches_sql(spark, duck, name):
    got = contract.queries()[name](spark, str(DATA)).toPandas()
    want = duck.execute(contract.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    got_rows, want_rows = _rows(got), _rows(want)
    assert len(got_rows) == len(want_rows)
    for g, w in zip(got_rows, want_rows):
        assert g == pytest.approx(w, rel=1e-9, abs=1e-9, nan_ok=True) if all(
            isinstance(v, (int, float)) for v in g) else g == w


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_rows_only(spark, name):
    assert contract.queries()[name](spark, str(DATA)).count() > 0


def test_entry(spark):
    row = contract.entry(spark).first()
    assert row["n_train"] > 0 and row["n_test"] > 0


def test_oracles_have_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())
