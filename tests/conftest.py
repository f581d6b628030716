from __future__ import annotations

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from tabprep.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tabprep-tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    return spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")


def values(df, *cols):
    """All rows of some columns as sorted tuples."""
    got = [tuple(r) for r in df.select(*(cols or df.columns)).collect()]
    return sorted(got, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))
