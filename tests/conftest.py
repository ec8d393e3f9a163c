"""One session for all tests, and the comparison of queries with their SQL."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from annoweave.runtime import session

    s = session(4, spark__sql__shuffle__partitions="4", spark__ui__showConsoleProgress="false")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for f in Path(DATA).iterdir():
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return c


def canonical(df: pd.DataFrame) -> list[tuple]:
    def one(v):
        if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
            return "null"
        if isinstance(v, bool):
            return str(v)
        return repr(round(float(v), 9) + 0.0) if isinstance(v, (int, float)) or hasattr(v, "dtype") and v.dtype.kind in "iuf" else str(v)

    cols = sorted(df.columns)
    return sorted(tuple(one(v) for v in row) for row in df[cols].itertuples(index=False, name=None))


@pytest.fixture(scope="session")
def same_as_sql(spark, duck):
    def check(query, sql: str) -> None:
        mine, theirs = query(spark, DATA).toPandas(), duck.execute(sql).df()
        assert sorted(mine.columns) == sorted(theirs.columns)
        assert canonical(mine) == canonical(theirs)

    return check
