"""Every query of the engine against DuckDB on the smallest tables."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from millrace.plans import catalogue, catalogue_engine  # noqa: F401  (the second adds to the first)

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the driver's tables are absent")


def plain(df):
    def text(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return None
        return f"{v:.9g}" if isinstance(v, float) else str(v)

    return sorted((tuple(map(text, r)) for r in df[sorted(df.columns)].itertuples(index=False)), key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


@pytest.mark.parametrize("name", [n for n in catalogue.QUERIES if n not in ("stream_upsert",)])
def test_query(spark, duck, name):
    got = catalogue.QUERIES[name](spark, SF).toPandas()
    if name in catalogue.SQL:
        want = duck.execute(catalogue.SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert plain(got) == plain(want)
