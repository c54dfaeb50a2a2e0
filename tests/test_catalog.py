"""Every query against its SQL, on the smallest data and on the next size."""

import math
import os

import duckdb
import pandas as pd
import pytest

from feedertrace.plans import catalog, flows  # noqa: F401  (flows adds its queries to the catalog's)

DATA = "/root/testdata"
TABLES = "region nation customer supplier part orders lineitem events embeddings".split()


def plain(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
        return None
    if hasattr(x, "tolist"):
        return plain(x.tolist())
    if isinstance(x, (list, tuple)):
        return [plain(y) for y in x]
    if isinstance(x, bool):
        return x
    if isinstance(x, (int, float)) or type(x).__name__ == "Decimal":
        return float(f"{float(x):.9g}")
    # A date comes as a date from one side and as its midnight from the other.
    return str(x).removesuffix(" 00:00:00")


def rows(frame: pd.DataFrame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(map(str, ([plain(x) for x in r] for r in frame.itertuples(index=False))))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's data are not there")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, name):
    d = f"{DATA}/sf0.01" if name not in () else f"{DATA}/sf0.001"
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    want = con.sql(catalog.ORACLES[name]).df()
    got = catalog.QUERIES[name](spark, d).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want) and len(got)
    assert rows(got) == rows(want)
