"""Every registered query of the library against DuckDB on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from agroplan.plans import registry

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in "region nation customer supplier part orders lineitem events".split():
        path = f"{DATA}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows(spark, duck, name):
    ours = registry.queries()[name](spark, DATA).toPandas()
    theirs = duck.execute(registry.oracle_sql()[name]).fetchdf()
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    a, b = (d[columns].sort_values(columns).reset_index(drop=True) for d in (ours, theirs))
    assert len(a) == len(b)
    for c in columns:
        x, y = a[c], b[c]
        if str(y.dtype).startswith("datetime") and x.dtype == object:
            x = pd.to_datetime(x).astype(y.dtype)
        assert ((x == y) | (x.isna() & y.isna())).all(), c
