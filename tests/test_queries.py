"""Every query of the library against its SQL on the same tables."""

import duckdb
import pandas as pd
import pytest

from pitlens.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    """A value as text: missing ones alike, whole numbers alike whatever their type."""
    if v is None or (pd.api.types.is_scalar(v) and pd.isna(v)) or str(v) == "NaT":
        return None
    if isinstance(v, float):
        return str(int(v)) if v.is_integer() else repr(float(v))
    return str(v)


def normal(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].astype("datetime64[us]").astype(str)
        df[c] = pd.Series([plain(v) for v in df[c]], dtype=object)
    return df.sort_values(list(df.columns), ignore_index=True)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = normal(catalog.QUERIES[name](spark, SF).toPandas())
    want = normal(duck.execute(catalog.ORACLES[name]).df())
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_all_queries_are_named():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)
    assert len(catalog.QUERIES) > 180
