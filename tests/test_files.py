"""Bounds of the files that queries write."""

import duckdb
import pandas as pd
import pytest

from pitlens.plans import files
from test_queries import SF, normal


@pytest.mark.parametrize("name, reader", [("S10_explode_submissions", "explode_submissions"), ("S11_explode_company_facts", "explode_company_facts")])
def test_json_documents_are_bounded(spark, monkeypatch, name, reader):
    read, lines = getattr(files.rd, reader), []
    monkeypatch.setattr(files, "PAGE", 64, raising=False)
    monkeypatch.setattr(files.rd, reader, lambda raw: lines.append(raw) or read(raw))
    got = normal(files.QUERIES[name](spark, SF).toPandas())
    assert max(r["value"].count("ACC-") for r in lines[0].collect()) <= 64 < len(got)
    assert lines[0].where("length(value) > 10000").count() == 0 and lines[0].count() > 50
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM read_parquet('{SF}/orders.parquet')")
    pd.testing.assert_frame_equal(got, normal(con.execute(files.ORACLES[name]).df()), check_dtype=False)
