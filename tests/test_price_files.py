"""Price files whose sums are rounded, against SQL."""

import datetime

import duckdb
from test_queries import normal

from pitlens.plans import catalog

SF = "/root/testdata/sf0.001"


def test_high_of_low_quantities_does_not_fall_under_the_low(spark, tmp_path):
    prices = (1019.6, 1021.12, 4091.23, 16381.13, 32764.31, 32767.34, 65533.68, 65533.9, 70000.0)
    rows = [(k, k, k, line, float(q), price, 0.0, 0.0, "N", "O", datetime.datetime(2000, 1, 1 + k)) for k, price in enumerate(prices) for q in (4, 5, 6) for line in (1, 2, 3)]
    spark.createDataFrame(rows, spark.read.parquet(f"{SF}/lineitem.parquet").schema).write.parquet(str(tmp_path / "lineitem.parquet"))
    got = normal(catalog.QUERIES["S3_read_price_any"](spark, str(tmp_path)).toPandas())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    want = normal(con.execute(catalog.ORACLES["S3_read_price_any"]).df())
    assert got.equals(want) and len(got) == 2 * 2 * len(prices)
