"""Domain tables derived from the star schema, as SQL that Spark and the checking engine both read.

Each text names its source tables in braces. `frame` runs one in Spark; `ctes` puts them before a checking query.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

INPUTS = {
    "bars": """
      SELECT concat('S', CAST(l_suppkey AS STRING)) AS symbol, CAST(l_shipdate AS DATE) AS bar_date, (max(p) + min(p)) / 2 AS adj_open,
        max(p) AS adj_high, min(p) AS adj_low, avg(p) AS adj_close, CAST(sum(l_quantity) AS BIGINT) AS volume
      FROM (SELECT l_suppkey, l_shipdate, l_quantity, l_extendedprice / l_quantity AS p FROM {lineitem}) x GROUP BY l_suppkey, CAST(l_shipdate AS DATE)""",
    "instruments": """
      SELECT concat('S', CAST(s_suppkey AS STRING)) AS symbol, concat('INST:', CAST(s_suppkey AS STRING)) AS instrument_id,
        concat('CO:', CAST(s_suppkey AS STRING)) AS company_id FROM {supplier} WHERE s_suppkey % 11 <> 0""",
    "universe": """
      SELECT concat('S', CAST(s_suppkey AS STRING)) AS symbol, s_acctbal > 1000 AS include_in_universe FROM {supplier}""",
    "short_volume": """
      SELECT concat('S', CAST(l_suppkey AS STRING)) AS symbol, CAST(l_shipdate AS DATE) AS trade_date, CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS DOUBLE) AS short_volume,
        CAST(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS DOUBLE) AS short_exempt_volume, CAST(sum(CASE WHEN l_linestatus = 'Z' THEN 0 ELSE l_quantity END) AS DOUBLE) AS total_volume,
        concat('file', CAST(max(l_linenumber) AS STRING)) AS source_file, CAST(CAST(l_shipdate AS DATE) + INTERVAL '1' DAY AS TIMESTAMP) AS available_at
      FROM {lineitem} GROUP BY l_suppkey, CAST(l_shipdate AS DATE), l_linenumber % 2""",
    "short_interest": """
      SELECT concat('S', CAST(o_custkey AS STRING)) AS symbol, CAST(date_trunc('month', o_orderdate) AS DATE) AS settlement_date, CAST(floor(sum(o_totalprice)) AS BIGINT) AS short_interest,
        CAST(floor(sum(o_totalprice) * 0.9) AS BIGINT) AS previous_short_interest, CAST(count(*) * 1000 AS DOUBLE) AS avg_daily_volume, CAST(count(*) * 1000000 AS BIGINT) AS shares_float,
        CASE WHEN o_orderstatus = 'F' THEN 'regular' ELSE 'otc' END AS source_market, concat('si', o_orderstatus) AS source_file, CAST(max(o_orderdate) AS TIMESTAMP) AS ingested_at
      FROM {orders} GROUP BY o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE), o_orderstatus""",
    "fundamentals": """
      SELECT concat('CO:', CAST(o_custkey AS STRING)) AS company_id, CAST(o_orderdate AS DATE) AS effective_as_of_date, CAST(o_orderdate AS TIMESTAMP) AS available_at,
        CAST(date_trunc('month', o_orderdate) AS DATE) AS period_end_date, o_orderkey AS filing, o_totalprice AS revenue, o_totalprice * 0.1 AS net_income,
        CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice * 3 END AS assets, o_totalprice * 1.5 AS equity
      FROM {orders}""",
    "memberships": """
      SELECT concat('S', CAST(o_custkey AS STRING)) AS symbol, CAST(min(o_orderdate) AS DATE) AS effective_from,
        CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE CAST(max(o_orderdate) AS DATE) END AS effective_to FROM {orders} GROUP BY o_custkey, o_orderpriority""",
    "articles": """
      SELECT event_id AS raw_id, ts AS published_at, concat('Story about S', CAST(user_id AS STRING), ' and value ', event_type) AS title, concat('http://news.example/', CAST(event_id AS STRING)) AS url,
        concat('S', CAST(user_id AS STRING)) AS symbol, event_type AS source_name, value FROM {events}""",
    "days": """
      SELECT DISTINCT CAST(ts AS DATE) AS bar_date FROM {events} WHERE dayofmonth(CAST(ts AS DATE)) % 7 NOT IN (6, 0)""",
    "prices_base": """
      SELECT concat(CASE WHEN l_linenumber % 2 = 0 THEN ' s' ELSE 'S' END, CAST(l_suppkey AS STRING)) AS symbol, CAST(l_shipdate AS DATE) AS price_date, max(l_extendedprice) AS open, max(l_extendedprice) + 1 AS high,
        min(l_extendedprice) AS low, min(l_extendedprice) AS close, CAST(sum(l_quantity) AS BIGINT) AS volume, concat('base', CAST(l_linenumber % 2 AS STRING)) AS source_name, CAST(max(l_shipdate) AS TIMESTAMP) AS ingested_at
      FROM {lineitem} WHERE l_orderkey % 3 <> 0 GROUP BY l_suppkey, CAST(l_shipdate AS DATE), l_linenumber % 2""",
    "prices_preferred": """
      SELECT concat('S', CAST(l_suppkey AS STRING)) AS symbol, CAST(l_shipdate AS DATE) AS price_date, max(l_extendedprice) + 2 AS open, max(l_extendedprice) + 3 AS high,
        min(l_extendedprice) AS low, min(l_extendedprice) + 1 AS close, CAST(sum(l_quantity) AS BIGINT) AS volume, 'preferred' AS source_name, CAST(max(l_shipdate) AS TIMESTAMP) AS ingested_at
      FROM {lineitem} WHERE l_orderkey % 3 = 0 GROUP BY l_suppkey, CAST(l_shipdate AS DATE)""",
    "prices_loaded": """
      SELECT concat('S', CAST(l_suppkey AS STRING)) AS symbol, CAST(l_shipdate AS DATE) AS price_date, max(l_extendedprice) + 2 AS open, max(l_extendedprice) + 3 AS high,
        min(l_extendedprice) AS low, min(l_extendedprice) + 1 AS close, CAST(sum(l_quantity) AS BIGINT) AS volume, 'preferred' AS source_name, CAST(max(l_shipdate) AS TIMESTAMP) AS ingested_at
      FROM {lineitem} GROUP BY l_suppkey, CAST(l_shipdate AS DATE)""",
    "raw_bars": """
      SELECT CASE WHEN l_orderkey % 97 = 0 THEN '  ' ELSE concat(' s', CAST(l_suppkey AS STRING)) END AS symbol, l_orderkey * 10 + l_linenumber AS bar_id, CAST(l_shipdate AS DATE) AS price_date, CASE WHEN l_linenumber = 1 THEN NULL ELSE l_extendedprice END AS open,
        CASE WHEN l_linenumber = 2 THEN NULL ELSE l_extendedprice + l_quantity - 5 END AS high, l_extendedprice - l_tax * 100 AS low, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice - 1 END AS close,
        CASE WHEN l_linenumber = 4 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS volume FROM {lineitem}""",
    "candidates": """
      SELECT s_suppkey, concat(' s', CAST(s_suppkey - s_suppkey % 3 AS STRING)) AS symbol, concat(s_name, CASE s_suppkey % 9 WHEN 0 THEN ', Inc.' WHEN 1 THEN ' Holdings Corp' WHEN 2 THEN ' ETF Trust' WHEN 3 THEN ' Group Ltd ADR'
        WHEN 4 THEN ' Warrant' WHEN 5 THEN ' Preferred' WHEN 6 THEN ' Units' WHEN 7 THEN ' Rights' ELSE ' Company' END) AS company_name, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE lpad(CAST(s_suppkey - s_suppkey % 2 AS STRING), 10, '0') END AS cik,
        CASE s_nationkey % 6 WHEN 0 THEN 'NasdaqGS' WHEN 1 THEN 'New York' WHEN 2 THEN 'OTCQX' WHEN 3 THEN ' nyse-american ' WHEN 4 THEN 'NYSE' ELSE NULL END AS exchange_raw,
        CASE s_suppkey % 5 WHEN 0 THEN 'Common Stock' WHEN 1 THEN 'ETF' WHEN 2 THEN NULL ELSE 'Common Stock' END AS security_type_raw,
        CASE WHEN s_suppkey % 2 = 0 THEN 'sec_tickers' ELSE 'nasdaq_listed' END AS source_name, CAST(DATE '2024-01-01' + INTERVAL '1' DAY * (s_suppkey % 3) AS DATE) AS as_of_date, s_acctbal FROM {supplier}""",
    "filing_index": """
      SELECT CAST(o_custkey + 1 AS STRING) AS cik, concat('ACC-', CAST(o_orderkey - o_orderkey % 2 AS STRING)) AS accession_number, CASE o_orderstatus WHEN 'F' THEN '10-K' ELSE '10-Q' END AS form_type,
        CAST(o_orderdate AS DATE) AS filing_date, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderdate AS TIMESTAMP) END AS accepted_at, o_orderkey FROM {orders}""",
    "companies": """
      SELECT lpad(CAST(s_suppkey + 1 AS STRING), 10, '0') AS cik, concat('CO:', CAST(s_suppkey AS STRING)) AS company_id FROM {supplier} WHERE s_suppkey % 50 <> 7""",
    "facts": """
      SELECT concat('ACC-', CAST(o_orderkey - o_orderkey % 2 AS STRING)) AS accession_number, CAST(o_custkey + 1 AS STRING) AS cik, ' US-GAAP' AS taxonomy,
        CASE o_orderkey % 10 WHEN 0 THEN 'Revenues' WHEN 1 THEN ' Assets ' WHEN 2 THEN 'StockholdersEquity' WHEN 3 THEN 'NetIncomeLoss' WHEN 4 THEN 'Liabilities' WHEN 5 THEN 'ProfitLoss' WHEN 6 THEN '' WHEN 7 THEN 'NetCashProvidedByUsedInOperatingActivities' WHEN 8 THEN 'EntityCommonStockSharesOutstanding' ELSE 'Other' END AS concept,
        'USD' AS unit, CAST(date_trunc('month', o_orderdate) AS DATE) AS period_end_date, CAST(NULL AS DATE) AS period_start_date, ' ' AS frame, o_totalprice AS value_numeric, CAST(o_orderdate AS TIMESTAMP) AS ingested_at, o_orderkey FROM {orders}""",
    "references": """
      SELECT concat('S', CAST(s_suppkey AS STRING)) AS symbol, CASE ord WHEN 0 THEN concat('s', CAST(s_suppkey AS STRING), ' and') ELSE concat('Story about S', CAST(s_suppkey AS STRING), ' and value') END AS phrase, ord,
        s_suppkey % 4 <> 0 AS symbol_match_enabled, s_suppkey % 5 <> 0 AS name_match_enabled FROM {supplier} CROSS JOIN (SELECT 0 AS ord UNION ALL SELECT 1 AS ord) o""",
    "aliases": """
      SELECT concat('S', CAST(s_suppkey AS STRING)) AS symbol, CASE ord WHEN 0 THEN CASE s_suppkey % 3 WHEN 0 THEN 'value click' WHEN 1 THEN 'view' ELSE 'and' END
        WHEN 1 THEN concat('s', CAST(s_suppkey AS STRING), ' and') ELSE concat('Story about S', CAST(s_suppkey AS STRING), ' and value') END AS phrase, ord
      FROM {supplier} CROSS JOIN (SELECT 0 AS ord UNION ALL SELECT 1 AS ord UNION ALL SELECT 2 AS ord) o""",
    "snapshots": """
      SELECT concat('S', CAST(k AS STRING)) AS symbol, CASE WHEN k % 6 = 0 THEN NULL ELSE lpad(CAST(k - k % 2 AS STRING), 10, '0') END AS cik, concat('Company ', CAST(k - k % 2 AS STRING), CASE WHEN as_of_date >= DATE '2000-01-01' AND k % 4 = 0 THEN ' New' ELSE '' END) AS company_name,
        CASE WHEN k % 5 = 0 AND as_of_date >= DATE '1998-01-01' THEN 'NYSE' WHEN k % 13 = 0 THEN 'OTC' ELSE 'NASDAQ' END AS exchange, CASE WHEN k % 7 = 0 AND as_of_date >= DATE '1999-01-01' THEN 'ADR' ELSE 'COMMON_STOCK' END AS security_type, as_of_date, ingested_at
      FROM (SELECT o_custkey AS k, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS as_of_date, CAST(max(o_orderdate) AS TIMESTAMP) AS ingested_at FROM {orders} GROUP BY 1, 2) x""",
    "requests": """
      SELECT o_orderkey, concat('CO:', CAST(o_custkey AS STRING)) AS company_id, CASE WHEN o_orderkey % 2 = 0 THEN '10-K' ELSE '10-Q' END AS form_type, CAST(CAST(o_orderdate AS DATE) + INTERVAL '30' DAY AS TIMESTAMP) AS as_of FROM {orders}""",
    "provider_symbols": """
      SELECT p_partkey, concat(upper(substr(p_name, 1, 3)), CASE p_partkey % 9 WHEN 0 THEN '.B' WHEN 1 THEN '-W' WHEN 2 THEN '.RT' WHEN 3 THEN '$C' WHEN 4 THEN '-UN' WHEN 5 THEN '.PA' WHEN 6 THEN '' WHEN 7 THEN '/B' ELSE 'X ' END) AS symbol FROM {part}""",
}


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(re.sub(r"\{(\w+)\}", lambda m: f"parquet.`{sf_dir}/{m[1]}.parquet`", INPUTS[name]))


def ctes(*names: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({re.sub(r'[{](\w+)[}]', r'\1', INPUTS[n])})" for n in names)