"""Queries of readers, writers and increments. Each writes its text files from the given tables by Spark and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.shared import scratch
from ..operators import universe as u
from ..sources import readers as rd
from ..sources import sinks as sk
from ..streaming import incremental as inc
from .features import places, rounded
from .inputs import ctes, frame
from .market import EFFECTIVE, effective


def r(*columns: str) -> str:
    return ", ".join(f"round({x}, {places(x)}) + 0.0 AS {x}" for x in columns)


def table(s, d, name):
    return s.read.parquet(f"{d}/{name}.parquet")


def written(s, df, name, header=None, by=None, sep=","):
    """Lines of all columns of `df` as text files in folders `by`, with a header line in each part if given; the path."""
    path = scratch(s, name)
    (df.write.partitionBy(*by) if by else df.write).csv(path, header=bool(header), sep=sep)
    return path


def stooq(s, d):
    li = table(s, d, "lineitem")
    kinds = F.when(F.col("l_suppkey") % 3 == 0, "nasdaq stocks").when(F.col("l_suppkey") % 3 == 1, "nyse etfs").otherwise("other")
    rows = li.groupBy(F.concat(F.lit("s"), F.col("l_suppkey").cast("string"), F.lit(".us")).alias("<TICKER>"), F.when(F.col("l_linenumber") == 7, "W").otherwise("D").alias("<PER>"), F.date_format("l_shipdate", "yyyyMMdd").alias("<DATE>"), kinds.alias("group"))
    rows = rows.agg(F.max("l_extendedprice").alias("<OPEN>"), F.max("l_extendedprice").alias("<HIGH>"), F.min("l_extendedprice").alias("<LOW>"), F.min("l_extendedprice").alias("<CLOSE>"), F.sum("l_quantity").alias("<VOL>"))
    return written(s, rows, "stooq", True, ["group"])


def stooq_rows(s, d):
    return rounded(rd.read_stooq_bars(s, stooq(s, d)).drop("source_path"))


def prices_csv(s, d):
    return written(s, frame(s, d, "prices_loaded").select("symbol", "price_date", "open", "high", "low", "close", "volume", "source_name"), "prices", True)


def price_any(s, d):
    # quantities are whole, so that 5 of them add nothing: with the price first, sums beyond a power of two are rounded, and the high fell under the low
    li = table(s, d, "lineitem").select(F.concat(F.lit(" s"), F.col("l_suppkey").cast("string")).alias("Symbol"), F.to_date("l_shipdate").alias("Date"), F.col("l_extendedprice").alias("Open"), (F.col("l_extendedprice") + (F.col("l_quantity") - 5)).alias("High"), F.col("l_extendedprice").alias("Low"), F.when(F.col("l_linenumber") == 3, "n/a").otherwise(F.col("l_extendedprice").cast("string")).alias("Adj Close"), F.when(F.col("l_linenumber") > 1, F.col("l_quantity")).alias("Volume"))
    return rounded(rd.read_price_any(s, written(s, li, "any", True)))


def yahoo(s, d):
    path = scratch(s, "yahoo")
    base = frame(s, d, "prices_loaded").withColumnRenamed("ingested_at", "fetched_at")
    base.select("symbol", "price_date", "open", "high", "low", "close", "volume", "source_name", "fetched_at", F.lit("r1").alias("run_id"), F.concat(F.year("price_date"), F.lit("-12-31")).alias("run_date")).write.partitionBy("run_id", "run_date").json(path)
    return path, base


def yahoo_rows(s, d):
    path, base = yahoo(s, d)
    return rounded(rd.read_yahoo_jsonl(s, path, base.where("volume > 30")).select("symbol", "price_date", "close", "volume", "run_id", "run_date"))


def yahoo_manifest(s, d):
    return rd.yahoo_manifest(s, yahoo(s, d)[0]).groupBy("run_id", "run_date").agg(F.sum("rows_loaded").alias("rows_loaded"))


def file_counts(s, d):
    rows = short_volume(s, d)
    old = rows.groupBy("source_file", "publication_date", "market_code").agg((-F.count("*")).alias("row_count"))
    fresh = rd.load_only_new_files(rows, old.where("publication_date = date'2024-02-15'"))
    return rd.refresh_file_counts(old, fresh).groupBy("publication_date", "market_code").agg(F.sum("row_count").alias("row_count"))


def listing_audit(s, d):
    snaps = frame(s, d, "snapshots").withColumnRenamed("exchange", "exchange_raw")
    every = rd.snapshot_listing_observations(snaps, s.createDataFrame([], "listing_id string"))
    return u.audit_append(u.audit_append(None, u.observation_audit(every.where("exchange_raw = 'NYSE'"))), u.observation_audit(every))


def short_files(s, d):
    """One folder of each layout: 5 columns with header, 6 with either order, 6 without a header."""
    v = frame(s, d, "short_volume").groupBy("symbol", "trade_date").agg(*(F.sum(c).alias(c) for c in ("short_volume", "short_exempt_volume", "total_volume")))
    day, path = F.date_format("trade_date", "yyyyMMdd").alias("Date"), scratch(s, "short-volume")
    pick = lambda i: v.where(F.pmod(F.dayofyear("trade_date"), F.lit(4)) == i)
    short, exempt, total = F.col("short_volume").alias("ShortVolume"), F.col("short_exempt_volume").alias("ShortExemptVolume"), F.col("total_volume").alias("TotalVolume")
    for i, cols in enumerate([(short, total), (exempt, short, total), (short, exempt, total), (exempt, short, total)]):
        pick(i).select(day, F.col("symbol").alias("Symbol"), *cols, F.lit("q").alias("Market")).write.csv(f"{path}/20240{i + 1}15", header=i < 3, sep="|")
    return path


def short_volume(s, d):
    return rd.read_daily_short_volume(s, short_files(s, d), r"/(\d{8})/[^/]*$")


def short_interest(s, d):
    rows = frame(s, d, "short_interest").select(F.col("symbol").alias("Symbol Code"), F.col("settlement_date").alias("settlementDate"), F.col("short_interest").alias("Current Short Position Quantity"), F.col("avg_daily_volume").alias("Average Daily Volume Quantity"))
    path = scratch(s, "interest")
    rows.write.csv(f"{path}/fnsq20240131", header=True, sep="|")
    return rounded(rd.read_short_interest(s, path, "|", r"(\d{8})/[^/]*$").select("symbol", "settlement_date", "short_interest", "avg_daily_volume", "source_market", "source_date"))


def directory(s, d):
    c, path = frame(s, d, "candidates"), scratch(s, "directory")
    name = F.col("company_name").alias("Security Name")
    c.select(F.col("symbol").alias("Symbol"), name, F.when(F.col("s_suppkey") % 3 == 0, "Y").otherwise("N").alias("ETF")).union(s.sql("select 'File Creation Time: 0131', '', ''")).write.csv(f"{path}/n/20240131", header=True, sep="|")
    c.select(F.col("symbol").alias("ACT Symbol"), name, F.when(F.col("s_suppkey") % 2 == 0, "N").otherwise("Q").alias("Exchange"), F.lit("N").alias("ETF")).write.csv(f"{path}/o/20240131", header=True, sep="|")
    c.select("symbol", F.col("company_name"), F.col("s_suppkey").alias("cik")).write.csv(f"{path}/s/20240131", header=True)
    parts = [rd.read_symbol_directory(s, f"{path}/{k[0]}", k, r"(\d{8})/[^/]*$") for k in ("nasdaqlisted", "otherlisted", "sec")]
    return parts[0].union(parts[1]).union(parts[2])


#: Order keys that share the JSON documents of a cik; no line holds more filings or facts.
PAGE = 1 << 16


def paged(df):
    """`df` with the page of each row: a cik's filings and facts are split over documents, as older ones are in the feed."""
    return df.withColumn("page", F.floor(F.col("o_orderkey") / PAGE))


def submissions(s, d):
    rows = paged(frame(s, d, "filing_index")).withColumn("j", F.struct(F.col("accession_number"), F.col("form_type"), F.col("filing_date").cast("string").alias("d"), F.date_format("accepted_at", "yyyy-MM-dd'T'HH:mm:ss").alias("a")))
    rows = rows.groupBy("cik", "page").agg(F.sort_array(F.collect_list("j")).alias("l"))
    col = lambda name: F.transform("l", lambda x: F.coalesce(x[name], F.lit("")))
    recent = F.struct(col("accession_number").alias("accessionNumber"), col("form_type").alias("form"), col("d").alias("filingDate"), col("a").alias("acceptanceDateTime"), F.transform("l", lambda x: F.lit("doc.htm")).alias("primaryDocument"))
    path = scratch(s, "submissions")
    rows.select(F.to_json(F.struct("cik", F.concat(F.lit("Company "), "cik").alias("name"), F.struct(recent.alias("recent")).alias("filings"))).alias("value")).write.text(path)
    return rd.explode_submissions(s.read.text(path)).select("cik", "form_type", "filing_date", "accepted_at", "accession_number", "filing_url")


def company_facts(s, d):
    rows = paged(frame(s, d, "facts")).where("trim(concept) != ''").select("cik", "page", F.trim("concept").alias("concept"), F.struct(F.col("period_end_date").cast("string").alias("end"), F.col("value_numeric").cast("decimal(18,2)").cast("string").alias("val"), F.col("accession_number").alias("accn")).alias("f"))
    units = rows.groupBy("cik", "page", "concept").agg(F.collect_list("f").alias("fs")).select("cik", "page", "concept", F.struct(F.create_map(F.lit("USD"), F.col("fs")).alias("units")).alias("u"))
    concepts = units.groupBy("cik", "page").agg(F.map_from_entries(F.collect_list(F.struct("concept", "u"))).alias("c"))
    path = scratch(s, "facts")
    concepts.select(F.to_json(F.struct("cik", F.create_map(F.lit("us-gaap"), F.col("c")).alias("facts"))).alias("value")).write.text(path)
    return rounded(rd.explode_company_facts(s.read.text(path)).select("cik", "taxonomy", "concept", "unit", "accession_number", "period_end_date", "value_numeric"))


def daily_list(s, d):
    rows = frame(s, d, "articles").select(F.concat(F.when(F.col("raw_id") % 6 == 0, "new listing ").when(F.col("raw_id") % 6 == 1, "removed ").when(F.col("raw_id") % 6 == 2, "symbol change ").when(F.col("raw_id") % 6 == 3, "halted ").when(F.col("raw_id") % 6 == 4, "Name Change ").otherwise("nothing "), "symbol", F.lit(" on "), F.to_date("published_at").cast("string"), F.lit(" note "), F.col("raw_id").cast("string")).alias("value"))
    path = scratch(s, "lists")
    rows.write.text(path)
    return rd.parse_daily_list_events(s.read.text(path))


def overrides(s, d):
    rows = frame(s, d, "universe").select(F.lower("symbol").alias("Symbol"), F.when(F.col("include_in_universe"), " Yes").when(F.length("symbol") == 2, "maybe").otherwise("exclude").alias("include"), F.lit("r").alias("reason"))
    return rd.read_manual_overrides(s, written(s, rows, "overrides", True))


def listing_obs(s, d):
    snaps = frame(s, d, "snapshots").withColumnRenamed("exchange", "exchange_raw")
    first = rd.snapshot_listing_observations(snaps.where("exchange_raw = 'NYSE'"), s.createDataFrame([], "listing_id string"))
    return rd.snapshot_listing_observations(snaps, first)


def news_csv(s, d):
    path = written(s, frame(s, d, "articles").select("raw_id", "published_at", "source_name", "title", "url"), "news", True)
    return rd.read_news_source(s, path, "2024-01-05", "2024-01-10")


def index_csv(s, d):
    rows = frame(s, d, "filing_index").select(F.col("cik").alias("CIK"), F.lit("x").alias("Company Name"), F.col("form_type").alias("Form Type"), F.col("filing_date").alias("Date Filed"), F.col("accession_number").alias("Accession"))
    return rd.read_filing_index(s, written(s, rows, "index", True))


def replaced(s, d):
    path = scratch(s, "table")
    sk.replace_table(frame(s, d, "prices_base"), path)
    sk.replace_table(frame(s, d, "prices_preferred"), path)
    return s.read.parquet(path).select("symbol", "price_date", "close", "source_name")


def months(s, d):
    path = scratch(s, "months")
    base = effective(s, d).withColumn("month_start", F.trunc("price_date", "month"))
    sk.replace_months(base.select("symbol", "price_date", "volume", "month_start"), path)
    late = base.where("month_start >= date'2001-01-01'").select("symbol", "price_date", F.lit(-1).cast("long").alias("volume"), "month_start")
    sk.replace_months(late, path)
    return s.read.parquet(path).select("symbol", "price_date", "volume", F.col("month_start").cast("date").alias("month_start"))


def exported(s, d):
    path = scratch(s, "export")
    rows = sk.export_rows(effective(s, d).withColumn("label", F.when(F.col("volume") > 10, 1.0)), "price_date", "1999-01-01", "1999-12-31", None, ["label"])
    sk.export_csv(rows.select("symbol", "price_date", "close", "volume"), path)
    return s.read.csv(path, header=True, schema="symbol string, price_date date, close double, volume long")


def normalized_csv(s, d):
    path = scratch(s, "normalized")
    sk.export_normalized_prices(s, stooq(s, d), path, ["S3", "S4", "S5", "S6"])
    return rounded(s.read.csv(path, header=True, schema="symbol string, price_date date, open double, high double, low double, close double, volume long, source_name string, asset_class string, venue_group string"))


def counter(s, d):
    seen = frame(s, d, "articles").select("symbol", F.col("source_name").alias("reason"), F.col("published_at").alias("seen_at"))
    old = seen.where("seen_at < timestamp'2024-01-10 00:00:00'").groupBy("symbol", "reason").agg(F.count("*").alias("failure_count"), F.min("seen_at").alias("first_seen_at"), F.max("seen_at").alias("last_seen_at"))
    return sk.merge_counter(old, seen.where("seen_at >= timestamp'2024-01-28 00:00:00'"), ["symbol", "reason"])


def stream(s, d):
    """Event files upserted by event (K3) as they come: rows of the second run replace those of the first, and a file is handed over once although the stream runs twice."""
    src, out, mark = scratch(s, "stream-in"), scratch(s, "stream-out"), scratch(s, "stream-mark")
    events = table(s, d, "events").select("event_id", "user_id", "value")
    apply = lambda df, epoch: sk.upsert_batch(df, out, ["event_id"], stream="events", epoch=epoch)
    schema = "event_id long, user_id long, value double"
    events.where("event_id % 2 = 0").write.parquet(src)
    inc.new_files_stream(s, src, schema, mark, apply)
    events.where("event_id % 2 = 1 or event_id % 3 = 0").withColumn("value", F.lit(-1.0)).write.mode("append").parquet(src)
    inc.new_files_stream(s, src, schema, mark, apply)
    return s.read.parquet(out).groupBy("user_id").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("events"), F.count(F.when(F.col("value") == -1, 1)).alias("late"))


STATE = "select timestamp'2024-01-20 12:00:00' as watermark"
KEYS = ["symbol", "price_date"]
QUERIES = {
    "S1_read_stooq_bars": stooq_rows,
    "S2_read_normalized_price_csv": lambda s, d: rounded(rd.read_normalized_price_csv(s, prices_csv(s, d))),
    "S3_read_price_any": price_any,
    "S4_read_yahoo_jsonl": yahoo_rows,
    "S4_yahoo_manifest": yahoo_manifest,
    "S5_read_daily_short_volume": lambda s, d: rounded(short_volume(s, d).drop("source_file")),
    "S6_load_only_new_files": lambda s, d: (lambda x: rd.load_only_new_files(x, x.where("publication_date = date'2024-02-15'")).groupBy("publication_date").agg(F.count("*").alias("n")))(short_volume(s, d)),
    "S6_file_row_counts": file_counts,
    "S7_read_short_interest": short_interest,
    "S8_read_symbol_directory": directory,
    "S9_stage_symbol_snapshots": lambda s, d: (lambda x: rd.stage_symbol_snapshots(x.union(x), x.where("source_name = 'sec_tickers'")))(frame(s, d, "candidates").select(*rd.SNAPSHOT_KEY)),
    "S10_explode_submissions": submissions,
    "S11_explode_company_facts": company_facts,
    "S12_select_target_files": lambda s, d: rd.select_target_files(frame(s, d, "filing_index").select(F.concat(F.lit("CIK"), "cik", F.lit(".json")).alias("path"), "cik").distinct(), frame(s, d, "companies")),
    "S13_read_filing_index": lambda s, d: index_csv(s, d).select("cik", "form_type", "filing_date", "accession_number"),
    "S14_read_news_source": lambda s, d: news_csv(s, d).select("raw_id", "published_at", "title"),
    "S15_parse_daily_list_events": lambda s, d: daily_list(s, d).select("notes", "event_type", "symbol", "event_date", "confidence_level"),
    "S16_read_snapshot_listing_observations": listing_obs,
    "S16_observation_audit": listing_audit,
    "S17_read_manual_overrides": overrides,
    "K1_replace_table": replaced,
    "K2_append_dedup": lambda s, d: (lambda x: x.select(*KEYS).union(sk.append_dedup(x, frame(s, d, "prices_loaded"), KEYS).select(*KEYS)))(frame(s, d, "prices_loaded").where("volume > 20")),
    "K3_upsert_by_key": lambda s, d: rounded(sk.upsert_by_key(effective(s, d), frame(s, d, "prices_preferred").where("volume > 20").withColumn("close", F.lit(1.0)), KEYS).select(*KEYS, "close")),
    "K4_replace_window": lambda s, d: rounded(sk.replace_window(effective(s, d), effective(s, d).withColumn("close", F.lit(2.0)), "price_date", "2000-06-01").select(*KEYS, "close")),
    "K5_replace_months": months,
    "K6_export_csv": exported,
    "K7_merge_counter": counter,
    "K8_export_normalized_price_csv": normalized_csv,
    "W1_incremental_watermark": lambda s, d: (lambda x, st: inc.incremental_rows(x, st, "published_at", 2).crossJoin(inc.advance_watermark(x, st, "published_at")).select("raw_id", "watermark"))(frame(s, d, "articles"), s.sql(STATE)),
    "W2_new_files_stream": stream,
}
_ST = """st AS (SELECT upper(concat('s', CAST(l_suppkey AS VARCHAR))) AS symbol, CAST(l_shipdate AS DATE) AS price_date, max(l_extendedprice) AS open, max(l_extendedprice) AS high, min(l_extendedprice) AS low, min(l_extendedprice) AS close, CAST(sum(l_quantity) AS BIGINT) AS volume,
  CASE l_suppkey % 3 WHEN 0 THEN 'STOCK' WHEN 1 THEN 'ETF' ELSE 'UNKNOWN' END AS asset_class, CASE l_suppkey % 3 WHEN 0 THEN 'NASDAQ STOCKS' WHEN 1 THEN 'NYSE ETFS' ELSE 'UNKNOWN' END AS venue_group FROM lineitem WHERE l_linenumber <> 7 GROUP BY l_suppkey, CAST(l_shipdate AS DATE))"""
_SV = "sv AS (SELECT symbol, trade_date, sum(short_volume) AS a, sum(short_exempt_volume) AS b, sum(total_volume) AS t, dayofyear(trade_date) % 4 AS g FROM short_volume GROUP BY symbol, trade_date)"
_DIRTYPE = "CASE WHEN contains(' ' || upper(company_name) || ' ', ' ETF') THEN 'ETF' WHEN contains(' ' || upper(company_name) || ' ', ' ADR') THEN 'ADR' WHEN contains(upper(company_name), 'PREFERRED') THEN 'PREFERRED' WHEN contains(upper(company_name), 'WARRANT') THEN 'WARRANT' WHEN contains(' ' || upper(company_name), ' RIGHT') THEN 'RIGHT' WHEN contains(' ' || upper(company_name), ' UNIT') THEN 'UNIT' ELSE 'COMMON_STOCK' END"
ORACLES = {
    "S1_read_stooq_bars": f"WITH {_ST} SELECT symbol, price_date, {r('open', 'high', 'low', 'close')}, volume, asset_class, venue_group FROM st",
    "S2_read_normalized_price_csv": f"{ctes('prices_loaded')} SELECT symbol, price_date, {r('open', 'high', 'low', 'close')}, volume, source_name FROM prices_loaded",
    "S3_read_price_any": "SELECT concat('S', CAST(l_suppkey AS VARCHAR)) AS symbol, CAST(l_shipdate AS DATE) AS price_date, l_extendedprice AS open, round(l_extendedprice + l_quantity - 5, 6) + 0.0 AS high, l_extendedprice AS low, l_extendedprice AS close, CASE WHEN l_linenumber > 1 THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS volume FROM lineitem WHERE l_linenumber <> 3 AND l_quantity >= 5",
    "S4_read_yahoo_jsonl": f"{ctes('prices_loaded')} SELECT symbol, price_date, round(close, 9) + 0.0 AS close, volume, 'r1' AS run_id, concat(CAST(year(price_date) AS VARCHAR), '-12-31') AS run_date FROM prices_loaded WHERE volume <= 30",
    "S4_yahoo_manifest": f"{ctes('prices_loaded')} SELECT 'r1' AS run_id, concat(CAST(year(price_date) AS VARCHAR), '-12-31') AS run_date, count(*) AS rows_loaded FROM prices_loaded GROUP BY 2",
    "S5_read_daily_short_volume": f"{ctes('short_volume')}, {_SV} SELECT trade_date, symbol, a AS short_volume, CASE WHEN g > 0 THEN b END AS short_exempt_volume, t AS total_volume, 'Q' AS market_code, CASE g WHEN 0 THEN DATE '2024-01-15' WHEN 1 THEN DATE '2024-02-15' WHEN 2 THEN DATE '2024-03-15' ELSE DATE '2024-04-15' END AS publication_date FROM sv",
    "S6_load_only_new_files": f"{ctes('short_volume')}, {_SV} SELECT CASE g WHEN 0 THEN DATE '2024-01-15' WHEN 2 THEN DATE '2024-03-15' ELSE DATE '2024-04-15' END AS publication_date, count(*) AS n FROM sv WHERE g <> 1 GROUP BY 1",
    "S6_file_row_counts": f"{ctes('short_volume')}, {_SV} SELECT CASE g WHEN 0 THEN DATE '2024-01-15' WHEN 1 THEN DATE '2024-02-15' WHEN 2 THEN DATE '2024-03-15' ELSE DATE '2024-04-15' END AS publication_date, 'Q' AS market_code, count(*) * CASE WHEN g = 1 THEN -1 ELSE 1 END AS row_count FROM sv GROUP BY g",
    "S7_read_short_interest": f"{ctes('short_interest')} SELECT symbol, settlement_date, CAST(short_interest AS DOUBLE) AS short_interest, avg_daily_volume, 'regular' AS source_market, DATE '2024-01-31' AS source_date FROM short_interest",
    "S8_read_symbol_directory": f"{ctes('candidates')}, x AS (SELECT *, upper(trim(symbol)) AS sy FROM candidates) SELECT sy AS symbol, company_name, CAST(NULL AS VARCHAR) AS cik, 'NASDAQ' AS exchange_raw, CASE WHEN s_suppkey % 3 = 0 THEN 'ETF' ELSE {_DIRTYPE} END AS security_type_raw, 'nasdaqlisted' AS source_name, DATE '2024-01-31' AS as_of_date FROM x UNION ALL SELECT sy, company_name, NULL, CASE WHEN s_suppkey % 2 = 0 THEN 'NYSE' ELSE 'Q' END, {_DIRTYPE}, 'otherlisted', DATE '2024-01-31' FROM x UNION ALL SELECT sy, company_name, lpad(CAST(s_suppkey AS VARCHAR), 10, '0'), NULL, NULL, 'sec', DATE '2024-01-31' FROM x",
    "S9_stage_symbol_snapshots": f"{ctes('candidates')} SELECT DISTINCT {', '.join(rd.SNAPSHOT_KEY)} FROM candidates WHERE source_name <> 'sec_tickers'",
    "S10_explode_submissions": f"{ctes('filing_index')} SELECT lpad(cik, 10, '0') AS cik, form_type, filing_date, accepted_at, accession_number, concat('https://www.sec.gov/Archives/edgar/data/', cik, '/', replace(accession_number, '-', ''), '/doc.htm') AS filing_url FROM filing_index",
    "S11_explode_company_facts": f"{ctes('facts')} SELECT lpad(cik, 10, '0') AS cik, 'us-gaap' AS taxonomy, trim(concept) AS concept, 'USD' AS unit, accession_number, period_end_date, round(value_numeric, 6) + 0.0 AS value_numeric FROM facts WHERE trim(concept) <> ''",
    "S12_select_target_files": f"{ctes('filing_index', 'companies')} SELECT DISTINCT concat('CIK', cik, '.json') AS path, lpad(cik, 10, '0') AS cik, lpad(cik, 10, '0') IN (SELECT cik FROM companies) AS selected FROM filing_index",
    "S13_read_filing_index": f"{ctes('filing_index')} SELECT lpad(cik, 10, '0') AS cik, form_type, filing_date, accession_number FROM filing_index",
    "S14_read_news_source": f"{ctes('articles')} SELECT raw_id, date_trunc('millisecond', published_at) AS published_at, title FROM articles WHERE CAST(published_at AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-10'",
    "S15_parse_daily_list_events": f"{ctes('articles')} SELECT concat(CASE raw_id % 6 WHEN 0 THEN 'new listing ' WHEN 1 THEN 'removed ' WHEN 2 THEN 'symbol change ' WHEN 3 THEN 'halted ' ELSE 'Name Change ' END, symbol, ' on ', CAST(CAST(published_at AS DATE) AS VARCHAR), ' note ', CAST(raw_id AS VARCHAR)) AS notes, CASE raw_id % 6 WHEN 0 THEN 'LISTING_ADDED' WHEN 1 THEN 'LISTING_REMOVED' WHEN 2 THEN 'TICKER_CHANGED' WHEN 3 THEN 'SUSPENDED' ELSE 'RENAMED' END AS event_type, symbol, CAST(published_at AS DATE) AS event_date, 'LOW' AS confidence_level FROM articles WHERE raw_id % 6 <> 5",
    "S16_read_snapshot_listing_observations": f"{ctes('snapshots')} SELECT 'LST:' || md5(symbol || '|' || exchange || '|' || CAST(as_of_date AS VARCHAR)) AS listing_id, symbol, exchange AS exchange_raw, as_of_date AS effective_from, as_of_date AS effective_to FROM snapshots WHERE exchange <> 'NYSE'",
    "S16_observation_audit": f"{ctes('snapshots')}, x AS (SELECT *, 'LST:' || md5(symbol || '|' || exchange || '|' || CAST(as_of_date AS VARCHAR)) AS listing_id FROM snapshots) SELECT 'AUDIT:' || md5(listing_id || '|' || symbol || '|' || exchange || '|' || CAST(as_of_date AS VARCHAR)) AS audit_id, 'market_universe_history' AS entity_type, listing_id AS entity_key, 'INSERT' AS action_type, 'nasdaq_symbol_directory_snapshot' AS source_name, 'DIRECT_SOURCE_FILE' AS evidence_type, 'HIGH' AS confidence_level, CAST(NULL AS VARCHAR) AS old_value, symbol AS new_value FROM x",
    "S17_read_manual_overrides": f"{ctes('universe')} SELECT symbol, include_in_universe AS include, 'r' AS reason FROM universe WHERE include_in_universe OR length(symbol) <> 2",
    "K1_replace_table": f"{ctes('prices_preferred')} SELECT symbol, price_date, close, source_name FROM prices_preferred",
    "K2_append_dedup": f"{ctes('prices_loaded')} SELECT symbol, price_date FROM prices_loaded",
    "K3_upsert_by_key": f"{EFFECTIVE} SELECT e.symbol, e.price_date, CASE WHEN p.symbol IS NULL THEN round(e.close, 9) + 0.0 ELSE 1.0::DOUBLE END AS close FROM eff e LEFT JOIN (SELECT * FROM prices_preferred WHERE volume > 20) p ON p.symbol = e.symbol AND p.price_date = e.price_date",
    "K4_replace_window": f"{EFFECTIVE} SELECT symbol, price_date, CASE WHEN price_date < DATE '2000-06-01' THEN round(close, 9) + 0.0 ELSE 2.0::DOUBLE END AS close FROM eff",
    "K5_replace_months": f"{EFFECTIVE} SELECT symbol, price_date, CASE WHEN price_date >= DATE '2001-01-01' THEN -1 ELSE volume END AS volume, CAST(date_trunc('month', price_date) AS DATE) AS month_start FROM eff",
    "K6_export_csv": f"{EFFECTIVE} SELECT symbol, price_date, close, volume FROM eff WHERE volume > 10 AND price_date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31'",
    "K7_merge_counter": f"{ctes('articles')} SELECT symbol, source_name AS reason, count(*) AS failure_count, min(published_at) AS first_seen_at, max(published_at) AS last_seen_at FROM articles WHERE published_at < TIMESTAMP '2024-01-10 00:00:00' OR published_at >= TIMESTAMP '2024-01-28 00:00:00' GROUP BY symbol, source_name",
    "K8_export_normalized_price_csv": f"WITH {_ST} SELECT symbol, price_date, {r('open', 'high', 'low', 'close')}, volume, 'stooq' AS source_name, asset_class, venue_group FROM st WHERE asset_class <> 'ETF' AND symbol IN ('S3', 'S4', 'S5', 'S6')",
    "W1_incremental_watermark": f"{ctes('articles')} SELECT raw_id, (SELECT max(published_at) FROM articles) AS watermark FROM articles WHERE published_at > TIMESTAMP '2024-01-18 12:00:00'",
    "W2_new_files_stream": "SELECT user_id, count(DISTINCT event_id) AS n, count(DISTINCT event_id) AS events, count(DISTINCT CASE WHEN event_id % 2 = 1 OR event_id % 3 = 0 OR value = -1 THEN event_id END) AS late FROM events GROUP BY user_id",
}
