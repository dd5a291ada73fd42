"""Queries of filings, fundamentals and news."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as f
from ..operators import filings as e
from ..operators import joins as j
from ..operators import news as n
from ..operators import shorts as h
from .features import BASE, RSI, over, places, rounded
from .inputs import ctes, frame
from .market import SHORTS

NOW = "2030-01-01 00:00:00"


def r(*columns: str) -> str:
    return ", ".join(f"round({x}, {places(x)}) + 0.0 AS {x}" for x in columns)


def filings(s, d):
    return e.sec_filings(frame(s, d, "filing_index"), frame(s, d, "companies"), NOW)


def facts(s, d):
    return e.sec_fact_normalized(frame(s, d, "facts"), frame(s, d, "companies"), filings(s, d))


def base(s, d):
    return e.fundamental_base(facts(s, d))


def ttm(s, d):
    return e.fundamental_ttm(base(s, d))


def candidates(s, d):
    aliases = F.transform(F.array_sort(F.collect_list(F.struct("ord", "phrase"))), lambda a: a["phrase"])
    refs = frame(s, d, "references").groupBy("symbol", "symbol_match_enabled", "name_match_enabled").agg(aliases.alias("aliases"))
    return n.news_candidates(frame(s, d, "articles"), refs)


def aliases(s, d):
    listed = F.transform(F.array_sort(F.collect_list(F.struct("ord", "phrase"))), lambda a: a["phrase"])
    return frame(s, d, "aliases").groupBy("symbol").agg(listed.alias("aliases"))


def links(s, d):
    return n.news_links(n.news_identity(frame(s, d, "articles").drop("symbol")), candidates(s, d), frame(s, d, "instruments"))


def windows(s, d):
    return n.news_event_windows(links(s, d), frame(s, d, "days"))


def daily(s, d):
    return n.news_daily_by_class(n.news_identity(frame(s, d, "articles")), aliases(s, d), frame(s, d, "instruments"), frame(s, d, "days"))


def research_pit(s, d):
    technical = f.technical_features(frame(s, d, "bars"), frame(s, d, "instruments"), frame(s, d, "universe").where("include_in_universe"))
    funds = frame(s, d, "fundamentals").select("company_id", "effective_as_of_date", "available_at", "period_end_date", "filing", "revenue")
    out = j.asof(technical, funds, ["company_id"], "as_of_date", "effective_as_of_date", ["available_at", "period_end_date", "filing"])
    shorts = h.short_rolling(h.short_daily(frame(s, d, "short_volume"))).select("symbol", "as_of_date", "short_volume_ratio")
    news = n.news_features_daily(windows(s, d)).select("instrument_id", F.col("effective_date").alias("as_of_date"), "article_count")
    return out.join(shorts, ["symbol", "as_of_date"], "left").join(news, ["instrument_id", "as_of_date"], "left").select("symbol", "as_of_date", "close_to_sma_20", "rsi_14", "filing", "revenue", "short_volume_ratio", "article_count")


def statements(s, d):
    wide = frame(s, d, "fundamentals").select("company_id", "period_end_date", F.col("assets").alias("Total Assets"), F.col("revenue").alias("Total Revenue"), F.col("equity").alias("Equity"))
    return e.statement_mapping(wide, {"assets": ["Assets", "Total Assets", "Equity"], "revenue": ["Total Revenue"], "net_income": ["Net Income"]})


def symbols(s, d):
    return frame(s, d, "candidates").select("symbol", "cik", (F.col("s_acctbal") > 1000).alias("include_in_universe"))


MEASURES = list(e.CONCEPTS)
QUERIES = {
    "E1_sec_filings": lambda s, d: filings(s, d).select("filing_id", "cik", "accession_number", "company_id", "available_at"),
    "E2_cik_company_map": lambda s, d: e.cik_company_map(frame(s, d, "companies").where("company_id != 'CO:3'"), frame(s, d, "companies")),
    "E3_best_filing_per_accession": lambda s, d: e.best_filing_per_accession(filings(s, d)).groupBy("accession_number").agg(F.max("available_at").alias("available_at"), F.count("*").alias("n")),
    "E4_sec_fact_dedup": lambda s, d: rounded(e.sec_fact_dedup(frame(s, d, "facts")).groupBy("cik", "concept", "period_end_date").agg(F.count("*").alias("n"), F.max("ingested_at").alias("ingested_at"))),
    "E5_sec_fact_normalized": lambda s, d: facts(s, d).groupBy("company_id", "cik", "concept").agg(F.count("*").alias("n"), F.max("available_at").alias("available_at")),
    "E6_impacted_months": lambda s, d: e.impacted_months(frame(s, d, "facts"), s.sql("select timestamp'2001-03-15 00:00:00' as watermark"), "ingested_at", "period_end_date", 3),
    "A4_pivot_concepts": lambda s, d: rounded(e.pivot_concepts(facts(s, d).where("concept != 'other'")).groupBy("company_id").agg(*(F.max(m).alias(m) for m in MEASURES))),
    "E7_fundamental_base": lambda s, d: rounded(base(s, d).select("company_id", "period_end_date", *MEASURES)),
    "E8_fundamental_ttm": lambda s, d: rounded(ttm(s, d).select("company_id", "period_end_date", "revenue", "net_income")),
    "A5_ttm_sum": lambda s, d: rounded(ttm(s, d).select("company_id", "period_end_date", "revenue", "assets", "equity")),
    "E9_missing_fundamentals": lambda s, d: e.missing_fundamentals(symbols(s, d), frame(s, d, "companies")),
    "E10_statement_mapping": lambda s, d: rounded(statements(s, d)),
    "E11_latest_filing_asof": lambda s, d: e.latest_filing_asof(frame(s, d, "requests"), filings(s, d).where("company_id is not null")).select("o_orderkey", "company_id", "form_type", "as_of", "available_at"),
    "E12_fundamental_ratios": lambda s, d: rounded(e.fundamental_ratios(base(s, d)).select("company_id", "period_end_date", "net_margin", "debt_to_equity", "return_on_assets")),
    "N1_news_candidates": lambda s, d: n.news_candidates(frame(s, d, "articles"), aliases(s, d)),
    "N2_news_identity": lambda s, d: n.news_identity(frame(s, d, "articles")).select("raw_id", "article_id", "cluster_id"),
    "N3_news_links": lambda s, d: rounded(links(s, d).groupBy("instrument_id").agg(F.count("*").alias("n"), F.sum("match_score").alias("total"))),
    "N4_news_effective_date": lambda s, d: daily(s, d).groupBy("effective_date").agg(F.sum("article_count").alias("n")),
    "N5_news_event_windows": lambda s, d: daily(s, d).groupBy("effective_date", "window_end").agg(F.sum("article_count").alias("n")),
    "N6_news_features_daily": lambda s, d: rounded(daily(s, d).where("effective_date is not null").drop("window_end")),
    "A6_news_daily": lambda s, d: rounded(daily(s, d).where("effective_date is not null").groupBy("effective_date").agg(F.sum("article_count").alias("articles"), F.max("cluster_count").alias("clusters"))),
    "N7_news_enrichment_placeholder": lambda s, d: n.news_enrichment_placeholder(n.news_identity(frame(s, d, "articles"))),
    "N8_news_links_calendar_day": lambda s, d: n.news_links_calendar_day(links(s, d)),
    "F25_research_features_pit": lambda s, d: rounded(research_pit(s, d)),
}
FACTS = ctes("filing_index", "companies", "facts") + f""",
f0 AS (SELECT lpad(x.cik, 10, '0') AS cik, accession_number, form_type, filing_date, accepted_at, coalesce(accepted_at, TIMESTAMP '{NOW}') AS available_at, c.company_id, o_orderkey, 'FILING:' || substr(sha1(lpad(x.cik, 10, '0') || '|' || accession_number), 1, 20) AS filing_id FROM filing_index x LEFT JOIN companies c ON c.cik = lpad(x.cik, 10, '0')),
fil AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY filing_id ORDER BY available_at DESC, cik, accession_number, form_type, filing_date NULLS LAST, accepted_at NULLS LAST, o_orderkey) AS k FROM f0) q WHERE k = 1),
bf AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY accession_number ORDER BY available_at DESC NULLS LAST, accepted_at DESC NULLS LAST, filing_date DESC NULLS LAST, cik, form_type) AS k2 FROM fil) q WHERE k2 = 1),
d0 AS (SELECT accession_number, lpad(cik, 10, '0') AS cik, nullif(lower(trim(concept)), '') AS concept, period_end_date, value_numeric, ingested_at, o_orderkey FROM facts),
dd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY accession_number, cik, concept, period_end_date ORDER BY ingested_at DESC NULLS LAST, value_numeric, o_orderkey) AS k FROM d0 WHERE concept IS NOT NULL) q WHERE k = 1),
fn AS (SELECT dd.*, coalesce(c.company_id, bf.company_id, 'CIK:' || dd.cik) AS company_id, coalesce(bf.available_at, dd.ingested_at) AS available_at FROM dd LEFT JOIN companies c ON c.cik = dd.cik LEFT JOIN bf ON bf.accession_number = dd.accession_number),
pv AS (SELECT company_id, cik, period_end_date, available_at, max(CASE WHEN concept = 'revenues' THEN value_numeric END) AS revenue, max(CASE WHEN concept IN ('netincomeloss', 'profitloss') THEN value_numeric END) AS net_income, max(CASE WHEN concept = 'assets' THEN value_numeric END) AS assets,
  max(CASE WHEN concept = 'liabilities' THEN value_numeric END) AS liabilities, max(CASE WHEN concept = 'stockholdersequity' THEN value_numeric END) AS equity, max(CASE WHEN concept = 'netcashprovidedbyusedinoperatingactivities' THEN value_numeric END) AS operating_cash_flow,
  max(CASE WHEN concept = 'entitycommonstocksharesoutstanding' THEN value_numeric END) AS shares_outstanding FROM fn WHERE concept <> 'other' GROUP BY company_id, cik, period_end_date, available_at),
bs AS (SELECT * FROM (SELECT company_id, cik, period_end_date, available_at, revenue, net_income, assets, coalesce(liabilities, assets - equity) AS liabilities, equity, operating_cash_flow, shares_outstanding, row_number() OVER (PARTITION BY company_id, period_end_date ORDER BY available_at DESC NULLS LAST, cik) AS k FROM pv) q WHERE k = 1),
tt AS (SELECT a.company_id, a.cik, a.period_end_date, a.available_at, sum(b.revenue) AS revenue, sum(b.net_income) AS net_income, max_by(coalesce(b.assets, -1), b.period_end_date) AS assets, max_by(coalesce(b.equity, -1), b.period_end_date) AS equity FROM bs a JOIN bs b ON a.company_id = b.company_id AND b.available_at <= a.available_at AND b.period_end_date <= a.period_end_date AND b.period_end_date > a.period_end_date - INTERVAL '370' DAY GROUP BY a.company_id, a.cik, a.period_end_date, a.available_at)"""
NEWS = ctes("articles", "references", "instruments", "days").replace("references AS", "refs AS", 1) + """,
ti AS (SELECT *, ' ' || trim(regexp_replace(upper(title), '[^A-Z0-9]+', ' ', 'g')) || ' ' AS t FROM articles), ph AS (SELECT DISTINCT symbol, symbol AS p, 'symbol' AS match_type, 1.0::DOUBLE AS match_score, -1 AS ord FROM refs WHERE symbol_match_enabled UNION ALL SELECT symbol, upper(phrase), 'alias', CASE WHEN length(phrase) >= 8 THEN 0.9::DOUBLE ELSE 0.75::DOUBLE END, ord FROM refs WHERE name_match_enabled AND length(phrase) >= 4),
ca AS (SELECT raw_id, symbol, match_type, match_score, p AS matched_text FROM (SELECT ti.raw_id, ph.*, row_number() OVER (PARTITION BY ti.raw_id, ph.symbol ORDER BY match_score DESC, ord) AS k FROM ti JOIN ph ON contains(ti.t, ' ' || ph.p || ' ')) q WHERE k = 1),
id AS (SELECT raw_id, published_at, 'NEWS:' || substr(sha1(source_name || '|' || url || '|' || lower(trim(title))), 1, 20) AS article_id, 'CLUSTER:' || substr(sha1(regexp_replace(lower(trim(title)), '[^a-z0-9]+', ' ', 'g')), 1, 16) AS cluster_id FROM articles),
li AS (SELECT id.*, ca.symbol, ca.match_score, i.instrument_id, CASE WHEN CAST(published_at AS TIME) < TIME '09:30:00' THEN CAST(published_at AS DATE) ELSE CAST(CAST(published_at AS DATE) + INTERVAL '1' DAY AS DATE) END AS d0 FROM id JOIN ca ON ca.raw_id = id.raw_id JOIN instruments i ON i.symbol = ca.symbol),
ef AS (SELECT d, (SELECT min(bar_date) FROM days WHERE bar_date >= q.d) AS effective_date FROM (SELECT DISTINCT d0 AS d FROM li) q), nx AS (SELECT bar_date, lead(bar_date) OVER (ORDER BY bar_date) AS window_end FROM days),
wi AS (SELECT li.*, ef.effective_date, nx.window_end FROM li LEFT JOIN ef ON ef.d = li.d0 LEFT JOIN nx ON nx.bar_date = ef.effective_date)"""
# every symbol and every alias may match, the aliases that many symbols share included
WHOLE_NEWS = NEWS.replace(ctes("references").removeprefix("WITH references AS"), ctes("aliases").removeprefix("WITH aliases AS"), 1).replace(" WHERE symbol_match_enabled", "", 1).replace(" WHERE name_match_enabled AND", " WHERE", 1)
_REQ = ctes("requests").removeprefix("WITH ")
ORACLES = {
    "E1_sec_filings": f"{FACTS} SELECT filing_id, cik, accession_number, company_id, available_at FROM fil",
    "E2_cik_company_map": f"{ctes('companies')} SELECT * FROM companies",
    "E3_best_filing_per_accession": f"{FACTS} SELECT accession_number, available_at, 1 AS n FROM bf",
    "E4_sec_fact_dedup": f"{FACTS} SELECT cik, concept, period_end_date, count(*) AS n, max(ingested_at) AS ingested_at FROM dd GROUP BY cik, concept, period_end_date",
    "E5_sec_fact_normalized": f"{FACTS} SELECT company_id, cik, concept, count(*) AS n, max(available_at) AS available_at FROM fn GROUP BY company_id, cik, concept",
    "E6_impacted_months": f"{ctes('facts')} SELECT DISTINCT period_end_date AS month_start FROM facts WHERE ingested_at > TIMESTAMP '2001-03-15 00:00:00' OR period_end_date >= (SELECT max(period_end_date) - INTERVAL '2' MONTH FROM facts)",
    "A4_pivot_concepts": f"{FACTS} SELECT company_id, {', '.join(f'round(max({m}), 6) + 0.0 AS {m}' for m in MEASURES)} FROM pv GROUP BY company_id",
    "E7_fundamental_base": f"{FACTS} SELECT company_id, period_end_date, {r(*MEASURES)} FROM bs",
    "E8_fundamental_ttm": f"{FACTS} SELECT company_id, period_end_date, {r('revenue', 'net_income')} FROM tt",
    "A5_ttm_sum": f"{FACTS} SELECT company_id, period_end_date, {r('revenue')}, round(nullif(assets, -1), 6) + 0.0 AS assets, round(nullif(equity, -1), 6) + 0.0 AS equity FROM tt",
    "E9_missing_fundamentals": f"{ctes('candidates', 'companies')}, x AS (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY s_acctbal > 1000 DESC, CASE WHEN regexp_matches(symbol, '[^A-Z0-9]') THEN 1 ELSE 0 END, length(symbol), symbol) AS k FROM candidates WHERE cik IS NOT NULL AND cik NOT IN (SELECT cik FROM companies)) SELECT cik, symbol FROM x WHERE k = 1",
    "E10_statement_mapping": f"{ctes('fundamentals')} SELECT company_id, period_end_date, round(coalesce(assets, equity), 6) + 0.0 AS assets, round(revenue, 6) + 0.0 AS revenue, CAST(NULL AS DOUBLE) AS net_income FROM fundamentals",
    "E11_latest_filing_asof": f"{FACTS}, {_REQ} SELECT o_orderkey, company_id, form_type, as_of, (SELECT max(available_at) FROM fil WHERE fil.company_id = requests.company_id AND fil.form_type = requests.form_type AND fil.available_at <= requests.as_of) AS available_at FROM requests",
    "E12_fundamental_ratios": f"{FACTS} SELECT company_id, period_end_date, round(net_income / nullif(revenue, 0), 6) + 0.0 AS net_margin, round(liabilities / nullif(equity, 0), 6) + 0.0 AS debt_to_equity, round(net_income / nullif(assets, 0), 6) + 0.0 AS return_on_assets FROM bs",
    "N1_news_candidates": f"{WHOLE_NEWS} SELECT * FROM ca",
    "N2_news_identity": f"{NEWS} SELECT raw_id, article_id, cluster_id FROM id",
    "N3_news_links": f"{NEWS} SELECT instrument_id, count(*) AS n, round(sum(match_score), 6) + 0.0 AS total FROM li GROUP BY instrument_id",
    "N4_news_effective_date": f"{WHOLE_NEWS} SELECT effective_date, count(*) AS n FROM wi GROUP BY effective_date",
    "N5_news_event_windows": f"{WHOLE_NEWS} SELECT effective_date, window_end, count(*) AS n FROM wi GROUP BY effective_date, window_end",
    "N6_news_features_daily": f"{WHOLE_NEWS} SELECT instrument_id, effective_date, count(*) AS article_count, count(DISTINCT cluster_id) AS cluster_count, round(avg(match_score), 6) + 0.0 AS avg_confidence FROM wi WHERE effective_date IS NOT NULL GROUP BY instrument_id, effective_date",
    "A6_news_daily": f"{WHOLE_NEWS}, x AS (SELECT instrument_id, effective_date, count(*) AS a, count(DISTINCT cluster_id) AS c FROM wi WHERE effective_date IS NOT NULL GROUP BY instrument_id, effective_date) SELECT effective_date, CAST(sum(a) AS BIGINT) AS articles, max(c) AS clusters FROM x GROUP BY effective_date",
    "N7_news_enrichment_placeholder": f"{NEWS} SELECT article_id, 'neutral' AS sentiment_label, 0.0::DOUBLE AS sentiment_score, 'none' AS model_name FROM id",
    "N8_news_links_calendar_day": f"{NEWS} SELECT instrument_id, CAST(published_at AS DATE) AS event_date, CAST(CAST(published_at AS DATE) + INTERVAL '1' DAY AS DATE) AS window_end, count(DISTINCT article_id) AS article_count, count(DISTINCT cluster_id) AS cluster_count FROM li GROUP BY ALL",
    "F25_research_features_pit": NEWS.replace("WITH ", ctes("bars", "universe", "fundamentals", "short_volume") + ", ", 1) + f""",
      {BASE.replace('FROM bars b', 'FROM (SELECT * FROM bars WHERE symbol IN (SELECT symbol FROM universe WHERE include_in_universe)) b')},
      mv AS (SELECT *, greatest(coalesce(adj_close - prev, 0), 0) AS gain, greatest(coalesce(prev - adj_close, 0), 0) AS loss FROM base), st AS (SELECT *, avg(adj_close) {over(20)} AS a, avg(gain) {over(14)} AS g, avg(loss) {over(14)} AS l FROM mv),
      te AS (SELECT *, adj_close / nullif(a, 0) - 1 AS close_to_sma_20, {RSI.format(g='g', l='l')} AS rsi_14 FROM st),
      fu AS (SELECT * FROM (SELECT te.symbol, te.as_of_date, u.filing, u.revenue, row_number() OVER (PARTITION BY te.symbol, te.as_of_date ORDER BY u.effective_as_of_date DESC, u.available_at DESC, u.period_end_date DESC, u.filing DESC) AS k FROM te JOIN fundamentals u ON u.company_id = te.company_id AND u.effective_as_of_date <= te.as_of_date) q WHERE k = 1),
      sv AS (SELECT symbol, trade_date, sum(short_volume) / nullif(sum(total_volume), 0) AS short_volume_ratio FROM short_volume GROUP BY symbol, trade_date), nw AS (SELECT instrument_id, effective_date, count(*) AS article_count FROM wi WHERE effective_date IS NOT NULL GROUP BY instrument_id, effective_date)
      SELECT te.symbol, te.as_of_date, {r('close_to_sma_20', 'rsi_14')}, fu.filing, round(fu.revenue, 6) + 0.0 AS revenue, round(sv.short_volume_ratio, 9) + 0.0 AS short_volume_ratio, nw.article_count
      FROM te LEFT JOIN fu ON fu.symbol = te.symbol AND fu.as_of_date = te.as_of_date LEFT JOIN sv ON sv.symbol = te.symbol AND sv.trade_date = te.as_of_date LEFT JOIN nw ON nw.instrument_id = te.instrument_id AND nw.effective_date = te.as_of_date""",
}
