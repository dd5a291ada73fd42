"""Queries of cleaning rules, shorts, canonical prices and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.shared import stored
from ..operators import aggregates as a
from ..operators import clean as c
from ..operators import features as f
from ..operators import labels as l
from ..operators import prices as p
from ..operators import shorts as h
from .features import BASE, VOLATILITY, places, rounded
from .inputs import ctes, frame


def r(*columns: str) -> str:
    return ", ".join(f"round({x}, {places(x)}) + 0.0 AS {x}" for x in columns)


def one(make, *names):
    """Query that applies `make` to inputs."""
    return lambda s, d: rounded(make(*(frame(s, d, n) for n in names)))


def classified(candidates):
    out = candidates.withColumns(c.classify_security(F.col("company_name"), F.col("security_type_raw"))).withColumn("exchange_normalized", c.normalize_exchange(F.col("exchange_raw")))
    return out.withColumn("exclusion_reason", c.inclusion_reason(F.col("exchange_normalized")))


def effective(s, d):
    return p.effective_prices(frame(s, d, "prices_base"), frame(s, d, "prices_preferred"))


def on_effective(make, *names):
    return lambda s, d: rounded(make(effective(s, d), *(frame(s, d, n) for n in names)))


def vols(s, d):
    v = f.volatility(frame(s, d, "bars"), frame(s, d, "instruments"))
    return v.join(frame(s, d, "bars").select("symbol", F.col("bar_date").alias("as_of_date"), "volume"), ["symbol", "as_of_date"])


def failures(s, d):
    return frame(s, d, "articles").groupBy("symbol").agg(F.count("*").alias("failure_count"), F.max("published_at").alias("last_seen_at"), F.max(F.when(F.col("source_name") == "error", "No Data found").otherwise("timeout")).alias("reason"))


def short_all(s, d):
    return h.short_features(h.short_rolling(h.short_daily(frame(s, d, "short_volume"))), h.short_interest_history(frame(s, d, "short_interest")))


def late_refreshed(s, d):
    """Features of the days and settlements that were there first, refreshed for those that came late."""
    daily, history = stored(h.short_daily(frame(s, d, "short_volume")), "daily"), stored(h.short_interest_history(frame(s, d, "short_interest")), "history")
    day, fact = F.col("as_of_date").between("1998-07-01", "1998-07-10"), F.col("settlement_date") == F.lit("2000-05-01").cast("date")
    old = h.short_features(h.short_rolling(daily.where(~day)), history.where(~fact))
    return h.refresh_late(old, daily, history, daily.where(day), history.where(fact), whole=True)[0]


def corrections(s):
    return s.range(1).select(F.explode(F.create_map(F.lit("RED/B"), F.lit("RED.B"), F.lit("BIG/B"), F.lit("BIG.B"))).alias("raw_symbol", "normalized_symbol"))


SHORT_OUT = ["short_volume_ratio", "short_interest_change_pct", "days_to_cover", "short_volume_20d_avg", "short_volume_ratio_20d_avg", "days_to_cover_zscore", "short_pressure_zscore", "short_squeeze_score"]
PRICE_OUT = ["symbol", "price_date", "close", "volume", "source_name"]
SPLITS = "CASE WHEN as_of_date <= DATE '1998-12-31' THEN 'train' WHEN as_of_date <= DATE '1999-12-31' THEN 'val' ELSE 'test' END"


def splits(s, d):
    return l.split_by_date(l.research_labels(frame(s, d, "bars")).select("symbol", "as_of_date", F.col("return_fwd_5d").alias("target_return")), "1998-12-31", "1999-12-31")


def overrides(s, d):
    return frame(s, d, "universe").where("length(symbol) = 2").select("symbol", F.lit(True).alias("include"), F.lit("checked").alias("reason"))


QUERIES = {
    "P1_clean_keys": one(lambda x: c.clean_keys(x.select("symbol", "bar_id"), "symbol"), "raw_bars"),
    "P2_normalize_bars": lambda s, d: rounded(c.normalize_bars(frame(s, d, "raw_bars"), frame(s, d, "universe").where("include_in_universe").select("symbol")).select("bar_id", "symbol", "open", "high", "low", "close", "volume", "accepted")),
    "P3_normalize_exchange": one(lambda x: x.select("s_suppkey", c.normalize_exchange(F.col("exchange_raw")).alias("exchange")), "candidates"),
    "P4_classify_security": one(lambda x: classified(x).select("s_suppkey", "security_type", "is_common_stock", "is_adr", "is_etf", "is_preferred", "is_warrant", "is_right", "is_unit"), "candidates"),
    "P5_decide_inclusion": one(lambda x: classified(x).select("s_suppkey", F.col("exclusion_reason").isNull().alias("include"), "exclusion_reason"), "candidates"),
    "P6_map_provider_symbol": one(lambda x: x.select("p_partkey", *(v.alias(k) for k, v in c.map_provider_symbol(F.col("symbol")).items())), "provider_symbols"),
    "P7_normalize_company_name": one(lambda x: x.select("s_suppkey", c.normalize_company_name(F.col("company_name")).alias("name")), "candidates"),
    "P8_strip_company_suffixes": one(lambda x: x.select("s_suppkey", c.strip_company_suffixes(c.normalize_company_name(F.col("company_name"))).alias("stripped"), c.strip_company_suffixes(c.normalize_company_name(F.col("company_name")), True, c.SUFFIXES[:-1]).alias("one_pass")), "candidates"),
    "P9_generate_aliases": one(lambda x: x.select("s_suppkey", F.array_join(c.generate_aliases(F.col("company_name")), "|").alias("aliases")), "candidates"),
    "P10_symbol_normalization_map": lambda s, d: c.correct_symbols(frame(s, d, "provider_symbols"), corrections(s)).select("p_partkey", "symbol"),
    "P11_liquidity_filter": lambda s, d: rounded(c.liquidity_filter(vols(s, d), 1000, 20000, 5, 1.2, ("S3",)).select("symbol", "as_of_date", "adj_close", "volume")),
    "P12_market_selection": one(lambda x: c.market_selection(x, "regular").groupBy("source_market").agg(F.count("*").alias("n"), F.sum("short_interest").alias("total")), "short_interest"),
    "P13_news_raw_filter": one(lambda x: c.news_raw_filter(x.withColumn("title", F.when(F.col("raw_id") % 10 != 0, F.col("title")))).groupBy("accepted").agg(F.count("*").alias("n")), "articles"),
    "P14_manual_override_apply": lambda s, d: c.apply_overrides(frame(s, d, "universe"), overrides(s, d)),
    "H1_daily_short_volume_history": one(lambda x: h.short_volume_history(x).select("symbol", "trade_date", "source_file", "available_at", "short_volume_ratio", "short_exempt_ratio"), "short_volume"),
    "H2_short_interest_history": one(lambda x: h.short_interest_history(x).select("symbol", "settlement_date", "source_file", "short_interest", "days_to_cover", "short_interest_pct_float"), "short_interest"),
    "H3_short_interest_latest": one(lambda x: h.short_interest_latest(h.short_interest_history(x)).select("symbol", "settlement_date", "short_interest", "ingested_at"), "short_interest"),
    "H4_short_interest_object_path": one(lambda x, u: h.short_interest_counts(x, u, "regular"), "short_interest", "universe"),
    "H5_short_rolling": one(lambda x: h.short_rolling(h.short_daily(x)).select("symbol", "as_of_date", "short_volume_ratio", "short_volume_20d_avg", "short_volume_ratio_20d_avg", "short_volume_ratio_20d_std"), "short_volume"),
    "H6_short_features_daily": lambda s, d: rounded(short_all(s, d).select("symbol", "as_of_date", "short_interest", *SHORT_OUT)),
    "H7_refresh_features": lambda s, d: rounded(h.refresh_features(h.short_daily(frame(s, d, "short_volume")), h.short_interest_history(frame(s, d, "short_interest")), "1998-06-01").select("symbol", "as_of_date", "short_interest", *SHORT_OUT)),
    "H7_refresh_late": lambda s, d: rounded(late_refreshed(s, d).select("symbol", "as_of_date", "short_interest", *SHORT_OUT)),
    "H7_short_feature_window": lambda s, d: h.feature_window_start(h.short_daily(frame(s, d, "short_volume"))),
    "A2_short_daily_agg": one(lambda x: h.short_daily(x), "short_volume"),
    "C1_effective_prices": on_effective(lambda x: x.select(*PRICE_OUT)),
    "C2_best_available_source": lambda s, d: p.best_available_source(frame(s, d, "prices_base").where("volume < 0"), frame(s, d, "prices_preferred"), frame(s, d, "prices_base")).select(*PRICE_OUT),
    "C3_filter_universe_prices": on_effective(lambda x, u: p.filter_universe_prices(x, u).groupBy("symbol").agg(F.count("*").alias("n"), F.max("price_date").alias("last_date")), "universe"),
    "C4_price_bars": on_effective(lambda x, i: p.price_bars(x, i), "instruments"),
    "C5_price_quality_flags": on_effective(lambda x: p.price_quality_flags(x)),
    "C5_bar_flags": one(lambda x: p.bar_flags(x.withColumn("source_name", F.lit("raw"))), "raw_bars"),
    "C6_price_latest": on_effective(lambda x: p.price_latest(x)),
    "C7_price_history_compat": on_effective(lambda x: p.price_history_compat(x)),
    "C8_permanent_failures": lambda s, d: p.permanent_failures(failures(s, d), "2024-01-31"),
    "U19_symbols_needing_refresh": on_effective(lambda x, u: p.symbols_needing_refresh(u, x, "2001-10-15"), "universe"),
    "U20_refresh_window": lambda s, d: p.refresh_window(p.price_date_counts(effective(s, d)), "2001-11-10"),
    "A12_price_date_counts": on_effective(lambda x: p.price_date_counts(x)),
    "A1_coverage_summary": lambda s, d: a.coverage_summary(f.momentum(frame(s, d, "bars"), frame(s, d, "instruments")), "symbol", "as_of_date", ["rsi_14", "returns_20d", "company_id"]),
    "A8_split_stats": lambda s, d: rounded(a.split_stats(splits(s, d))),
    "A9_table_signature": on_effective(lambda x: a.table_signature(x, "prices")),
    "A10_data_quality_counts": one(lambda x: a.data_quality_counts(x, ["open", "high", "close", "volume"], "price_date", "1996-01-01", "2000-12-31"), "raw_bars"),
    "A11_top_companies": one(lambda x: a.top_groups(x, "company_id"), "fundamentals"),
    "A13_universe_summary": on_effective(lambda x, m: a.universe_summary(x, m), "memberships"),
    "U16_research_universe": on_effective(lambda x, m: a.universe_summary(x, m).where("bar_count >= 20 and member_from is not null"), "memberships"),
    "A14_file_row_counts": one(lambda x: a.file_row_counts(x, "source_market"), "short_interest"),
    "A15_duplicate_keys": one(lambda x: a.duplicate_keys(x, "symbol", "trade_date"), "short_volume"),
    "A16_event_breakdown": one(lambda x: a.breakdown(x, "source_name"), "articles"),
    "A17_source_breakdown": on_effective(lambda x: a.breakdown(x, "source_name")),
    "A18_changed_sources": lambda s, d: a.changed_sources(a.table_signature(effective(s, d), "prices").unionByName(a.table_signature(frame(s, d, "bars"), "bars")), a.table_signature(effective(s, d).where("volume > 5"), "prices").unionByName(a.table_signature(frame(s, d, "bars"), "bars"))),
    "L13_snapshot_manifest": lambda s, d: a.snapshot_manifest({"prices": effective(s, d), "bars": frame(s, d, "bars"), "none": frame(s, d, "bars").limit(0), "universe": frame(s, d, "universe")}, ["prices", "bars", "none", "universe", "gone"]),
}

EFFECTIVE = ctes("prices_base", "prices_preferred", "universe", "instruments", "memberships", "bars") + """,
u0 AS (SELECT *, 1 AS pr FROM prices_base UNION ALL SELECT *, 2 AS pr FROM prices_preferred),
u1 AS (SELECT upper(trim(symbol)) AS symbol, price_date, open, high, low, close, volume, source_name, ingested_at, row_number() OVER (PARTITION BY upper(trim(symbol)), price_date ORDER BY pr DESC, ingested_at DESC NULLS LAST, source_name DESC NULLS LAST) AS rk FROM u0),
eff AS (SELECT symbol, price_date, open, high, low, close, volume, source_name, ingested_at FROM u1 WHERE rk = 1)"""
_VEN = ", ".join(f"('{k}', '{v}')" for k, v in c.VENUES.items())
CLASSES = ctes("candidates") + f""",
ven AS (SELECT * FROM (VALUES {_VEN}) t(raw, venue)),
n0 AS (SELECT *, nullif(trim(regexp_replace(upper(exchange_raw), '[\\s-]+', ' ', 'g')), '') AS ex, upper(company_name) || coalesce(' ' || upper(security_type_raw), '') AS blob, upper(coalesce(security_type_raw, '')) AS rt FROM candidates),
n1 AS (SELECT n0.*, coalesce(ven.venue, ex) AS exchange, contains(' ' || blob || ' ', ' ETF') OR contains(blob, 'EXCHANGE TRADED FUND') AS is_etf, contains(' ' || blob || ' ', ' ADR') OR contains(' ' || blob || ' ', ' ADS') OR contains(blob, 'DEPOSITARY') AS is_adr,
  contains(blob, 'PREFERRED') OR contains(blob, 'PREF ') AS is_preferred, contains(blob, 'WARRANT') AS is_warrant, contains(' ' || blob || ' ', ' RIGHT') AS is_right, contains(' ' || blob || ' ', ' UNIT') AS is_unit FROM n0 LEFT JOIN ven ON ven.raw = n0.ex),
cls AS (SELECT *, NOT (is_etf OR is_preferred OR is_warrant OR is_right OR is_unit) AS is_common_stock, CASE WHEN is_etf THEN 'ETF' WHEN is_adr THEN 'ADR' WHEN is_preferred THEN 'PREFERRED' WHEN is_warrant THEN 'WARRANT' WHEN is_right THEN 'RIGHT' WHEN is_unit THEN 'UNIT' ELSE 'COMMON_STOCK' END AS security_type FROM n1),
inc AS (SELECT *, CASE WHEN exchange IN ('OTC', 'OTCQX', 'OTCQB', 'OTCPINK', 'PINK', 'GREY', 'GREY_MARKET') THEN 'otc_security' WHEN is_etf THEN 'etf_excluded' WHEN is_preferred THEN 'preferred_excluded' WHEN is_warrant THEN 'warrant_excluded' WHEN is_right THEN 'right_excluded'
  WHEN is_unit THEN 'unit_excluded' WHEN is_adr AND exchange IS NOT NULL THEN NULL WHEN coalesce(exchange, '') NOT IN ('NASDAQ', 'NYSE', 'NYSE_ARCA', 'NYSEAMERICAN', 'NYSE_AMERICAN') THEN 'exchange_not_allowed' WHEN NOT is_common_stock THEN 'not_common_stock' END AS exclusion_reason FROM cls),
nam AS (SELECT *, trim(regexp_replace(regexp_replace(upper(company_name), '[^A-Z0-9 ]+', ' ', 'g'), ' +', ' ', 'g')) AS name, trim(regexp_replace(trim(regexp_replace(regexp_replace(upper(company_name), '[^A-Z0-9 ]+', ' ', 'g'), ' +', ' ', 'g')), '( ({'|'.join(c.SUFFIXES)}))+$', '')) AS stripped FROM inc)"""


def _one_pass(text: str) -> str:
    for suffix in c.SUFFIXES[:-1]:
        text = f"regexp_replace({text}, ' {suffix}$', '')"
    return f"trim({text})"


def w20(col: str, fn: str = "avg", keys: str = "symbol", order: str = "as_of_date") -> str:
    return f"{fn}({col}) OVER (PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"


SHORTS = ctes("short_volume", "short_interest", "universe") + f""",
daily AS (SELECT symbol, trade_date AS as_of_date, sum(short_volume) AS short_volume, sum(short_exempt_volume) AS short_exempt_volume, sum(total_volume) AS total_volume, max(available_at) AS max_source_available_at FROM short_volume GROUP BY symbol, trade_date),
rat AS (SELECT *, CASE WHEN total_volume > 0 THEN short_volume / total_volume END AS short_volume_ratio FROM daily),
roll AS (SELECT *, {w20('short_volume')} AS short_volume_20d_avg, {w20('short_volume_ratio')} AS short_volume_ratio_20d_avg, {w20('short_volume_ratio', 'stddev_samp')} AS short_volume_ratio_20d_std FROM rat),
si AS (SELECT * FROM (SELECT *, short_interest / nullif(avg_daily_volume, 0) AS days_to_cover, CAST(short_interest AS DOUBLE) / nullif(shares_float, 0) AS short_interest_pct_float, row_number() OVER (PARTITION BY symbol, settlement_date, source_file ORDER BY ingested_at DESC NULLS LAST) AS rk FROM short_interest) q WHERE rk = 1),
jn AS (SELECT * FROM (SELECT d.*, s.short_interest, s.previous_short_interest, s.days_to_cover, row_number() OVER (PARTITION BY d.symbol, d.as_of_date ORDER BY s.settlement_date DESC NULLS LAST, s.ingested_at DESC NULLS LAST, s.short_interest DESC NULLS LAST, s.previous_short_interest DESC NULLS LAST, s.avg_daily_volume DESC NULLS LAST) AS rk FROM roll d LEFT JOIN si s ON s.symbol = d.symbol AND s.settlement_date <= d.as_of_date AND s.ingested_at <= d.max_source_available_at) q WHERE rk = 1),
zs AS (SELECT *, (days_to_cover - {w20('days_to_cover', keys="symbol, date_trunc('month', as_of_date)")}) / nullif({w20('days_to_cover', 'stddev_samp', "symbol, date_trunc('month', as_of_date)")}, 0) AS days_to_cover_zscore, (short_volume_ratio - short_volume_ratio_20d_avg) / nullif(short_volume_ratio_20d_std, 0) AS short_pressure_zscore,
  CAST(short_interest - previous_short_interest AS DOUBLE) / nullif(previous_short_interest, 0) AS short_interest_change_pct FROM jn),
sf AS (SELECT *, CASE WHEN days_to_cover IS NOT NULL OR short_volume_ratio IS NOT NULL THEN coalesce(short_pressure_zscore, 0) + coalesce(days_to_cover_zscore, 0) END AS short_squeeze_score FROM zs)"""
_SIG = "CAST(coalesce(sum(CAST('0x' || substr(md5(symbol || '|' || CAST({d} AS VARCHAR)), 1, 8) AS BIGINT)), 0) AS BIGINT) AS checksum"
_SIGN = "SELECT '{n}' AS table_name, count(*) AS row_count, min({d}) AS min_date, max({d}) AS max_date, " + _SIG + " FROM {t}"
_COUNTS = EFFECTIVE + ", cn AS (SELECT price_date, count(DISTINCT symbol) AS symbols FROM eff GROUP BY price_date ORDER BY price_date DESC LIMIT 30), pc AS (SELECT *, max(symbols) OVER () AS expected, symbols >= 0.9 * max(symbols) OVER () AS is_complete FROM cn)"
_SUMMARY = EFFECTIVE + """, sm AS (SELECT e.symbol, first_bar, last_bar, bar_count, latest_close, latest_dollar_volume, member_from, member_to FROM (SELECT symbol, min(price_date) AS first_bar, max(price_date) AS last_bar, count(*) AS bar_count, max_by(close, price_date) AS latest_close, max_by(close * volume, price_date) AS latest_dollar_volume FROM eff GROUP BY symbol) e
  LEFT JOIN (SELECT symbol, min(effective_from) AS member_from, max(effective_to) AS member_to FROM memberships GROUP BY symbol) m ON e.symbol = m.symbol)"""
_PSYM = ctes("provider_symbols") + ", ps AS (SELECT p_partkey, upper(trim(symbol)) AS raw FROM provider_symbols), pr AS (SELECT *, CASE WHEN raw = '' THEN 'empty_symbol' WHEN contains(raw, '$') THEN 'contains_dollar_syntax' WHEN regexp_matches(raw, '(^|[-.])(R|RI|RT)$') THEN 'rights_not_supported' WHEN regexp_matches(raw, '(^|[-.])(W|WT)$') THEN 'warrants_not_supported' WHEN regexp_matches(raw, '(^|[-.])UN$') THEN 'units_not_supported' WHEN regexp_matches(raw, '(^|[-.])P[A-Z]?$') THEN 'preferred_not_supported_by_default' END AS exclusion_reason FROM ps)"
_BARS2 = ctes("raw_bars", "universe") + """, b0 AS (SELECT bar_id, nullif(upper(trim(symbol)), '') AS symbol, coalesce(close, open, high, low) AS close, open, high, low, volume FROM raw_bars),
b1 AS (SELECT bar_id, symbol, coalesce(open, close) AS open, coalesce(high, close) AS high, coalesce(low, close) AS low, close, coalesce(volume, 0) AS volume FROM b0 WHERE symbol IS NOT NULL)"""
ORACLES = {
    "P1_clean_keys": f"{ctes('raw_bars')} SELECT upper(trim(symbol)) AS symbol, bar_id FROM raw_bars WHERE trim(symbol) <> ''",
    "P2_normalize_bars": f"{_BARS2} SELECT bar_id, symbol, {r('open', 'high', 'low', 'close')}, volume, symbol IN (SELECT symbol FROM universe WHERE include_in_universe) AND least(open, high, low, close, volume) >= 0 AND high >= greatest(open, close, low) AND low <= least(open, close) AS accepted FROM b1",
    "P3_normalize_exchange": f"{CLASSES} SELECT s_suppkey, exchange FROM cls",
    "P4_classify_security": f"{CLASSES} SELECT s_suppkey, security_type, is_common_stock, is_adr, is_etf, is_preferred, is_warrant, is_right, is_unit FROM cls",
    "P5_decide_inclusion": f"{CLASSES} SELECT s_suppkey, exclusion_reason IS NULL AS include, exclusion_reason FROM inc",
    "P6_map_provider_symbol": f"{_PSYM} SELECT p_partkey, exclusion_reason, CASE WHEN exclusion_reason IS NULL THEN CASE WHEN regexp_matches(raw, '^[A-Z0-9]+[.][A-Z]$') THEN replace(raw, '.', '-') ELSE raw END END AS provider_symbol FROM pr",
    "P7_normalize_company_name": f"{CLASSES} SELECT s_suppkey, name FROM nam",
    "P8_strip_company_suffixes": f"{CLASSES} SELECT s_suppkey, stripped, {_one_pass('name')} AS one_pass FROM nam",
    "P9_generate_aliases": f"{CLASSES} SELECT s_suppkey, name || CASE WHEN stripped <> name AND stripped <> '' THEN '|' || stripped ELSE '' END || CASE WHEN replace(stripped, ' ', '') NOT IN (name, stripped, '') THEN '|' || replace(stripped, ' ', '') ELSE '' END AS aliases FROM nam",
    "P10_symbol_normalization_map": f"{ctes('provider_symbols')} SELECT p_partkey, CASE symbol WHEN 'RED/B' THEN 'RED.B' WHEN 'BIG/B' THEN 'BIG.B' ELSE symbol END AS symbol FROM provider_symbols",
    "P11_liquidity_filter": f"{ctes('bars', 'instruments')}, {BASE}, {VOLATILITY} SELECT symbol, as_of_date, {r('adj_close')}, volume FROM volatility WHERE adj_close >= 1000 AND adj_close * volume >= 20000 AND volume >= 5 AND volatility_20d <= 1.2 AND symbol <> 'S3'",
    "P12_market_selection": f"{ctes('short_interest')} SELECT source_market, count(*) AS n, CAST(sum(short_interest) AS BIGINT) AS total FROM short_interest WHERE source_market = 'regular' GROUP BY source_market",
    "P13_news_raw_filter": f"{ctes('articles')} SELECT raw_id % 10 <> 0 AS accepted, count(*) AS n FROM articles GROUP BY 1",
    "P14_manual_override_apply": f"{ctes('universe')} SELECT symbol, include_in_universe OR length(symbol) = 2 AS include_in_universe, CASE WHEN length(symbol) = 2 THEN 'checked' END AS override_reason FROM universe",
    "H1_daily_short_volume_history": f"{SHORTS}, x AS (SELECT *, short_volume / nullif(total_volume, 0) AS short_volume_ratio, short_exempt_volume / nullif(total_volume, 0) AS short_exempt_ratio, row_number() OVER (PARTITION BY symbol, trade_date, source_file ORDER BY available_at DESC NULLS LAST, short_volume NULLS LAST, short_exempt_volume NULLS LAST, total_volume NULLS LAST) AS rk FROM short_volume) SELECT symbol, trade_date, source_file, available_at, {r('short_volume_ratio', 'short_exempt_ratio')} FROM x WHERE rk = 1",
    "H2_short_interest_history": f"{SHORTS} SELECT symbol, settlement_date, source_file, short_interest, {r('days_to_cover', 'short_interest_pct_float')} FROM si",
    "H3_short_interest_latest": f"{SHORTS}, x AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY settlement_date DESC NULLS LAST, ingested_at DESC NULLS LAST, short_interest, previous_short_interest, avg_daily_volume) AS k FROM si) SELECT symbol, settlement_date, short_interest, ingested_at FROM x WHERE k = 1",
    "H4_short_interest_object_path": f"{SHORTS} SELECT source_file, count(*) AS total_rows, count(*) FILTER (WHERE source_market = 'regular') AS market_rows, count(*) FILTER (WHERE source_market = 'regular' AND symbol IN (SELECT symbol FROM universe WHERE include_in_universe)) AS accepted_rows FROM short_interest GROUP BY source_file",
    "H5_short_rolling": f"{SHORTS} SELECT symbol, as_of_date, {r('short_volume_ratio', 'short_volume_20d_avg', 'short_volume_ratio_20d_avg', 'short_volume_ratio_20d_std')} FROM roll",
    "H6_short_features_daily": f"{SHORTS} SELECT symbol, as_of_date, short_interest, {r(*SHORT_OUT)} FROM sf",
    "H7_refresh_features": f"{SHORTS} SELECT symbol, as_of_date, short_interest, {r(*SHORT_OUT)} FROM sf WHERE as_of_date >= DATE '1998-06-01'",
    "H7_refresh_late": f"{SHORTS} SELECT symbol, as_of_date, short_interest, {r(*SHORT_OUT)} FROM sf",
    "H7_short_feature_window": f"{SHORTS} SELECT CAST(max(as_of_date) - INTERVAL '45' DAY AS DATE) AS window_start FROM daily",
    "A2_short_daily_agg": f"{SHORTS} SELECT * FROM daily",
    "C1_effective_prices": f"{EFFECTIVE} SELECT symbol, price_date, {r('close')}, volume, source_name FROM eff",
    "C2_best_available_source": f"{EFFECTIVE} SELECT symbol, price_date, close, volume, source_name FROM prices_preferred",
    "C3_filter_universe_prices": f"{EFFECTIVE} SELECT symbol, count(*) AS n, max(price_date) AS last_date FROM eff WHERE symbol IN (SELECT symbol FROM universe WHERE include_in_universe) GROUP BY symbol",
    "C4_price_bars": f"{EFFECTIVE} SELECT i.instrument_id, e.symbol, price_date AS bar_date, round(open, 9) + 0.0 AS adj_open, round(high, 9) + 0.0 AS adj_high, round(low, 9) + 0.0 AS adj_low, round(close, 9) + 0.0 AS adj_close, volume, CAST(1.0 AS DOUBLE) AS adjustment_factor FROM eff e LEFT JOIN instruments i ON i.symbol = e.symbol",
    "C5_price_quality_flags": f"{EFFECTIVE}, x AS (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY price_date) AS prev FROM eff) SELECT symbol, price_date, 'raw_return_abs_gt_80pct' AS flag_type, round(abs(close / nullif(prev, 0) - 1), 6) + 0.0 AS flag_value, source_name FROM x WHERE prev > 0 AND abs(close / nullif(prev, 0) - 1) > 0.8 UNION ALL SELECT symbol, price_date, 'close_nonpositive', round(CAST(close AS DOUBLE), 6) + 0.0, source_name FROM x WHERE close <= 0 UNION ALL SELECT symbol, price_date, 'volume_negative', round(CAST(volume AS DOUBLE), 6) + 0.0, source_name FROM x WHERE volume < 0",
    "C5_bar_flags": f"{ctes('raw_bars')} SELECT symbol, price_date, 'high_below_low' AS flag_type, 'true' AS flag_value, 'raw' AS source_name FROM raw_bars WHERE high < low UNION ALL SELECT symbol, price_date, 'negative_volume', 'true', 'raw' FROM raw_bars WHERE volume < 0",
    "C6_price_latest": f"{EFFECTIVE} SELECT symbol, max(price_date) AS latest_price_date, max_by(close, price_date) AS close, max_by(volume, price_date) AS volume, max_by(source_name, price_date) AS source_name FROM eff GROUP BY symbol",
    "C7_price_history_compat": f"{EFFECTIVE} SELECT symbol, price_date, {r('open', 'high', 'low', 'close')}, volume, source_name, ingested_at FROM eff",
    "C8_permanent_failures": f"{ctes('articles')} SELECT symbol FROM articles GROUP BY symbol HAVING count(*) >= 2 AND max(published_at) >= TIMESTAMP '2024-01-24 00:00:00' AND max(CASE WHEN source_name = 'error' THEN 'No Data found' ELSE 'timeout' END) = 'No Data found'",
    "U19_symbols_needing_refresh": f"{EFFECTIVE}, x AS (SELECT u.symbol, max(price_date) AS last_price_date FROM (SELECT DISTINCT symbol FROM universe) u LEFT JOIN eff e ON e.symbol = u.symbol GROUP BY u.symbol) SELECT * FROM x WHERE last_price_date IS NULL OR last_price_date < DATE '2001-10-15'",
    "U20_refresh_window": f"{_COUNTS}, st AS (SELECT max(price_date) AS last, max(CASE WHEN is_complete THEN price_date END) AS done, DATE '2001-11-09' AS e FROM pc), fr AS (SELECT *, CASE WHEN last > coalesce(done, DATE '1900-01-01') THEN last ELSE CAST(done + INTERVAL '1' DAY AS DATE) END AS f FROM st) SELECT CASE WHEN f > e THEN 'up_to_date' WHEN f = last THEN 'partial_latest' ELSE 'catch_up' END AS action, CASE WHEN f <= e THEN greatest(f, CAST(e - INTERVAL '30' DAY AS DATE)) END AS start_date, CASE WHEN f <= e THEN e END AS end_date FROM fr",
    "A12_price_date_counts": f"{_COUNTS} SELECT * FROM pc",
    "A1_coverage_summary": f"{ctes('bars', 'instruments')}, {BASE} SELECT count(*) AS row_count, count(DISTINCT symbol) AS symbol_count, min(as_of_date) AS min_date, max(as_of_date) AS max_date, count(CASE WHEN rn >= 15 THEN 1 END) AS rsi_14_count, count(CASE WHEN rn > 20 THEN 1 END) AS returns_20d_count, count(company_id) AS company_id_count FROM base",
    "A8_split_stats": f"{ctes('bars')}, y AS (SELECT symbol, bar_date AS as_of_date, lead(adj_close, 5) OVER (PARTITION BY symbol ORDER BY bar_date) / nullif(adj_close, 0) - 1 AS x FROM bars), z AS (SELECT *, CASE WHEN abs(x) <= 5 THEN x END AS t, {SPLITS} AS split FROM y) SELECT split, count(*) AS row_count, count(DISTINCT symbol) AS symbol_count, count(DISTINCT as_of_date) AS date_count, round(avg(t), 6) + 0.0 AS target_mean, round(avg(CASE WHEN t IS NOT NULL THEN CAST(t > 0 AS INTEGER) END), 6) + 0.0 AS positive_rate FROM z GROUP BY split",
    "A9_table_signature": f"{EFFECTIVE} {_SIGN.format(n='prices', d='price_date', t='eff')}",
    "A10_data_quality_counts": f"{ctes('raw_bars')} SELECT " + ", ".join(f"count(*) FILTER (WHERE {x} IS NULL) AS {x}_nulls" for x in ("open", "high", "close", "volume")) + ", count(*) FILTER (WHERE price_date IS NULL OR price_date NOT BETWEEN DATE '1996-01-01' AND DATE '2000-12-31') AS dates_out_of_range FROM raw_bars",
    "A11_top_companies": f"{ctes('fundamentals')} SELECT company_id, count(*) AS n FROM fundamentals GROUP BY company_id ORDER BY n DESC, company_id LIMIT 10",
    "A13_universe_summary": f"{_SUMMARY} SELECT symbol, first_bar, last_bar, bar_count, {r('latest_close', 'latest_dollar_volume')}, member_from, member_to FROM sm",
    "U16_research_universe": f"{_SUMMARY} SELECT symbol, first_bar, last_bar, bar_count, {r('latest_close', 'latest_dollar_volume')}, member_from, member_to FROM sm WHERE bar_count >= 20 AND member_from IS NOT NULL",
    "A14_file_row_counts": f"{ctes('short_interest')} SELECT source_file, source_market, count(*) AS row_count, max(ingested_at) AS last_loaded_at FROM short_interest GROUP BY source_file, source_market",
    "A15_duplicate_keys": f"{ctes('short_volume')} SELECT symbol, trade_date, count(*) AS n FROM short_volume GROUP BY symbol, trade_date HAVING count(*) > 1",
    "A16_event_breakdown": f"{ctes('articles')} SELECT source_name, count(*) AS n FROM articles GROUP BY source_name",
    "A17_source_breakdown": f"{EFFECTIVE} SELECT source_name, count(*) AS n FROM eff GROUP BY source_name",
    "A18_changed_sources": f"{EFFECTIVE} SELECT table_name, row_count, checksum FROM ({_SIGN.format(n='prices', d='price_date', t='eff')}) x",
    "L13_snapshot_manifest": f"{EFFECTIVE} SELECT *, CAST(NULL AS VARCHAR) AS error FROM ({_SIGN.format(n='prices', d='price_date', t='eff')}) x UNION ALL SELECT *, NULL FROM ({_SIGN.format(n='bars', d='bar_date', t='bars')}) y UNION ALL SELECT 'none', 0, NULL, NULL, 0, 'empty_table' UNION ALL SELECT 'gone', 0, NULL, NULL, 0, 'missing_table' UNION ALL SELECT 'universe', count(*), NULL, NULL, CAST(sum(CAST('0x' || substr(md5(symbol || '|'), 1, 8) AS BIGINT)) AS BIGINT), 'no_date_bounds' FROM universe",
}
