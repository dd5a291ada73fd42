"""Queries of universe, identity and listing history."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.shared import scratch
from ..operators import listing_state as ls
from ..operators import universe as u
from .features import BASE, VOLATILITY, rounded
from .inputs import ctes, frame
from .market import CLASSES, EFFECTIVE, effective, vols


def market(s, d):
    return u.market_universe(frame(s, d, "candidates"))


def observed(s, d):
    return u.listing_observations(frame(s, d, "snapshots"))


def listings(s, d):
    return u.listing_history(observed(s, d))


def kept_up(s, d):
    """The state after all snapshots, of which each year's first comes late, the newest of these first."""
    seen, path = observed(s, d), scratch(s, "listing-state")
    late = seen.where(F.month("as_of_date") == 1)
    ls.build_state(seen.where(F.month("as_of_date") != 1), path, buckets=8)
    # one row per snapshot
    for r in late.select("as_of_date").distinct().orderBy(F.col("as_of_date").desc()).collect():
        ls.update_state(late, r["as_of_date"], path, buckets=8)
    return ls.read_state(s, path)[0]


def differences(s, d):
    return u.snapshot_diff_events(observed(s, d)).select("symbol", "event_type", F.col("next_date").alias("event_date"), F.col("cik").alias("old_value"), F.lit(None).cast("string").alias("new_value"), F.lit("diff").alias("source_name"))


GONE = "event_type = 'POSSIBLE_DISAPPEARANCE'"


def events(s, d):
    e = differences(s, d)
    return u.event_history_append(u.event_history_append(None, e.where(GONE)), e).select("event_id", "symbol", "event_type", "event_date")


def event_audit(s, d):
    e = differences(s, d)
    return u.audit_append(u.audit_append(None, u.event_audit(e.where(GONE))), u.event_audit(e))


def memberships(s, d):
    mu = observed(s, d).withColumns({"eligible_reason": u.eligibility(), "effective_from": F.col("as_of_date"), "effective_to": F.col("as_of_date")}).withColumn("eligible_flag", F.col("eligible_reason").startswith("INCLUDED"))
    refs = u.reference_history(observed(s, d)).withColumnRenamed("identity", "listing_id")
    ls = listings(s, d).select("symbol", F.col("identity").alias("listing_id"), F.when(F.col("exchange") == "NYSE", F.concat(F.lit("COMP:"), "identity")).alias("company_id"), "effective_from", "effective_to")
    return u.membership_history(mu, refs, ls)


def filings(s, d):
    return frame(s, d, "instruments").select("symbol", F.substring("instrument_id", 6, 9).alias("cik"), F.concat(F.lit("Company "), F.substring("symbol", 2, 9)).alias("company_name"))


def enriched(part):
    return lambda s, d: u.enrich_from_filings(frame(s, d, "snapshots").select("symbol", "cik", "company_name").distinct(), filings(s, d))[part]


def master(s, d):
    return u.instrument_master(effective(s, d), frame(s, d, "instruments").withColumn("is_active", F.col("instrument_id").endswith("1")))


FLOORS = dict(min_price=1000, min_dollar_volume=20000, min_volume=5, max_volatility=1.2)
QUERIES = {
    "U1_market_universe": lambda s, d: market(s, d).select("symbol", "company_name", "cik", "exchange_normalized", "is_etf", "is_adr", "is_common_stock", "exclusion_reason", "include_in_universe"),
    "A3_universe_evidence": lambda s, d: market(s, d).select("symbol", "is_preferred", "is_warrant", "is_right", "is_unit", "source_count"),
    "U2_market_universe_conflicts": lambda s, d: u.market_universe_conflicts(market(s, d)).select("symbol", F.get_json_object("payload_json", "$.source_count").cast("int").alias("source_count")),
    "U3_resolve_universe_candidates": lambda s, d: u.resolve_candidates(frame(s, d, "candidates")).select("symbol", "candidate_rank", "s_suppkey"),
    "U4_symbol_reference": lambda s, d: u.symbol_reference(market(s, d)).select("symbol", "cik", "company_name_clean", "symbol_match_enabled", "name_match_enabled"),
    "U5_listing_observations": lambda s, d: observed(s, d),
    "U6_listing_history_scd2": lambda s, d: listings(s, d).select("identity", "version", "symbol", "exchange", "security_type", "effective_from", "effective_to", "is_active"),
    "U6_apply_snapshots": lambda s, d: ls.listing_versions(kept_up(s, d)).select("identity", "version", "symbol", "exchange", "security_type", "effective_from", "effective_to", "is_active"),
    "U9_apply_snapshots": lambda s, d: u.reference_history(ls.sightings_of(kept_up(s, d))),
    "U7_consecutive_missing_snapshots": lambda s, d: u.consecutive_missing(observed(s, d)),
    "U8_market_universe_history": lambda s, d: u.universe_history(listings(s, d)),
    "U9_symbol_reference_history": lambda s, d: u.reference_history(observed(s, d)),
    "U10_universe_membership_history": memberships,
    "U11_snapshot_diff_events": lambda s, d: u.snapshot_diff_events(observed(s, d)),
    "U12_event_history_append": events,
    "U12_event_audit": event_audit,
    "U13_enrich_listing_from_filings": enriched(0),
    "U13_name_events": enriched(1),
    "U14_instrument_master": master,
    "U14_ticker_history": lambda s, d: u.ticker_history(master(s, d)),
    "U14_identifier_map": lambda s, d: u.identifier_map(master(s, d)),
    "U15_membership_bootstrap": lambda s, d: u.membership_bootstrap(effective(s, d), 5000, 10),
    "U17_research_universe_quality_20d": lambda s, d: u.quality_universe(vols(s, d), **FLOORS),
    "U18_whitelist_20d_pit": lambda s, d: u.whitelist_pit(u.quality_universe(vols(s, d), **FLOORS), frame(s, d, "memberships")),
    "U21_history_readiness": lambda s, d: u.history_readiness(observed(s, d), effective(s, d)),
}
_PREF = lambda c: f"coalesce(max(CASE WHEN source_name = 'sec_tickers' THEN {c} END), max(CASE WHEN source_name = 'nasdaq_listed' THEN {c} END), max({c})) AS {c}"
MARKET = CLASSES + f""",
ag AS (SELECT upper(trim(symbol)) AS symbol, {_PREF('company_name')}, {_PREF('cik')}, {_PREF('exchange')}, {', '.join(f'bool_or({x}) AS {x}' for x in ('is_etf', 'is_adr', 'is_preferred', 'is_warrant', 'is_right', 'is_unit'))}, count(DISTINCT source_name) AS source_count FROM inc GROUP BY upper(trim(symbol))),
mu AS (SELECT *, CASE WHEN exchange IN ('OTC', 'OTCQX', 'OTCQB', 'OTCPINK', 'PINK', 'GREY', 'GREY_MARKET') THEN 'otc_security' WHEN is_etf THEN 'etf_excluded' WHEN is_preferred THEN 'preferred_excluded' WHEN is_warrant THEN 'warrant_excluded' WHEN is_right THEN 'right_excluded'
  WHEN is_unit THEN 'unit_excluded' WHEN is_adr AND exchange IS NOT NULL THEN NULL WHEN coalesce(exchange, '') NOT IN ('NASDAQ', 'NYSE', 'NYSE_ARCA', 'NYSEAMERICAN', 'NYSE_AMERICAN') THEN 'exchange_not_allowed' END AS exclusion_reason, NOT (is_etf OR is_preferred OR is_warrant OR is_right OR is_unit) AS is_common_stock FROM ag)"""
_NAME = "trim(regexp_replace(regexp_replace(upper(company_name), '[^A-Z0-9 ]+', ' ', 'g'), ' +', ' ', 'g'))"
HISTORY = ctes("snapshots", "universe", "instruments") + f""",
dy AS (SELECT as_of_date, row_number() OVER (ORDER BY as_of_date) AS sn FROM (SELECT DISTINCT as_of_date FROM snapshots) q),
ob AS (SELECT s.*, sn, coalesce('CIK:' || cik, 'SYM:' || symbol || '|' || {_NAME}) AS identity FROM snapshots s JOIN dy ON dy.as_of_date = s.as_of_date),
lg AS (SELECT *, lag(sn) OVER w AS psn, lag(symbol) OVER w AS ps, lag(exchange) OVER w AS pe, lag(security_type) OVER w AS pt, row_number() OVER w AS o FROM ob WINDOW w AS (PARTITION BY identity ORDER BY as_of_date, symbol, exchange, security_type)),
fl AS (SELECT *, psn IS NOT NULL AND sn - psn > 2 AS gap, CASE WHEN psn IS NULL OR sn - psn > 2 OR symbol <> ps OR exchange <> pe OR security_type <> pt THEN 1 ELSE 0 END AS fresh FROM lg),
vs AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY identity ORDER BY o) AS BIGINT) AS version FROM fl),
sp AS (SELECT identity, version, min(symbol) AS symbol, min(exchange) AS exchange, min(security_type) AS security_type, min(as_of_date) AS effective_from, max(sn) AS last, bool_or(gap AND fresh = 1) AS after_gap FROM vs GROUP BY identity, version),
nx AS (SELECT *, CASE WHEN lead(after_gap) OVER v THEN NULL ELSE lead(effective_from) OVER v END AS nf FROM sp WINDOW v AS (PARTITION BY identity ORDER BY version)),
li AS (SELECT nx.*, coalesce(nf, g.as_of_date) AS effective_to FROM nx LEFT JOIN dy g ON g.sn = nx.last + 2)"""
_ELIG = "CASE WHEN exchange NOT IN ('NASDAQ', 'NYSE') THEN 'EXCLUDED_EXCHANGE' WHEN security_type = 'ADR' THEN 'EXCLUDED_ADR' ELSE 'INCLUDED_COMMON_STOCK' END"
_DIFF = f"""{HISTORY}, pr AS (SELECT as_of_date, lead(as_of_date) OVER (ORDER BY as_of_date) AS next_date FROM dy), df AS (SELECT DISTINCT c.symbol, c.cik, c.as_of_date AS current_date, p.next_date, CASE WHEN n.cik IS NULL THEN 'POSSIBLE_DISAPPEARANCE' WHEN upper(c.company_name) <> upper(n.company_name) THEN 'POSSIBLE_COMPANY_NAME_CHANGE' WHEN c.exchange <> n.exchange THEN 'POSSIBLE_EXCHANGE_CHANGE' WHEN c.security_type <> n.security_type THEN 'POSSIBLE_SECURITY_TYPE_CHANGE' END AS event_type
  FROM snapshots c JOIN pr p ON p.as_of_date = c.as_of_date AND p.next_date IS NOT NULL LEFT JOIN snapshots n ON n.symbol = c.symbol AND n.as_of_date = p.next_date)"""
_EVENT = "symbol || '|' || event_type || '|' || CAST(next_date AS VARCHAR) || '|' || coalesce(cik, '') || '||diff'"
_REFS = f"""{HISTORY}, rl AS (SELECT identity, symbol, cik, exchange, {_NAME} AS name, as_of_date, row_number() OVER (PARTITION BY identity ORDER BY as_of_date, symbol, exchange, security_type) AS o FROM ob),
rn AS (SELECT *, CASE WHEN o = 1 OR lag(symbol) OVER w IS DISTINCT FROM symbol OR lag(cik) OVER w IS DISTINCT FROM cik OR lag(name) OVER w IS DISTINCT FROM name OR lag(exchange) OVER w IS DISTINCT FROM exchange THEN 1 ELSE 0 END AS fr FROM rl WINDOW w AS (PARTITION BY identity ORDER BY o)),
rv AS (SELECT *, CAST(sum(fr) OVER (PARTITION BY identity ORDER BY o) AS BIGINT) AS version FROM rn),
rg AS (SELECT identity, version, min(symbol) AS symbol, min(cik) AS cik, min(name) AS company_name_clean, min(exchange) AS exchange, min(as_of_date) AS effective_from FROM rv GROUP BY identity, version),
rf AS (SELECT *, lead(effective_from) OVER (PARTITION BY identity ORDER BY version) AS effective_to FROM rg)"""
_MEMBERS = f"""m AS (SELECT symbol, cik, as_of_date AS f, {_ELIG} AS er FROM snapshots), lc AS (SELECT *, CASE WHEN exchange = 'NYSE' THEN 'COMP:' || identity END AS company_id FROM li),
rb AS (SELECT m.symbol, m.f, r.cik, r.identity, row_number() OVER (PARTITION BY m.symbol, m.f ORDER BY CASE WHEN r.cik IS NULL THEN 1 ELSE 0 END, r.effective_from DESC, coalesce(r.effective_to, DATE '0001-01-01') DESC, r.cik NULLS LAST, r.identity) AS k FROM m JOIN rf r ON r.symbol = m.symbol AND r.effective_from <= m.f AND m.f <= coalesce(r.effective_to, DATE '9999-12-31')),
lb AS (SELECT m.symbol, m.f, l.company_id, l.identity, row_number() OVER (PARTITION BY m.symbol, m.f ORDER BY CASE WHEN l.company_id IS NULL THEN 1 ELSE 0 END, l.effective_from DESC, coalesce(l.effective_to, DATE '0001-01-01') DESC, l.company_id NULLS LAST, l.identity) AS k FROM m JOIN lc l ON l.symbol = m.symbol AND l.effective_from <= m.f AND m.f <= coalesce(l.effective_to, DATE '9999-12-31'))"""
_QUAL = f"{ctes('bars', 'instruments', 'memberships')}, {BASE}, {VOLATILITY}, qu AS (SELECT DISTINCT symbol, as_of_date FROM volatility WHERE adj_close >= 1000 AND adj_close * volume >= 20000 AND volume >= 5 AND volatility_20d <= 1.2)"
_MASTER = f"{EFFECTIVE}, sp AS (SELECT symbol, min(price_date) AS first_date, max(price_date) AS last_date FROM eff GROUP BY symbol), im AS (SELECT sp.symbol, coalesce(i.instrument_id, 'INST:' || substr(md5(sp.symbol), 1, 16)) AS instrument_id, coalesce(i.company_id, 'COMP:' || substr(md5(sp.symbol), 1, 16)) AS company_id, 'UNKNOWN' AS exchange, 'COMMON_STOCK' AS security_type, 'ORDINARY' AS share_class, first_date, last_date, CASE WHEN last_date >= (SELECT max(last_date) FROM sp) - INTERVAL '30' DAY THEN true ELSE coalesce(i.is_active, false) END AS is_active FROM sp LEFT JOIN (SELECT *, instrument_id LIKE '%1' AS is_active FROM instruments) i ON i.symbol = sp.symbol)"
ORACLES = {
    "U1_market_universe": f"{MARKET} SELECT symbol, company_name, cik, exchange AS exchange_normalized, is_etf, is_adr, is_common_stock, exclusion_reason, exclusion_reason IS NULL AS include_in_universe FROM mu",
    "A3_universe_evidence": f"{MARKET} SELECT symbol, is_preferred, is_warrant, is_right, is_unit, source_count FROM mu",
    "U2_market_universe_conflicts": f"{MARKET} SELECT symbol, CAST(source_count AS INTEGER) AS source_count FROM mu WHERE source_count > 1",
    "U3_resolve_universe_candidates": f"{CLASSES}, rk AS (SELECT upper(trim(symbol)) AS symbol, s_suppkey, CAST(row_number() OVER (PARTITION BY upper(trim(symbol)) ORDER BY CASE WHEN exclusion_reason IS NULL THEN 0 ELSE 1 END, CASE WHEN cik IS NULL THEN 1 ELSE 0 END, CASE exchange WHEN 'NASDAQ' THEN 0 WHEN 'NYSE' THEN 1 ELSE 2 END, source_name, company_name, cik NULLS LAST) AS INTEGER) AS candidate_rank FROM inc) SELECT symbol, candidate_rank, s_suppkey FROM rk WHERE candidate_rank <= 2",
    "U4_symbol_reference": f"{MARKET}, nn AS (SELECT *, {_NAME} AS nm FROM mu WHERE exclusion_reason IS NULL) SELECT symbol, cik, nm AS company_name_clean, length(symbol) >= 2 AS symbol_match_enabled, length(trim(regexp_replace(nm, '( (INCORPORATED|INC|CORPORATION|CORP|COMPANY|CO|LIMITED|LTD|HOLDINGS|HOLDING|GROUP|PLC|SA|NV|AG|LP|LLC|ADR|ADS|TRUST))+$', ''))) >= 4 AS name_match_enabled FROM nn",
    "U5_listing_observations": f"{ctes('snapshots')} SELECT * FROM snapshots",
    "U6_listing_history_scd2": f"{HISTORY} SELECT identity, version, symbol, exchange, security_type, effective_from, effective_to, effective_to IS NULL AS is_active FROM li",
    "U7_consecutive_missing_snapshots": f"{HISTORY} SELECT symbol, exchange, security_type, CAST((SELECT max(sn) FROM dy) - max(sn) AS INTEGER) AS missing_snapshots FROM ob GROUP BY symbol, exchange, security_type",
    "U8_market_universe_history": f"{HISTORY}, el AS (SELECT *, {_ELIG} AS er FROM li), e2 AS (SELECT *, CASE WHEN lag(er) OVER v IS DISTINCT FROM er OR lag(effective_to) OVER v IS DISTINCT FROM effective_from THEN 1 ELSE 0 END AS fr FROM el WINDOW v AS (PARTITION BY identity ORDER BY version)), e3 AS (SELECT *, sum(fr) OVER (PARTITION BY identity ORDER BY version) AS run FROM e2) SELECT identity, er LIKE 'INCLUDED%' AS eligible_flag, er AS eligible_reason, 'v1' AS rule_version, min(effective_from) AS effective_from, CASE WHEN bool_or(effective_to IS NULL) THEN NULL ELSE max(effective_to) END AS effective_to FROM e3 GROUP BY identity, run, er",
    "U9_symbol_reference_history": f"{_REFS} SELECT *, 'SYMREF:' || sha1(identity || '|' || symbol || '|' || CAST(effective_from AS VARCHAR)) AS symbol_reference_id, '[\"' || company_name_clean || '\"]' AS aliases_json, effective_to IS NULL AS is_active FROM rf",
    "U10_universe_membership_history": f"{_REFS}, {_MEMBERS} SELECT coalesce(lb.company_id, m.cik, rb.cik, rb.identity, lb.identity, m.symbol) AS instrument_id, lb.company_id, m.symbol, m.f AS effective_from, m.f AS effective_to, CASE WHEN er LIKE 'INCLUDED%' THEN 'ACTIVE' ELSE 'INACTIVE' END AS membership_status, er AS reason FROM m LEFT JOIN rb ON rb.symbol = m.symbol AND rb.f = m.f AND rb.k = 1 LEFT JOIN lb ON lb.symbol = m.symbol AND lb.f = m.f AND lb.k = 1",
    "U11_snapshot_diff_events": f"{_DIFF} SELECT * FROM df WHERE event_type IS NOT NULL",
    "U12_event_history_append": f"{_DIFF} SELECT 'NASDAQ_DAILY_LIST:' || md5({_EVENT}) AS event_id, symbol, event_type, next_date AS event_date FROM df WHERE event_type IS NOT NULL",
    "U12_event_audit": f"{_DIFF} SELECT 'AUDIT:' || md5({_EVENT}) AS audit_id, 'listing_event_history' AS entity_type, symbol || '|' || event_type || '|' || CAST(next_date AS VARCHAR) AS entity_key, 'INSERT' AS action_type, 'diff' AS source_name, 'DAILY_LIST' AS evidence_type, 'MEDIUM' AS confidence_level, cik AS old_value, CAST(NULL AS VARCHAR) AS new_value FROM df WHERE event_type IS NOT NULL",
    "U13_enrich_listing_from_filings": f"{HISTORY} SELECT DISTINCT s.symbol, coalesce(s.cik, substr(i.instrument_id, 6, 9)) AS cik, s.company_name FROM snapshots s LEFT JOIN instruments i ON i.symbol = s.symbol",
    "U13_name_events": f"{HISTORY}, x AS (SELECT DISTINCT s.symbol, s.company_name AS old_value, 'Company ' || substr(s.symbol, 2, 9) AS new_value FROM snapshots s JOIN instruments i ON i.symbol = s.symbol) SELECT symbol, 'NAME_DIFFERENCE' AS event_type, old_value, new_value FROM x WHERE trim(regexp_replace(regexp_replace(upper(old_value), '[^A-Z0-9 ]+', ' ', 'g'), ' +', ' ', 'g')) <> upper(new_value)",
    "U14_instrument_master": f"{_MASTER} SELECT * FROM im",
    "U14_ticker_history": f"{_MASTER} SELECT instrument_id, symbol, exchange, first_date AS valid_from, CAST(NULL AS DATE) AS valid_to, true AS is_current FROM im",
    "U14_identifier_map": f"{_MASTER} SELECT instrument_id, 'ticker' AS identifier_type, symbol AS identifier_value, true AS is_primary FROM im",
    "U15_membership_bootstrap": f"{EFFECTIVE} SELECT symbol, min(price_date) AS effective_from, CAST(NULL AS DATE) AS effective_to FROM eff WHERE close >= 5000 AND volume >= 10 GROUP BY symbol",
    "U17_research_universe_quality_20d": f"{_QUAL} SELECT * FROM qu",
    "U18_whitelist_20d_pit": f"{_QUAL} SELECT * FROM qu WHERE EXISTS (SELECT 1 FROM memberships m WHERE m.symbol = qu.symbol AND m.effective_from <= qu.as_of_date AND qu.as_of_date < coalesce(m.effective_to, DATE '9999-12-31'))",
    "U21_history_readiness": f"{EFFECTIVE.replace('WITH ', ctes('snapshots') + ', ', 1)}, o AS (SELECT count(*) AS overlap_symbols FROM (SELECT DISTINCT symbol FROM snapshots INTERSECT SELECT DISTINCT symbol FROM eff) q) SELECT (SELECT count(DISTINCT as_of_date) FROM snapshots) AS snapshot_dates, overlap_symbols, CASE WHEN (SELECT count(DISTINCT as_of_date) FROM snapshots) < 2 OR overlap_symbols = 0 THEN 0 WHEN (SELECT count(DISTINCT as_of_date) FROM snapshots) < 6 THEN 1 ELSE 2 END AS level FROM o",
}
ORACLES["U6_apply_snapshots"] = ORACLES["U6_listing_history_scd2"]
ORACLES["U9_apply_snapshots"] = ORACLES["U9_symbol_reference_history"]
