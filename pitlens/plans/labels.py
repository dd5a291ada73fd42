"""Queries of labels, datasets and point-in-time joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as f
from ..operators import joins as j
from ..operators import labels as l
from .features import BASE, MOMENTUM, places, rounded
from .inputs import ctes, frame

W = "OVER (PARTITION BY symbol ORDER BY bar_date)"


def fwd(k: int) -> str:
    return f"lead(adj_close, {k}) {W} / nullif(adj_close, 0) - 1"


def r(*columns: str) -> str:
    return ", ".join(f"round({c}, {places(c)}) + 0.0 AS {c}" for c in columns)


def feats(s, d):
    return f.momentum(frame(s, d, "bars"), frame(s, d, "instruments")).select("symbol", "as_of_date", "company_id", "adj_close", "rsi_14")


def labels(s, d):
    return l.research_labels(frame(s, d, "bars"))


def dated(s, d):
    return frame(s, d, "bars").withColumnRenamed("bar_date", "as_of_date")


FUND = ["effective_as_of_date", "available_at", "period_end_date", "filing", "revenue"]
FROM_FUND = "SELECT company_id, effective_as_of_date, available_at, period_end_date, filing, revenue FROM fundamentals"
LABELS = "labs AS (SELECT symbol, bar_date AS as_of_date, " + ", ".join(f"CASE WHEN abs(x{h}) <= 5 THEN x{h} END AS return_fwd_{h}d" for h in (1, 5, 10, 20)) + " FROM (SELECT *, " + ", ".join(f"{fwd(h)} AS x{h}" for h in (1, 5, 10, 20)) + " FROM bars) y)"
FEATS = f"{ctes('bars', 'instruments', 'fundamentals', 'memberships')},\n{MOMENTUM},\nfeats AS (SELECT symbol, as_of_date, company_id, adj_close, rsi_14 FROM momentum),\n{LABELS}"
SPLIT = {"train_start": "1995-01-01", "train_end": "1998-12-31", "valid_start": "1999-01-01", "valid_end": "1999-12-31", "test_start": "2000-02-01", "test_end": "2001-06-30"}


def manifest(s):
    return s.range(1).select(*(F.lit(v).cast("date").alias(k) for k, v in SPLIT.items()))


def pit(s, d):
    prices = frame(s, d, "bars").join(frame(s, d, "instruments"), "symbol").select("symbol", "bar_date", "company_id", "adj_close")
    found = l.latest_available(prices, frame(s, d, "fundamentals").select("company_id", "available_at", "filing"), "company_id", "fundamentals_json")
    return rounded(found.select("symbol", "bar_date", F.get_json_object("fundamentals_json", "$.filing").cast("long").alias("filing"), F.col("fundamentals_json").isNotNull().alias("matched")))


def bitemporal(s, d):
    left = frame(s, d, "short_volume").groupBy("symbol", "trade_date").agg(F.max("available_at").alias("max_available"))
    right = frame(s, d, "short_interest").groupBy("symbol", "settlement_date", "ingested_at").agg(F.max("short_interest").alias("short_interest"))
    return j.asof_bitemporal(left, right, "symbol", "trade_date", "max_available", "settlement_date", "ingested_at").select("symbol", "trade_date", "settlement_date", "ingested_at", "short_interest")


QUERIES = {
    "L1_return_labels": lambda s, d: rounded(l.return_labels(frame(s, d, "bars"))),
    "L2_volatility_labels_forward": lambda s, d: rounded(l.forward_volatility(frame(s, d, "bars"))),
    "L3_volatility_labels_trailing": lambda s, d: rounded(l.trailing_volatility(frame(s, d, "bars"))),
    "L4_research_labels": lambda s, d: rounded(labels(s, d)),
    "L5_training_dataset": lambda s, d: rounded(l.training_dataset(feats(s, d), labels(s, d), 5, "rsi_14").select("symbol", "as_of_date", "rsi_14", "target_return")),
    "L6_split_dataset": lambda s, d: l.split_by_date(dated(s, d), "1998-12-31", "1999-12-31").select("symbol", "as_of_date", "split"),
    "L7_split_by_manifest": lambda s, d: l.split_by_manifest(dated(s, d), manifest(s)).select("symbol", "as_of_date", "partition_name"),
    "L8_pit_training_dataset": pit,
    "J5_asof_available_at": pit,
    "L9_research_dataset": lambda s, d: rounded(l.research_dataset(feats(s, d), frame(s, d, "memberships"), labels(s, d).select("symbol", "as_of_date", "return_fwd_5d"), "core", "v1").select("symbol", "as_of_date", "rsi_14", "return_fwd_5d", "dataset_name", "dataset_version")),
    "L10_ranking_frame": lambda s, d: rounded(l.ranking_frame(dated(s, d), 20, 1000, 20000).select("symbol", "as_of_date", "target_return", "relevance", "group_size")),
    "L11_relevance_pct_rank": lambda s, d: l.relevance_pct_rank(labels(s, d).select("symbol", "as_of_date", F.round("return_fwd_5d", 6).alias("target_return"))).select("symbol", "as_of_date", "relevance"),
    "L12_dataset_version_row": lambda s, d: l.dataset_version_row(feats(s, d), "core", "v1"),
    "J3_asof_fundamentals": lambda s, d: rounded(j.asof(feats(s, d).select("symbol", "as_of_date", "company_id"), frame(s, d, "fundamentals").select("company_id", *FUND), ["company_id"], "as_of_date", "effective_as_of_date", ["available_at", "period_end_date", "filing"])),
    "J4_asof_short_interest": bitemporal,
    "J6_interval_membership": lambda s, d: j.interval_membership(dated(s, d), frame(s, d, "memberships"), "symbol", "as_of_date").select("symbol", "as_of_date"),
    "J7_self_range_ttm": lambda s, d: j.trailing_self(frame(s, d, "fundamentals"), "company_id", "period_end_date", "available_at").groupBy("a.filing").agg(F.count("*").alias("n"), F.min("b.period_end_date").alias("first_period")),
    "J8_next_trading_day": lambda s, d: j.next_trading_day(frame(s, d, "articles"), frame(s, d, "days"), "published_at").select("raw_id", "effective_date"),
    "J9_best_identity_lateral": lambda s, d: j.best_identity(frame(s, d, "bars").select("symbol", "bar_date"), frame(s, d, "memberships"), "symbol", "bar_date", [F.col("h_effective_to").isNull().desc(), F.col("h_effective_from").desc_nulls_last(), F.col("h_effective_to").desc_nulls_last()]).select("symbol", "bar_date", F.col("h_effective_from").alias("effective_from")),
    "J10_anti_missing": lambda s, d: j.anti_missing(frame(s, d, "instruments"), frame(s, d, "fundamentals").where("revenue > 400000"), ["company_id"]).select("symbol", "company_id"),
    "J11_not_exists_insert": lambda s, d: j.not_exists_insert(frame(s, d, "memberships").where("effective_from < date'1996-01-01'"), frame(s, d, "memberships"), ["symbol", "effective_to"]).groupBy("symbol").agg(F.count("*").alias("n")),
    "J12_semi_allowed": lambda s, d: j.semi_allowed(frame(s, d, "bars"), frame(s, d, "universe")).groupBy("symbol").agg(F.count("*").alias("n")),
    "J13_label_join": lambda s, d: rounded(j.label_join(feats(s, d).select("symbol", "as_of_date", "rsi_14"), labels(s, d).select("symbol", "as_of_date", "return_fwd_1d").where("return_fwd_1d > 0"), ["symbol", "as_of_date"], True)),
    "J14_overlap_floor_cross": lambda s, d: j.overlap_floor(frame(s, d, "articles"), frame(s, d, "articles").agg(F.max("published_at").alias("watermark")), "published_at", 7).select("raw_id"),
    "J15_alias_text_match": lambda s, d: j.alias_text_match(frame(s, d, "articles"), frame(s, d, "instruments").select("symbol", F.col("symbol").alias("phrase"))).select("raw_id", "symbol", "matched_text"),
    "J16_merge_features_outer": lambda s, d: rounded(
        j.merge_features_outer(
            f.enrich_instrument(frame(s, d, "bars"), frame(s, d, "instruments")).where("instrument_id is not null").select("instrument_id", "as_of_date", "symbol", "company_id", "adj_close"),
            frame(s, d, "short_volume").where("short_volume > 20").join(frame(s, d, "instruments"), "symbol").groupBy("instrument_id", F.col("trade_date").alias("as_of_date"), "symbol", "company_id").agg(F.max("short_volume").alias("short_volume")),
            frame(s, d, "articles").join(frame(s, d, "instruments"), "symbol").groupBy("instrument_id", F.to_date("published_at").alias("as_of_date"), "symbol", F.lit("").alias("company_id")).agg(F.count("*").alias("news_count")),
            frame(s, d, "fundamentals").groupBy("company_id", F.col("effective_as_of_date").alias("as_of_date")).agg(F.max("revenue").alias("revenue")),
        )
    ),
}
_FUNDS = "ORDER BY effective_as_of_date DESC, available_at DESC, period_end_date DESC, filing DESC"
ORACLES = {
    "L1_return_labels": f"{ctes('bars')}, x AS (SELECT symbol, bar_date, " + ", ".join(f"{fwd(h)} AS fwd_return_{h}d" for h in (1, 5, 20)) + f" FROM bars) SELECT symbol, bar_date, {r('fwd_return_1d', 'fwd_return_5d', 'fwd_return_20d')}, " + ", ".join(f"CAST(sign(fwd_return_{h}d) AS INTEGER) AS direction_{h}d" for h in (1, 5, 20)) + " FROM x",
    "L2_volatility_labels_forward": f"{ctes('bars')}, x AS (SELECT *, ln(adj_close / lag(adj_close) {W}) AS lr FROM bars), y AS (SELECT symbol, bar_date, stddev_samp(lr) OVER (PARTITION BY symbol ORDER BY bar_date ROWS BETWEEN 1 FOLLOWING AND 20 FOLLOWING) AS realized_vol_20d_fwd FROM x) SELECT symbol, bar_date, {r('realized_vol_20d_fwd')} FROM y",
    "L3_volatility_labels_trailing": f"{ctes('bars')}, x AS (SELECT *, adj_close / nullif(lag(adj_close) {W}, 0) - 1 AS q FROM bars), y AS (SELECT symbol, bar_date, CASE WHEN count(q) OVER v >= 10 THEN stddev_samp(q) OVER v END AS realized_vol_20d FROM x WINDOW v AS (PARTITION BY symbol ORDER BY bar_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)) SELECT symbol, bar_date, {r('realized_vol_20d')} FROM y",
    "L4_research_labels": f"{ctes('bars')}, {LABELS} SELECT symbol, as_of_date, " + ", ".join(f"round(return_fwd_{h}d, 6) + 0.0 AS return_fwd_{h}d, CASE WHEN return_fwd_{h}d > 0 THEN 1 WHEN return_fwd_{h}d <= 0 THEN 0 END AS target_up_{h}d" for h in (1, 5, 10, 20)) + " FROM labs",
    "L5_training_dataset": f"{FEATS} SELECT f.symbol, f.as_of_date, round(rsi_14, 6) + 0.0 AS rsi_14, round(return_fwd_5d, 6) + 0.0 AS target_return FROM feats f JOIN labs l ON f.symbol = l.symbol AND f.as_of_date = l.as_of_date WHERE rsi_14 IS NOT NULL AND return_fwd_5d IS NOT NULL",
    "L6_split_dataset": f"{ctes('bars')} SELECT symbol, bar_date AS as_of_date, CASE WHEN bar_date <= DATE '1998-12-31' THEN 'train' WHEN bar_date <= DATE '1999-12-31' THEN 'val' ELSE 'test' END AS split FROM bars",
    "L7_split_by_manifest": f"{ctes('bars')}, x AS (SELECT symbol, bar_date AS as_of_date, CASE WHEN bar_date BETWEEN DATE '1995-01-01' AND DATE '1998-12-31' THEN 'train' WHEN bar_date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31' THEN 'valid' WHEN bar_date BETWEEN DATE '2000-02-01' AND DATE '2001-06-30' THEN 'test' END AS partition_name FROM bars) SELECT * FROM x WHERE partition_name IS NOT NULL",
    "L9_research_dataset": f"{FEATS} SELECT f.symbol, f.as_of_date, round(rsi_14, 6) + 0.0 AS rsi_14, round(return_fwd_5d, 6) + 0.0 AS return_fwd_5d, 'core' AS dataset_name, 'v1' AS dataset_version FROM feats f LEFT JOIN labs l ON f.symbol = l.symbol AND f.as_of_date = l.as_of_date WHERE EXISTS (SELECT 1 FROM memberships m WHERE m.symbol = f.symbol AND m.effective_from <= f.as_of_date AND f.as_of_date < coalesce(m.effective_to, DATE '9999-12-31'))",
    "L10_ranking_frame": f"{ctes('bars')}, x AS (SELECT symbol, bar_date AS as_of_date, adj_close, volume, {fwd(20)} AS target_return FROM bars) SELECT symbol, as_of_date, round(target_return, 6) + 0.0 AS target_return, CAST(ntile(5) OVER (PARTITION BY as_of_date ORDER BY target_return, symbol) - 1 AS INTEGER) AS relevance, count(*) OVER (PARTITION BY as_of_date) AS group_size FROM x WHERE adj_close >= 1000 AND adj_close * volume >= 20000 AND target_return IS NOT NULL",
    "L11_relevance_pct_rank": f"{ctes('bars')}, {LABELS}, x AS (SELECT symbol, as_of_date, round(return_fwd_5d, 6) AS t FROM labs) SELECT symbol, as_of_date, CAST(least(floor(CAST(row_number() OVER (PARTITION BY as_of_date ORDER BY t NULLS LAST, symbol) AS DOUBLE) / count(*) OVER (PARTITION BY as_of_date) * 5), 4) AS INTEGER) AS relevance FROM x",
    "L12_dataset_version_row": f"{FEATS} SELECT 'core' AS dataset_name, 'v1' AS dataset_version, count(*) AS row_count, min(as_of_date) AS start_date, max(as_of_date) AS end_date FROM feats",
    "J3_asof_fundamentals": f"{FEATS}, k AS (SELECT symbol, as_of_date, company_id FROM feats) SELECT k.symbol, k.as_of_date, k.company_id, x.effective_as_of_date, x.available_at, x.period_end_date, x.filing, round(x.revenue, 6) + 0.0 AS revenue FROM k LEFT JOIN (SELECT * FROM (SELECT k.symbol AS s, k.as_of_date AS a, u.*, row_number() OVER (PARTITION BY k.symbol, k.as_of_date {_FUNDS}) AS rk FROM k JOIN ({FROM_FUND}) u ON u.company_id = k.company_id AND u.effective_as_of_date <= k.as_of_date) z WHERE rk = 1) x ON x.s = k.symbol AND x.a = k.as_of_date",
    "J4_asof_short_interest": f"{ctes('short_volume', 'short_interest')}, a AS (SELECT symbol, trade_date, max(available_at) AS m FROM short_volume GROUP BY symbol, trade_date), b AS (SELECT symbol, settlement_date, ingested_at, max(short_interest) AS short_interest FROM short_interest GROUP BY symbol, settlement_date, ingested_at), x AS (SELECT a.symbol, a.trade_date, b.settlement_date, b.ingested_at, b.short_interest, row_number() OVER (PARTITION BY a.symbol, a.trade_date ORDER BY b.settlement_date DESC NULLS LAST, b.ingested_at DESC NULLS LAST) AS rk FROM a LEFT JOIN b ON a.symbol = b.symbol AND b.settlement_date <= a.trade_date AND b.ingested_at <= a.m) SELECT symbol, trade_date, settlement_date, ingested_at, short_interest FROM x WHERE rk = 1",
    "J6_interval_membership": f"{ctes('bars', 'memberships')} SELECT symbol, bar_date AS as_of_date FROM bars b WHERE EXISTS (SELECT 1 FROM memberships m WHERE m.symbol = b.symbol AND m.effective_from <= b.bar_date AND b.bar_date < coalesce(m.effective_to, DATE '9999-12-31'))",
    "J7_self_range_ttm": f"{ctes('fundamentals')} SELECT a.filing, count(*) AS n, min(b.period_end_date) AS first_period FROM fundamentals a JOIN fundamentals b ON a.company_id = b.company_id AND b.available_at <= a.available_at AND b.period_end_date <= a.period_end_date AND b.period_end_date > a.period_end_date - INTERVAL '370' DAY GROUP BY a.filing",
    "J8_next_trading_day": f"{ctes('articles', 'days')}, x AS (SELECT raw_id, CASE WHEN CAST(published_at AS TIME) < TIME '09:30:00' THEN CAST(published_at AS DATE) ELSE CAST(CAST(published_at AS DATE) + INTERVAL '1' DAY AS DATE) END AS d FROM articles) SELECT raw_id, (SELECT min(bar_date) FROM days WHERE bar_date >= x.d) AS effective_date FROM x",
    "J9_best_identity_lateral": f"{ctes('bars', 'memberships')}, x AS (SELECT b.symbol, b.bar_date, m.effective_from, row_number() OVER (PARTITION BY b.symbol, b.bar_date ORDER BY CASE WHEN m.effective_to IS NULL THEN 0 ELSE 1 END, m.effective_from DESC NULLS LAST, m.effective_to DESC NULLS LAST) AS rk FROM bars b LEFT JOIN memberships m ON b.symbol = m.symbol AND m.effective_from <= b.bar_date AND b.bar_date <= coalesce(m.effective_to, DATE '9999-12-31')) SELECT symbol, bar_date, effective_from FROM x WHERE rk = 1",
    "J10_anti_missing": f"{ctes('instruments', 'fundamentals')} SELECT symbol, company_id FROM instruments i WHERE NOT EXISTS (SELECT 1 FROM fundamentals u WHERE u.company_id = i.company_id AND u.revenue > 400000)",
    "J11_not_exists_insert": f"{ctes('memberships')} SELECT symbol, count(*) AS n FROM memberships m WHERE NOT EXISTS (SELECT 1 FROM memberships e WHERE e.effective_from < DATE '1996-01-01' AND e.symbol IS NOT DISTINCT FROM m.symbol AND e.effective_to IS NOT DISTINCT FROM m.effective_to) GROUP BY symbol",
    "J12_semi_allowed": f"{ctes('bars', 'universe')} SELECT symbol, count(*) AS n FROM bars WHERE symbol IN (SELECT symbol FROM universe WHERE include_in_universe) GROUP BY symbol",
    "J13_label_join": f"{FEATS} SELECT f.symbol, f.as_of_date, round(rsi_14, 6) + 0.0 AS rsi_14, round(return_fwd_1d, 6) + 0.0 AS return_fwd_1d FROM feats f LEFT JOIN (SELECT * FROM labs WHERE return_fwd_1d > 0) l ON f.symbol = l.symbol AND f.as_of_date = l.as_of_date",
    "J14_overlap_floor_cross": f"{ctes('articles')} SELECT raw_id FROM articles WHERE CAST(published_at AS DATE) >= (SELECT CAST(CAST(max(published_at) AS DATE) - INTERVAL '7' DAY AS DATE) FROM articles)",
    "J15_alias_text_match": f"{ctes('articles', 'instruments')} SELECT a.raw_id, i.symbol, i.symbol AS matched_text FROM articles a JOIN instruments i ON contains(concat(' ', trim(regexp_replace(upper(a.title), '[^A-Z0-9]+', ' ', 'g')), ' '), concat(' ', i.symbol, ' '))",
    "J16_merge_features_outer": f"""{ctes('bars', 'instruments', 'short_volume', 'articles', 'fundamentals')},
      t AS (SELECT i.instrument_id, b.bar_date AS as_of_date, b.symbol, i.company_id, b.adj_close FROM bars b JOIN instruments i ON b.symbol = i.symbol),
      h AS (SELECT i.instrument_id, v.trade_date AS as_of_date, v.symbol, i.company_id, max(v.short_volume) AS short_volume FROM short_volume v JOIN instruments i ON v.symbol = i.symbol WHERE v.short_volume > 20 GROUP BY ALL),
      n AS (SELECT i.instrument_id, CAST(a.published_at AS DATE) AS as_of_date, a.symbol, count(*) AS news_count FROM articles a JOIN instruments i ON a.symbol = i.symbol GROUP BY ALL),
      u AS (SELECT company_id, effective_as_of_date AS as_of_date, max(revenue) AS revenue FROM fundamentals GROUP BY ALL),
      k AS (SELECT instrument_id, as_of_date FROM t UNION SELECT instrument_id, as_of_date FROM h UNION SELECT instrument_id, as_of_date FROM n),
      m AS (SELECT k.instrument_id, k.as_of_date, coalesce(t.symbol, h.symbol, n.symbol) AS symbol, coalesce(t.company_id, h.company_id) AS company_id, t.adj_close, h.short_volume, n.news_count
        FROM k LEFT JOIN t ON k.instrument_id = t.instrument_id AND k.as_of_date = t.as_of_date LEFT JOIN h ON k.instrument_id = h.instrument_id AND k.as_of_date = h.as_of_date LEFT JOIN n ON k.instrument_id = n.instrument_id AND k.as_of_date = n.as_of_date)
      SELECT m.company_id, m.as_of_date, m.instrument_id, m.symbol, round(m.adj_close, 9) + 0.0 AS adj_close, round(m.short_volume, 6) + 0.0 AS short_volume, m.news_count, round(u.revenue, 6) + 0.0 AS revenue FROM m LEFT JOIN u ON m.company_id = u.company_id AND m.as_of_date = u.as_of_date""",
}
ORACLES["L8_pit_training_dataset"] = ORACLES["J5_asof_available_at"] = f"{ctes('bars', 'instruments', 'fundamentals')}, p AS (SELECT b.symbol, b.bar_date, i.company_id FROM bars b JOIN instruments i ON b.symbol = i.symbol), x AS (SELECT p.symbol, p.bar_date, u.filing, row_number() OVER (PARTITION BY p.symbol, p.bar_date ORDER BY u.available_at DESC NULLS LAST, CAST(u.filing AS VARCHAR) DESC) AS rk FROM p LEFT JOIN fundamentals u ON u.company_id = p.company_id AND CAST(u.available_at AS DATE) <= p.bar_date) SELECT symbol, bar_date, filing, filing IS NOT NULL AS matched FROM x WHERE rk = 1"
