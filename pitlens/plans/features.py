"""Queries of the price features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as f
from .inputs import ctes, frame


#: Prices and ratios are quotients of short decimals; nine places keep them clear of ties.
PRICES = {"adj_close", "adj_open", "adj_high", "adj_low", "close", "latest_close", "open", "high", "low", "short_interest_pct_float", "short_volume_ratio", "short_volume_ratio_20d_avg", "short_volume_20d_avg", "days_to_cover", "short_interest_change_pct"}


def places(column: str) -> int:
    return 9 if column in PRICES else 6


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to a few places, as engines sum in different orders; negative zero as zero."""
    return df.select(*((F.round(df[c], places(c)) + F.lit(0.0)).alias(c) if t == "double" else df[c] for c, t in df.dtypes))


def select_rounded(columns: list[str], source: str, keys: list[str]) -> str:
    return f"SELECT {', '.join([*keys, *(f'round({c}, {places(c)}) + 0.0 AS {c}' for c in columns)])} FROM {source}"


BASE = """base AS (
  SELECT b.symbol, i.instrument_id, i.company_id, b.bar_date AS as_of_date, b.adj_open, b.adj_high, b.adj_low, b.adj_close, b.volume,
    row_number() OVER w AS rn, lag(b.adj_close) OVER w AS prev
  FROM bars b LEFT JOIN instruments i ON b.symbol = i.symbol WINDOW w AS (PARTITION BY b.symbol ORDER BY b.bar_date))"""


def over(n: int) -> str:
    return f"OVER (PARTITION BY symbol ORDER BY as_of_date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


ALL = "OVER (PARTITION BY symbol ORDER BY as_of_date)"
RSI = "CASE WHEN {g} = 0 AND {l} = 0 THEN 50.0 WHEN {l} = 0 THEN 100.0 ELSE 100 - 100 / (1 + {g} / {l}) END"

MOMENTUM = f"""{BASE},
moves AS (SELECT *, CASE WHEN prev IS NOT NULL THEN greatest(adj_close - prev, 0.0) END AS gain, CASE WHEN prev IS NOT NULL THEN greatest(prev - adj_close, 0.0) END AS loss,
  {', '.join(f'adj_close / nullif(lag(adj_close, {k}) {ALL}, 0) - 1 AS r{k}' for k in (1, 5, 10, 20, 60))} FROM base),
stats AS (SELECT *, lag(r20, 20) {ALL} AS r20_before, avg(gain) {over(14)} AS g, avg(loss) {over(14)} AS l, max(adj_high) {over(14)} AS h14, min(adj_low) {over(14)} AS l14, max(adj_close) {over(252)} AS h252 FROM moves),
momentum AS (SELECT *, r1 AS returns_1d, r5 AS returns_5d, r10 AS returns_10d, r20 AS returns_20d, r60 AS returns_60d, CASE WHEN adj_close > 0 AND prev > 0 THEN ln(adj_close / prev) END AS returns_log_1d,
  r20 AS momentum_20d, CASE WHEN rn >= 41 THEN r20 - r20_before END AS momentum_acceleration_20d, CASE WHEN rn >= 15 THEN {RSI.format(g='g', l='l')} END AS rsi_14,
  CASE WHEN rn >= 14 THEN -100 * (h14 - adj_close) / nullif(h14 - l14, 0) END AS williams_r_14, CASE WHEN rn >= 14 THEN 100 * (adj_close - l14) / nullif(h14 - l14, 0) END AS stoch_k_14,
  CASE WHEN rn >= 252 THEN adj_close / nullif(h252, 0) - 1 END AS distance_from_252d_high FROM stats)"""

TREND = f"""means AS (SELECT *, {', '.join(f'avg(adj_close) {over(n)} AS m{n}' for n in (12, 20, 26, 50, 200))}, lag(adj_close, 20) {ALL} AS c20, lag(adj_close, 50) {ALL} AS c50 FROM base),
lines AS (SELECT *, avg(m12 - m26) {over(9)} AS sig FROM means),
trend AS (SELECT *, {', '.join(f'CASE WHEN rn >= {n} THEN m{n} END AS sma_{n}, CASE WHEN rn >= {n} THEN adj_close / nullif(m{n}, 0) END AS close_to_sma_{n}' for n in (20, 50, 200))},
  CASE WHEN rn >= 12 THEN m12 END AS ema_12, CASE WHEN rn >= 26 THEN m26 END AS ema_26, CASE WHEN rn >= 26 THEN m12 - m26 END AS macd_line, CASE WHEN rn >= 34 THEN sig END AS macd_signal,
  CASE WHEN rn >= 34 THEN m12 - m26 - sig END AS macd_hist, adj_close / nullif(c20, 0) - 1 AS slope_20d, adj_close / nullif(c50, 0) - 1 AS slope_50d,
  CASE WHEN rn >= 200 THEN CASE WHEN adj_close > m20 AND m20 > m50 AND m50 > m200 THEN 1.0::DOUBLE WHEN adj_close < m20 AND m20 < m50 AND m50 < m200 THEN -1.0::DOUBLE ELSE 0.0::DOUBLE END END AS trend_strength FROM lines)"""

VOLATILITY = f"""logs AS (SELECT *, greatest(adj_high - adj_low, abs(adj_high - coalesce(prev, adj_close)), abs(adj_low - coalesce(prev, adj_close))) AS tr, CASE WHEN prev > 0 AND adj_close > 0 THEN ln(adj_close / prev) END AS lr,
  ln(adj_high / adj_low) AS hl, ln(adj_close / adj_open) AS co FROM base),
vols AS (SELECT *, avg(tr) {over(14)} AS atr, {', '.join(f'stddev_samp(lr) {over(n)} AS v{n}' for n in (5, 10, 20, 60))}, avg(hl * hl) {over(20)} AS hl2, avg(0.5 * hl * hl - (2 * ln(2) - 1) * co * co) {over(20)} AS gk,
  avg(adj_close) {over(20)} AS mean, stddev_samp(adj_close) {over(20)} AS sd FROM logs),
volatility AS (SELECT *, CASE WHEN rn >= 14 THEN atr END AS atr_14, CASE WHEN rn >= 14 THEN atr / nullif(adj_close, 0) END AS atr_pct_14, {', '.join(f'CASE WHEN rn >= {n + 1} THEN v{n} END AS volatility_{n}d' for n in (5, 10, 20, 60))},
  CASE WHEN rn >= 21 THEN v20 * sqrt(252) END AS realized_vol_20d, CASE WHEN rn >= 20 THEN sqrt(hl2 / (4 * ln(2))) * sqrt(252) END AS parkinson_vol_20d, CASE WHEN rn >= 20 AND gk >= 0 THEN sqrt(gk) * sqrt(252) END AS garman_klass_vol_20d,
  CASE WHEN rn >= 20 THEN (adj_close - mean) / nullif(sd, 0) END AS bollinger_zscore_20, CASE WHEN rn >= 20 THEN 4 * sd / nullif(mean, 0) END AS bollinger_bandwidth_20 FROM vols)"""

BARS = ctes("bars", "instruments")
SHORT_KEYS = ["symbol", "as_of_date"]
GROUPS = {
    "F1_returns": ("momentum", f.MOMENTUM[:5]),
    "F2_returns_log": ("momentum", ["returns_log_1d"]),
    "F3_momentum": ("momentum", ["momentum_20d", "momentum_acceleration_20d"]),
    "F4_rsi": ("momentum", ["rsi_14"]),
    "F5_williams_stoch": ("momentum", ["williams_r_14", "stoch_k_14"]),
    "F6_distance_from_high": ("momentum", ["distance_from_252d_high"]),
    "F7_sma": ("trend", ["sma_20", "sma_50", "sma_200"]),
    "F8_close_to_sma": ("trend", ["close_to_sma_20", "close_to_sma_50", "close_to_sma_200"]),
    "F9_ema_proxy": ("trend", ["ema_12", "ema_26"]),
    "F10_macd": ("trend", ["macd_line", "macd_signal", "macd_hist"]),
    "F11_slope": ("trend", ["slope_20d", "slope_50d"]),
    "F12_trend_strength": ("trend", ["trend_strength"]),
    "F13_atr": ("volatility", ["atr_14", "atr_pct_14"]),
    "F14_volatility": ("volatility", ["volatility_5d", "volatility_10d", "volatility_20d", "volatility_60d"]),
    "F15_realized_vol": ("volatility", ["realized_vol_20d"]),
    "F16_parkinson": ("volatility", ["parkinson_vol_20d"]),
    "F17_garman_klass": ("volatility", ["garman_klass_vol_20d"]),
    "F18_bollinger": ("volatility", ["bollinger_zscore_20", "bollinger_bandwidth_20"]),
}
SQL_OF = {"momentum": MOMENTUM, "trend": f"{BASE},\n{TREND}", "volatility": f"{BASE},\n{VOLATILITY}"}


def group_query(kind: str, columns: list[str]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        made = getattr(f, kind)(frame(spark, sf_dir, "bars"), frame(spark, sf_dir, "instruments"))
        return rounded(made.select(*SHORT_KEYS, *columns))

    return run


def on_bars(make):
    return lambda spark, sf_dir: rounded(make(frame(spark, sf_dir, "bars")))


def research_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars, names = frame(spark, sf_dir, "bars"), frame(spark, sf_dir, "instruments")
    return f.research_features_daily(bars, names)


def technical(spark: SparkSession, sf_dir: str) -> DataFrame:
    allowed = frame(spark, sf_dir, "universe").where("include_in_universe")
    return rounded(f.technical_features(frame(spark, sf_dir, "bars"), frame(spark, sf_dir, "instruments"), allowed))


def pack(n: int) -> str:
    return f"OVER (PARTITION BY symbol ORDER BY bar_date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


QUERIES = {name: group_query(*spec) for name, spec in GROUPS.items()} | {
    "J1_enrich_instrument": lambda s, d: rounded(f.enrich_instrument(frame(s, d, "bars"), frame(s, d, "instruments")).select(*f.KEYS, "adj_close")),
    "F19_mean_reversion_pack": on_bars(f.mean_reversion_pack),
    "F20_volume_pack": on_bars(f.volume_pack),
    "F21_volatility_regime": on_bars(f.volatility_regime),
    "F22_trend_pack": on_bars(f.trend_pack),
    "F23_technical_features": technical,
    "F24_research_features_daily": lambda s, d: rounded(research_features(s, d)),
    "J2_join_feature_groups": lambda s, d: rounded(f.research_features(*(make(frame(s, d, "bars"), frame(s, d, "instruments")) for make in (f.momentum, f.trend, f.volatility))).select(*SHORT_KEYS, "rsi_14", "sma_50", "volatility_20d")),
}
_FULL = f"{BARS},\n{MOMENTUM},\n{TREND},\n{VOLATILITY}"
_JOINED = "momentum m LEFT JOIN trend t ON m.symbol = t.symbol AND m.as_of_date = t.as_of_date LEFT JOIN volatility v ON m.symbol = v.symbol AND m.as_of_date = v.as_of_date"
_ALLBAR = "OVER (PARTITION BY symbol ORDER BY bar_date)"
ORACLES = {name: f"{BARS},\n{SQL_OF[kind]}\n{select_rounded(columns, kind, SHORT_KEYS)}" for name, (kind, columns) in GROUPS.items()} | {
    "J1_enrich_instrument": f"{BARS},\n{BASE} {select_rounded(['adj_close'], 'base', f.KEYS)}",
    "F19_mean_reversion_pack": f"""{ctes('bars')}, s AS (SELECT *, avg(adj_close) {pack(20)} AS m, stddev_samp(adj_close) {pack(20)} AS sd FROM bars),
      z AS (SELECT symbol, bar_date, (adj_close - m) / nullif(sd, 0) AS price_zscore, m + 2 * sd AS bb_upper, m - 2 * sd AS bb_lower, (adj_close - (m - 2 * sd)) / nullif((m + 2 * sd) - (m - 2 * sd), 0) AS bb_position FROM s)
      {select_rounded(['price_zscore', 'bb_upper', 'bb_lower', 'bb_position'], 'z', ['symbol', 'bar_date'])}""",
    "F20_volume_pack": f"""{ctes('bars')}, s AS (SELECT *, avg(volume) {pack(20)} AS m, stddev_samp(volume) {pack(20)} AS sd, coalesce(sign(adj_close - lag(adj_close) {_ALLBAR}), 0) * volume AS signed FROM bars),
      z AS (SELECT symbol, bar_date, volume / nullif(m, 0) AS volume_ratio, (volume - m) / nullif(sd, 0) AS volume_zscore, CAST(sum(signed) OVER (PARTITION BY symbol ORDER BY bar_date ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS obv FROM s)
      {select_rounded(['volume_ratio', 'volume_zscore', 'obv'], 'z', ['symbol', 'bar_date'])}""",
    "F21_volatility_regime": f"""{ctes('bars')}, s AS (SELECT *, stddev_samp(adj_close) {pack(20)} AS sd FROM bars), t AS (SELECT *, avg(sd) {pack(100)} AS m FROM s)
      SELECT symbol, bar_date, CASE WHEN sd > m THEN 1 ELSE 0 END AS volatility_regime FROM t""",
    "F22_trend_pack": f"""{ctes('bars')}, s AS (SELECT *, avg(adj_close) {pack(20)} AS a, avg(adj_close) {pack(50)} AS b, avg(adj_close) {pack(200)} AS c, avg(adj_high - adj_low) {pack(14)} AS atr_14 FROM bars),
      z AS (SELECT symbol, bar_date, a - lag(a, 20) {_ALLBAR} AS slope_20d, b - lag(b, 50) {_ALLBAR} AS slope_50d, (a - c) / nullif(c, 0) AS trend_strength, atr_14 FROM s)
      {select_rounded(['slope_20d', 'slope_50d', 'trend_strength', 'atr_14'], 'z', ['symbol', 'bar_date'])}""",
    "F23_technical_features": f"""{ctes('bars', 'instruments', 'universe')}, {BASE.replace('FROM bars b', 'FROM (SELECT * FROM bars WHERE symbol IN (SELECT symbol FROM universe WHERE include_in_universe)) b')},
      m AS (SELECT *, greatest(coalesce(adj_close - prev, 0), 0) AS gain, greatest(coalesce(prev - adj_close, 0), 0) AS loss FROM base),
      s AS (SELECT *, avg(adj_close) {over(20)} AS a, avg(gain) {over(14)} AS g, avg(loss) {over(14)} AS l FROM m),
      z AS (SELECT *, adj_close / nullif(a, 0) - 1 AS close_to_sma_20, {RSI.format(g='g', l='l')} AS rsi_14 FROM s) {select_rounded(['close_to_sma_20', 'rsi_14'], 'z', f.KEYS)}""",
    "F24_research_features_daily": f"""{_FULL}, z AS (SELECT m.*, {', '.join('t.' + c for c in f.TREND)}, {', '.join('v.' + c for c in f.VOLATILITY)} FROM {_JOINED})
      SELECT {', '.join(f.KEYS)}, {', '.join(f'round({c}, {places(c)}) + 0.0 AS {c}' for c in ['adj_close', *f.MOMENTUM, *f.TREND, *f.VOLATILITY])}, CAST(NULL AS DOUBLE) AS short_volume_ratio, CAST(NULL AS DOUBLE) AS short_interest, CAST(NULL AS DOUBLE) AS days_to_cover FROM z""",
    "J2_join_feature_groups": f"{_FULL} SELECT m.symbol, m.as_of_date, round(m.rsi_14, 6) + 0.0 AS rsi_14, round(t.sma_50, 6) + 0.0 AS sma_50, round(v.volatility_20d, 6) + 0.0 AS volatility_20d FROM {_JOINED}",
}
