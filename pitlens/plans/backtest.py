"""Queries of signals and backtests. Fewer names trade on a date of the test tables than on a market, so `min_names` is lower here."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.windows import ordered, ratio
from ..operators import backtest as b
from ..operators import features as f
from ..operators import labels as l
from ..operators import shorts as h
from .features import BASE, TREND, VOLATILITY, places, rounded
from .inputs import ctes, frame
from .labels import SPLIT, manifest

N = 8


def r(*columns: str) -> str:
    return ", ".join(f"round({x}, {places(x)}) + 0.0 AS {x}" for x in columns)


def scored(s, d, horizon=1):
    every = ordered(["symbol"], "bar_date")
    close = F.col("adj_close")
    bars = frame(s, d, "bars").withColumns({"score": ratio(close, F.lag("adj_close", 20).over(every)) - 1, "target_return": ratio(F.lead("adj_close", horizon).over(every), close) - 1})
    return bars.withColumn("target_return", F.when(F.col("target_return").isNotNull(), F.greatest(F.least("target_return", F.lit(0.9)), F.lit(-0.9)))).withColumnRenamed("bar_date", "as_of_date")


def signals(s, d):
    bars, names = frame(s, d, "bars"), frame(s, d, "instruments")
    rows = f.trend(bars, names).select("symbol", "as_of_date", "sma_20", "sma_50", "sma_200").join(f.momentum(bars, names).select("symbol", "as_of_date", "rsi_14"), ["symbol", "as_of_date"])
    shorts = h.short_rolling(h.short_daily(frame(s, d, "short_volume"))).select("symbol", "as_of_date", "short_volume_ratio")
    return rows.join(shorts, ["symbol", "as_of_date"], "left")


def tested(s, d):
    rows = signals(s, d).join(scored(s, d).select("symbol", "as_of_date", F.col("target_return").alias("fwd_return_1d")), ["symbol", "as_of_date"])
    return l.split_by_manifest(rows, manifest(s))


def on_scored(make, horizon=1):
    return lambda s, d: rounded(make(scored(s, d, horizon)))


def signal(column):
    return lambda s, d: rounded(signals(s, d).select("symbol", "as_of_date", column().alias("signal_value")))


def crossed(s, d):
    return tested(s, d).withColumn("signal_value", b.signal_sma_cross(F.col("sma_20"), F.col("sma_50")))


def performance(s, d):
    results = b.signal_backtest(crossed(s, d)).select(F.lit("cross").alias("backtest_name"), "partition_name", "n_obs")
    return b.signal_performance(results.where("partition_name = 'train'"), results)


def factors(s, d):
    v = f.volatility(frame(s, d, "bars"), frame(s, d, "instruments")).select("symbol", "as_of_date", "volatility_20d")
    return scored(s, d).withColumnRenamed("score", "returns_20d").join(v, ["symbol", "as_of_date"]).join(signals(s, d).select("symbol", "as_of_date", "short_volume_ratio"), ["symbol", "as_of_date"])


def prices(s, d):
    return frame(s, d, "bars").select("symbol", F.col("bar_date").alias("price_date"), F.col("adj_close").alias("close"), "volume")


METRICS = ["avg_gross", "gross_return", "total_cost", "net_return", "avg_net", "volatility", "turnover", "sharpe"]
QUERIES = {
    "B1_signal_short_ratio": signal(lambda: b.signal_short_ratio(F.col("short_volume_ratio"), 0.5)),
    "B2_signal_rsi": signal(lambda: b.signal_rsi(F.col("rsi_14"))),
    "B3_signal_sma_cross": signal(lambda: b.signal_sma_cross(F.col("sma_20"), F.col("sma_50"))),
    "B4_signal_sma_cross_rsi": signal(lambda: b.signal_sma_cross_rsi(F.col("sma_20"), F.col("sma_50"), F.col("rsi_14"), 60.0)),
    "B6_signal_backtest": lambda s, d: rounded(b.signal_backtest(crossed(s, d))),
    "A7_strategy_metrics": lambda s, d: rounded(b.signal_backtest(tested(s, d).withColumn("signal_value", b.signal_rsi(F.col("rsi_14"), 40.0)), 25.0)),
    "B7_signal_grid": lambda s, d: rounded(b.signal_grid(tested(s, d), [(20, 50), (20, 200), (50, 200)])),
    "B8_signal_performance": performance,
    "B9_decile_long_short": on_scored(lambda x: b.decile_long_short(x, 0.2, min_names=N)),
    "B10_zscore_reversal": on_scored(lambda x: b.summarize(b.zscore_reversal(x, 0.2, N))),
    "B11_multifactor_alpha": lambda s, d: rounded(b.multifactor_alpha(factors(s, d), 0.2, N)),
    "B12_alpha_weighted": on_scored(lambda x: b.alpha_weighted(x, N)),
    "B13_zscore_weighted_buckets": on_scored(lambda x: b.zscore_weighted_buckets(x, 0.2, N)),
    "B14_ranker_portfolio": on_scored(lambda x: b.ranker_portfolio(b.ranker_book(x, 0.2, N))),
    "B15_long_only_next_day": on_scored(lambda x: b.long_only_next_day(x, 0.2, min_dollar_volume=10000, deny=("S3",), min_names=N).drop("capital")),
    "B16_overlapping_sleeves": on_scored(lambda x: b.overlapping_sleeves(x, 5, 0.2, min_names=N).drop("capital"), 5),
    "B17_price_only_momentum": lambda s, d: rounded(b.price_only_momentum(prices(s, d), 3, 900, 5)),
    "B18_return_series_metrics": on_scored(lambda x: b.return_series_metrics(b.decile_long_short(x, 0.2, min_names=N).withColumn("r", F.col("long") * 0.01), "r").drop("total_return", "cagr")),
}


def sc(h: int) -> str:
    w = "OVER (PARTITION BY symbol ORDER BY bar_date)"
    return ctes("bars", "instruments", "short_volume") + f""",
s0 AS (SELECT symbol, bar_date AS as_of_date, adj_close, volume, adj_close / nullif(lag(adj_close, 20) {w}, 0) - 1 AS score, lead(adj_close, {h}) {w} / nullif(adj_close, 0) - 1 AS raw FROM bars),
scored AS (SELECT *, CASE WHEN raw IS NOT NULL THEN greatest(least(raw, 0.9), -0.9) END AS target_return FROM s0)"""


def section(source: str, share: float) -> str:
    return f""", c0 AS (SELECT *, count(*) OVER (PARTITION BY as_of_date) AS n FROM {source} WHERE score IS NOT NULL AND target_return IS NOT NULL),
c1 AS (SELECT *, row_number() OVER (PARTITION BY as_of_date ORDER BY score, symbol) AS up, (score - avg(score) OVER (PARTITION BY as_of_date)) / nullif(stddev_samp(score) OVER (PARTITION BY as_of_date), 0) AS z, score - avg(score) OVER (PARTITION BY as_of_date) AS al FROM c0 WHERE n >= {N}),
cs AS (SELECT *, n - up + 1 AS down, CAST(floor(n * {share}) AS BIGINT) AS k0, greatest(CAST(floor(n * {share}) AS BIGINT), 1) AS k FROM c1)"""


S1 = sc(1) + section("scored", 0.2)
_LS = "dl AS (SELECT as_of_date, avg(CASE WHEN down <= k0 THEN target_return END) AS long, avg(CASE WHEN up <= k0 THEN target_return END) AS short FROM cs GROUP BY as_of_date)"
SIG = ctes("bars", "instruments", "short_volume") + f""",
{BASE}, {TREND}, mv AS (SELECT *, CASE WHEN prev IS NOT NULL THEN greatest(adj_close - prev, 0.0) END AS gain, CASE WHEN prev IS NOT NULL THEN greatest(prev - adj_close, 0.0) END AS loss FROM base),
rs AS (SELECT symbol, as_of_date, rn, avg(gain) OVER q AS g, avg(loss) OVER q AS l FROM mv WINDOW q AS (PARTITION BY symbol ORDER BY as_of_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)),
sv AS (SELECT symbol, trade_date, sum(short_volume) / nullif(sum(total_volume), 0) AS short_volume_ratio FROM short_volume GROUP BY symbol, trade_date),
sg AS (SELECT t.symbol, t.as_of_date, t.sma_20, t.sma_50, t.sma_200, CASE WHEN rs.rn >= 15 THEN CASE WHEN g = 0 AND l = 0 THEN 50.0 WHEN l = 0 THEN 100.0 ELSE 100 - 100 / (1 + g / l) END END AS rsi_14, sv.short_volume_ratio
  FROM trend t JOIN rs ON t.symbol = rs.symbol AND t.as_of_date = rs.as_of_date LEFT JOIN sv ON sv.symbol = t.symbol AND sv.trade_date = t.as_of_date)"""
_PART = " ".join(f"WHEN s.as_of_date BETWEEN DATE '{SPLIT[p + '_start']}' AND DATE '{SPLIT[p + '_end']}' THEN '{p}'" for p in ("train", "valid", "test"))
TEST = SIG + f""", fw AS (SELECT symbol, bar_date, lead(adj_close) OVER (PARTITION BY symbol ORDER BY bar_date) / nullif(adj_close, 0) - 1 AS raw FROM bars),
ts AS (SELECT * FROM (SELECT s.*, CASE WHEN raw IS NOT NULL THEN greatest(least(raw, 0.9), -0.9) END AS fwd_return_1d, CASE {_PART} END AS partition_name FROM sg s JOIN fw ON fw.symbol = s.symbol AND fw.bar_date = s.as_of_date) q WHERE partition_name IS NOT NULL)"""


def _z(column: str) -> str:
    return f"(({column} - avg({column}) OVER (PARTITION BY as_of_date)) / nullif(stddev_samp({column}) OVER (PARTITION BY as_of_date), 0))"


def cross(f_: str, s_: str) -> str:
    return f"CASE WHEN {f_} IS NOT NULL AND {s_} IS NOT NULL THEN CAST({f_} > {s_} AS DOUBLE) END"


def metrics(value: str, bps: float, keys: str = "partition_name", inner: str = "symbol", source: str = "ts") -> str:
    return f""", p0 AS (SELECT *, CASE WHEN {value} > 0 THEN 1.0 ELSE 0.0 END AS active FROM {source}), p1 AS (SELECT *, abs(active - lag(active, 1, 0.0) OVER (PARTITION BY {inner} ORDER BY as_of_date)) AS tv FROM p0),
p2 AS (SELECT *, active * fwd_return_1d AS gross, tv * {bps} / 10000 AS cost FROM p1 WHERE fwd_return_1d IS NOT NULL), p3 AS (SELECT *, gross - cost AS net FROM p2),
p4 AS (SELECT {keys}, avg(gross) AS avg_gross, sum(gross) AS gross_return, sum(cost) AS total_cost, sum(net) AS net_return, avg(net) AS avg_net, stddev_samp(net) AS volatility, avg(tv) AS turnover, count(*) AS n_obs, avg(net) / nullif(stddev_samp(net), 0) AS sharpe FROM p3 GROUP BY {keys})
SELECT {keys}, {r(*METRICS)}, n_obs FROM p4"""


def turn(book: str) -> str:
    return f""", dy AS (SELECT as_of_date, row_number() OVER (ORDER BY as_of_date) AS i FROM (SELECT DISTINCT as_of_date FROM {book}) q), bk AS (SELECT d.i, b.symbol, b.weight FROM {book} b JOIN dy d ON d.as_of_date = b.as_of_date),
tn AS (SELECT i, sum(abs(w)) AS turnover FROM (SELECT i, symbol, sum(w) AS w FROM (SELECT i, symbol, weight AS w FROM bk UNION ALL SELECT i + 1, symbol, -weight FROM bk) x GROUP BY i, symbol) y GROUP BY i), tv AS (SELECT as_of_date, turnover FROM tn JOIN dy ON dy.i = tn.i)"""


ORACLES = {
    "B1_signal_short_ratio": f"{SIG} SELECT symbol, as_of_date, round(CASE WHEN short_volume_ratio IS NOT NULL THEN CASE WHEN short_volume_ratio >= 0.5 THEN short_volume_ratio ELSE 0 END END, 6) + 0.0 AS signal_value FROM sg",
    "B2_signal_rsi": f"{SIG} SELECT symbol, as_of_date, CASE WHEN rsi_14 IS NOT NULL THEN CAST(rsi_14 <= 30 AS DOUBLE) END AS signal_value FROM sg",
    "B3_signal_sma_cross": f"{SIG} SELECT symbol, as_of_date, {cross('sma_20', 'sma_50')} AS signal_value FROM sg",
    "B4_signal_sma_cross_rsi": f"{SIG} SELECT symbol, as_of_date, CASE WHEN sma_20 IS NOT NULL AND sma_50 IS NOT NULL AND rsi_14 IS NOT NULL THEN CAST(sma_20 > sma_50 AND rsi_14 <= 60 AS DOUBLE) END AS signal_value FROM sg",
    "B6_signal_backtest": TEST + metrics(cross("sma_20", "sma_50"), 10),
    "A7_strategy_metrics": TEST + metrics("CASE WHEN rsi_14 <= 40 THEN 1 ELSE 0 END", 25),
    "B7_signal_grid": TEST + ", gd AS (SELECT * FROM (SELECT *, unnest([20, 20, 50]) AS fast, unnest([50, 200, 200]) AS slow FROM ts) q), g2 AS (SELECT *, CASE fast WHEN 20 THEN sma_20 ELSE sma_50 END AS a, CASE slow WHEN 50 THEN sma_50 ELSE sma_200 END AS b FROM gd)" + metrics("CASE WHEN a > b THEN 1 ELSE 0 END", 10, "fast, slow, partition_name", "fast, slow, symbol", "g2"),
    "B8_signal_performance": f"{TEST} SELECT 'cross' AS backtest_name, partition_name, count(*) AS n_obs FROM ts WHERE fwd_return_1d IS NOT NULL GROUP BY partition_name",
    "B9_decile_long_short": f"{S1}, {_LS} SELECT as_of_date, {r('long', 'short')}, round(long - short, 6) + 0.0 AS long_short FROM dl",
    "B10_zscore_reversal": f"{S1}, {_LS}, x AS (SELECT short - long AS ls FROM dl) SELECT count(ls) AS days, round(avg(ls), 6) + 0.0 AS mean_ls, round(avg(ls) / nullif(stddev_samp(ls), 0), 6) + 0.0 AS sharpe_ls FROM x",
    "B11_multifactor_alpha": sc(1) + f""", {BASE}, {VOLATILITY}, sv AS (SELECT symbol, trade_date, sum(short_volume) / nullif(sum(total_volume), 0) AS q FROM short_volume GROUP BY symbol, trade_date),
mf AS (SELECT s.symbol, s.as_of_date, s.target_return, s.score AS a, v.volatility_20d AS b, sv.q AS c FROM scored s JOIN volatility v ON v.symbol = s.symbol AND v.as_of_date = s.as_of_date JOIN sv ON sv.symbol = s.symbol AND sv.trade_date = s.as_of_date WHERE s.score IS NOT NULL AND s.target_return IS NOT NULL AND v.volatility_20d IS NOT NULL AND sv.q IS NOT NULL),
mz AS (SELECT symbol, as_of_date, target_return, {_z('c')} - {_z('a')} - {_z('b')} AS score FROM mf)""" + section("mz", 0.2) + f", {_LS} SELECT as_of_date, {r('long', 'short')}, round(long - short, 6) + 0.0 AS long_short FROM dl",
    "B12_alpha_weighted": f"{S1} SELECT as_of_date, round(sum(al * target_return) / nullif(sum(abs(al)), 0), 6) + 0.0 AS long_short FROM cs GROUP BY as_of_date",
    "B13_zscore_weighted_buckets": f"{S1}, x AS (SELECT as_of_date, sum(CASE WHEN down <= k THEN z * target_return END) / nullif(sum(CASE WHEN down <= k THEN abs(z) END), 0) AS long, sum(CASE WHEN up <= k THEN z * target_return END) / nullif(sum(CASE WHEN up <= k THEN abs(z) END), 0) AS short FROM cs GROUP BY as_of_date) SELECT as_of_date, {r('long', 'short')}, round(long - short, 6) + 0.0 AS long_short FROM x",
    "B14_ranker_portfolio": S1 + ", sd AS (SELECT *, CASE WHEN down <= k THEN 1 WHEN up <= k THEN -1 END AS side FROM cs), s2 AS (SELECT *, greatest(z * side, 0) AS part FROM sd WHERE side IS NOT NULL), book AS (SELECT as_of_date, symbol, target_return, side * part / (sum(part) OVER (PARTITION BY as_of_date, side) + 1e-9) AS weight FROM s2)" + turn("book") + f""", dd AS (SELECT b.as_of_date, count(*) AS selected_count, sum(weight * target_return) AS gross, avg(CASE WHEN weight * target_return > 0 THEN 1.0 ELSE 0.0 END) AS hit_rate FROM book b GROUP BY b.as_of_date), d2 AS (SELECT dd.*, turnover, gross - turnover * 10 / 10000 AS net FROM dd JOIN tv ON tv.as_of_date = dd.as_of_date) SELECT as_of_date, selected_count, {r('gross', 'hit_rate', 'turnover', 'net')} FROM d2""",
    "B15_long_only_next_day": sc(1) + ", sb AS (SELECT symbol, as_of_date, score, CASE WHEN target_return IS NOT NULL THEN greatest(least(target_return, 0.5), -0.5) END AS target_return FROM scored WHERE adj_close >= 5 AND adj_close * volume >= 10000 AND symbol <> 'S3')" + section("sb", 0.2) + ", book AS (SELECT as_of_date, symbol, target_return, CAST(1 AS DOUBLE) / count(*) OVER (PARTITION BY as_of_date) AS weight FROM cs WHERE down <= k)" + turn("book") + f""", dd AS (SELECT as_of_date, sum(weight * target_return) AS gross, count(*) AS names FROM book GROUP BY as_of_date), d2 AS (SELECT dd.*, turnover, gross - turnover * 20 / 10000 AS net FROM dd JOIN tv ON tv.as_of_date = dd.as_of_date) SELECT as_of_date, names, {r('gross', 'turnover', 'net')} FROM d2""",
    "B16_overlapping_sleeves": sc(5) + section("scored", 0.2) + ", sl AS (SELECT as_of_date, avg(target_return) - 0.002 AS sleeve FROM cs WHERE down <= k GROUP BY as_of_date), dd AS (SELECT DISTINCT as_of_date FROM scored WHERE score IS NOT NULL AND target_return IS NOT NULL) SELECT dd.as_of_date, round(coalesce(sum(sleeve) OVER (ORDER BY dd.as_of_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 0) / 5, 6) + 0.0 AS net FROM dd LEFT JOIN sl ON sl.as_of_date = dd.as_of_date",
    "B17_price_only_momentum": ctes("bars") + f""", x AS (SELECT symbol, bar_date AS price_date, adj_close AS close, volume, lag(adj_close, 20) OVER w AS lg, lead(adj_close, 1) OVER w AS t1, lead(adj_close, 2) OVER w AS t2 FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY bar_date)), y AS (SELECT *, close / nullif(lg, 0) - 1 AS m, t2 / nullif(t1, 0) - 1 AS q FROM x WHERE lg IS NOT NULL AND t2 IS NOT NULL AND close >= 900 AND volume >= 5),
z AS (SELECT *, row_number() OVER (PARTITION BY price_date ORDER BY m DESC NULLS LAST, symbol) AS a, row_number() OVER (PARTITION BY price_date ORDER BY m NULLS LAST, symbol) AS b FROM y), o AS (SELECT price_date, avg(CASE WHEN a <= 3 THEN q END) AS long_ret, avg(CASE WHEN b <= 3 THEN q END) AS short_ret, avg(q) AS universe_ret, count(*) AS universe_names FROM z GROUP BY price_date HAVING count(*) >= 3)
SELECT price_date, {r('long_ret', 'short_ret', 'universe_ret')}, universe_names, round(long_ret - short_ret, 6) + 0.0 AS long_short_spread_ret FROM o""",
    "B18_return_series_metrics": f"""{S1}, {_LS}, q AS (SELECT as_of_date, long * 0.01 AS r FROM dl WHERE long IS NOT NULL), e AS (SELECT *, exp(sum(ln(1 + r)) OVER (ORDER BY as_of_date ROWS UNBOUNDED PRECEDING)) AS capital FROM q), g AS (SELECT *, capital / max(capital) OVER (ORDER BY as_of_date ROWS UNBOUNDED PRECEDING) - 1 AS fall FROM e)
SELECT count(*) AS days, round(avg(r), 6) + 0.0 AS mean_daily, round(stddev_samp(r), 6) + 0.0 AS vol_daily, round(avg(r) / stddev_samp(r) * sqrt(252), 6) + 0.0 AS sharpe_annualized, round(min(fall), 6) + 0.0 AS max_drawdown, round(avg(CASE WHEN r > 0 THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS win_rate FROM g""",
}
