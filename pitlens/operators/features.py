"""Price features: windows by symbol over daily bars. Every value uses its row and earlier ones only.

Bars have symbol, bar_date, adj_open, adj_high, adj_low, adj_close, volume. All features of one
function share a single partitioning and sort, so a build costs one shuffle of the bars.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.windows import ordered, ratio, trailing, warm

KEYS = ["instrument_id", "company_id", "symbol", "as_of_date"]
MOMENTUM = ["returns_1d", "returns_5d", "returns_10d", "returns_20d", "returns_60d", "returns_log_1d", "momentum_20d", "momentum_acceleration_20d", "rsi_14", "williams_r_14", "stoch_k_14", "distance_from_252d_high"]
TREND = ["sma_20", "sma_50", "sma_200", "close_to_sma_20", "close_to_sma_50", "close_to_sma_200", "ema_12", "ema_26", "macd_line", "macd_signal", "macd_hist", "slope_20d", "slope_50d", "trend_strength"]
VOLATILITY = ["atr_14", "atr_pct_14", "volatility_5d", "volatility_10d", "volatility_20d", "volatility_60d", "realized_vol_20d", "parkinson_vol_20d", "garman_klass_vol_20d", "bollinger_zscore_20", "bollinger_bandwidth_20"]
YEAR = math.sqrt(252)


def enrich_instrument(bars: DataFrame, instruments: DataFrame) -> DataFrame:
    """Bars with instrument_id and company_id of their symbol, null where it has none; bars without symbol, date or close go."""
    names = instruments.select("symbol", "instrument_id", "company_id").dropDuplicates(["symbol"])
    return bars.where("symbol is not null and bar_date is not null and adj_close is not null").join(names, "symbol", "left").withColumnRenamed("bar_date", "as_of_date")


def _w(n: int):
    return trailing(["symbol"], "as_of_date", n)


def _all():
    return ordered(["symbol"], "as_of_date")


def _close() -> Column:
    return F.col("adj_close")


def _warm(n: int, value: Column) -> Column:
    return warm(F.col("_rn"), n, value)


def _lag(k: int) -> Column:
    return F.lag("adj_close", k).over(_all())


def rsi(gain: Column, loss: Column) -> Column:
    """100 - 100 / (1 + gain / loss); 50 where both are 0, 100 where only the loss is."""
    return F.when((gain == 0) & (loss == 0), 50.0).when(loss == 0, 100.0).otherwise(100 - 100 / (1 + ratio(gain, loss)))


def _numbered(bars: DataFrame, instruments: DataFrame) -> DataFrame:
    return enrich_instrument(bars, instruments).withColumns({"_rn": F.row_number().over(_all()), "_prev": _lag(1)})


def _momentum(base: DataFrame) -> DataFrame:
    change = F.col("adj_close") - F.col("_prev")
    base = base.withColumns({"_gain": F.greatest(change, F.lit(0.0)), "_loss": F.greatest(-change, F.lit(0.0)), "_r20": ratio(_close(), _lag(20)) - 1})
    base = base.withColumns({"_gain": F.when(change.isNotNull(), F.col("_gain")), "_loss": F.when(change.isNotNull(), F.col("_loss"))})
    high, low = F.max("adj_high").over(_w(14)), F.min("adj_low").over(_w(14))
    spread = F.nullif(high - low, F.lit(0.0))
    out = {f"returns_{k}d": ratio(_close(), _lag(k)) - 1 for k in (1, 5, 10, 20, 60)}
    out |= {
        "returns_log_1d": F.when((_close() > 0) & (F.col("_prev") > 0), F.ln(_close() / F.col("_prev"))),
        "momentum_20d": F.col("_r20"),
        "momentum_acceleration_20d": _warm(41, F.col("_r20") - F.lag("_r20", 20).over(_all())),
        "rsi_14": _warm(15, rsi(F.avg("_gain").over(_w(14)), F.avg("_loss").over(_w(14)))),
        "williams_r_14": _warm(14, -100 * (high - _close()) / spread),
        "stoch_k_14": _warm(14, 100 * (_close() - low) / spread),
        "distance_from_252d_high": _warm(252, ratio(_close(), F.max("adj_close").over(_w(252))) - 1),
    }
    return base.withColumns(out)


def _trend(base: DataFrame) -> DataFrame:
    mean = {n: F.avg("adj_close").over(_w(n)) for n in (12, 20, 26, 50, 200)}
    base = base.withColumns({"_line": mean[12] - mean[26]} | {f"_sma{n}": m for n, m in mean.items()})
    base = base.withColumn("_signal", F.avg("_line").over(_w(9)))
    sma = {n: _warm(n, F.col(f"_sma{n}")) for n in mean}
    s20, s50, s200 = (F.col(f"_sma{n}") for n in (20, 50, 200))
    out = {f"sma_{n}": sma[n] for n in (20, 50, 200)} | {f"close_to_sma_{n}": ratio(_close(), sma[n]) for n in (20, 50, 200)}
    out |= {
        "ema_12": sma[12],
        "ema_26": sma[26],
        "macd_line": _warm(26, F.col("_line")),
        "macd_signal": _warm(34, F.col("_signal")),
        "macd_hist": _warm(34, F.col("_line") - F.col("_signal")),
        "slope_20d": ratio(_close(), _lag(20)) - 1,
        "slope_50d": ratio(_close(), _lag(50)) - 1,
        "trend_strength": _warm(200, F.when((_close() > s20) & (s20 > s50) & (s50 > s200), 1.0).when((_close() < s20) & (s20 < s50) & (s50 < s200), -1.0).otherwise(0.0)),
    }
    return base.withColumns(out)


def _volatility(base: DataFrame, rn: str, prev: str, by: list[str]) -> DataFrame:
    """The windows run within `by`, where rows are numbered by `rn` and `prev` is the close before."""
    over = lambda n: trailing(by, "as_of_date", n)
    keep = lambda n, value: warm(F.col(rn), n, value)
    o, h, lo, before, last = F.col("adj_open"), F.col("adj_high"), F.col("adj_low"), F.col(prev), F.coalesce(prev, "adj_close")
    hl, co = F.when((h > 0) & (lo > 0), F.ln(h / lo)), F.when((_close() > 0) & (o > 0), F.ln(_close() / o))
    base = base.withColumns(
        {
            "_tr": F.greatest(h - lo, F.abs(h - last), F.abs(lo - last)),
            "_log": F.when((_close() > 0) & (before > 0), F.ln(_close() / before)),
            "_hl2": hl * hl,
            "_gk": 0.5 * hl * hl - (2 * math.log(2) - 1) * co * co,
        }
    )
    std, gk, mean, spread = F.stddev_samp("_log"), F.avg("_gk").over(over(20)), F.avg("adj_close").over(over(20)), F.stddev_samp("adj_close").over(over(20))
    out = {"atr_14": keep(14, F.avg("_tr").over(over(14)))}
    out |= {"atr_pct_14": ratio(out["atr_14"], _close())}
    out |= {f"volatility_{n}d": keep(n + 1, std.over(over(n))) for n in (5, 10, 20, 60)}
    out |= {
        "realized_vol_20d": out["volatility_20d"] * YEAR,
        "parkinson_vol_20d": keep(20, F.sqrt(F.avg("_hl2").over(over(20)) / (4 * math.log(2))) * YEAR),
        "garman_klass_vol_20d": keep(20, F.when(gk >= 0, F.sqrt(gk) * YEAR)),
        "bollinger_zscore_20": keep(20, ratio(_close() - mean, spread)),
        "bollinger_bandwidth_20": keep(20, ratio(4 * spread, mean)),
    }
    return base.withColumns(out)


def _complete() -> Column:
    return F.col("adj_open").isNotNull() & F.col("adj_high").isNotNull() & F.col("adj_low").isNotNull()


def momentum(bars: DataFrame, instruments: DataFrame) -> DataFrame:
    """F1-F6. Returns are null where the earlier close is null or 0."""
    return _momentum(_numbered(bars, instruments)).select(*KEYS, "adj_close", *MOMENTUM)


def trend(bars: DataFrame, instruments: DataFrame) -> DataFrame:
    """F7-F12. The exponential averages are simple ones of 12 and 26 rows, close_to_sma is a plain ratio and the slope a return."""
    return _trend(_numbered(bars, instruments)).select(*KEYS, "adj_close", *TREND)


def volatility(bars: DataFrame, instruments: DataFrame) -> DataFrame:
    """F13-F18. Bars without open, high or low go before rows are numbered."""
    return _volatility(_numbered(bars.where(_complete()), instruments), "_rn", "_prev", ["symbol"]).select(*KEYS, "adj_close", *VOLATILITY)


def mean_reversion_pack(bars: DataFrame) -> DataFrame:
    """price_zscore and bands of two standard deviations over 20 rows, without warm-up."""
    w = trailing(["symbol"], "bar_date", 20)
    mean, std = F.avg("adj_close").over(w), F.stddev_samp("adj_close").over(w)
    bars = bars.withColumns({"price_zscore": ratio(_close() - mean, std), "bb_upper": mean + 2 * std, "bb_lower": mean - 2 * std})
    return bars.select("symbol", "bar_date", "price_zscore", "bb_upper", "bb_lower", ratio(_close() - F.col("bb_lower"), F.col("bb_upper") - F.col("bb_lower")).alias("bb_position"))


def volume_pack(bars: DataFrame) -> DataFrame:
    """volume against its 20-row mean and spread; on-balance volume, the running sum of volume signed by the close's move."""
    w, every = trailing(["symbol"], "bar_date", 20), ordered(["symbol"], "bar_date")
    move = F.signum(_close() - F.lag("adj_close").over(every))
    bars = bars.withColumns({"_mean": F.avg("volume").over(w), "_std": F.stddev_samp("volume").over(w), "_signed": F.coalesce(move, F.lit(0.0)) * F.col("volume")})
    return bars.select("symbol", "bar_date", ratio(F.col("volume"), F.col("_mean")).alias("volume_ratio"), ratio(F.col("volume") - F.col("_mean"), F.col("_std")).alias("volume_zscore"), F.sum("_signed").over(every.rowsBetween(Window.unboundedPreceding, 0)).alias("obv"))


def volatility_regime(bars: DataFrame) -> DataFrame:
    """1 where the 20-row standard deviation of the close is over its own 100-row mean, else 0."""
    bars = bars.withColumn("_std", F.stddev_samp("adj_close").over(trailing(["symbol"], "bar_date", 20)))
    return bars.select("symbol", "bar_date", F.when(F.col("_std") > F.avg("_std").over(trailing(["symbol"], "bar_date", 100)), 1).otherwise(0).alias("volatility_regime"))


def trend_pack(bars: DataFrame) -> DataFrame:
    """slopes as differences of a mean and its value so many rows before, trend strength as a relative gap of means, atr as the mean range."""
    every = ordered(["symbol"], "bar_date")
    bars = bars.withColumns({f"_s{n}": F.avg("adj_close").over(trailing(["symbol"], "bar_date", n)) for n in (20, 50, 200)})
    return bars.select(
        "symbol",
        "bar_date",
        (F.col("_s20") - F.lag("_s20", 20).over(every)).alias("slope_20d"),
        (F.col("_s50") - F.lag("_s50", 50).over(every)).alias("slope_50d"),
        ratio(F.col("_s20") - F.col("_s200"), F.col("_s200")).alias("trend_strength"),
        F.avg(F.col("adj_high") - F.col("adj_low")).over(trailing(["symbol"], "bar_date", 14)).alias("atr_14"),
    )


def technical_features(bars: DataFrame, instruments: DataFrame, allowed: DataFrame) -> DataFrame:
    """close_to_sma_20 less 1 and rsi_14 without warm-up (the first row counts as no move), for symbols in `allowed`."""
    base = enrich_instrument(bars.join(allowed.select("symbol").distinct(), "symbol", "left_semi"), instruments)
    change = F.coalesce(_close() - _lag(1), F.lit(0.0))
    base = base.withColumns({"_gain": F.greatest(change, F.lit(0.0)), "_loss": F.greatest(-change, F.lit(0.0))})
    return base.select(*KEYS, (ratio(_close(), F.avg("adj_close").over(_w(20))) - 1).alias("close_to_sma_20"), rsi(F.avg("_gain").over(_w(14)), F.avg("_loss").over(_w(14))).alias("rsi_14"))


def research_features(momentum_rows: DataFrame, trend_rows: DataFrame, volatility_rows: DataFrame, shorts: DataFrame | None = None) -> DataFrame:
    """Momentum is the master; the others are left-joined on (symbol, as_of_date), one row each. Columns that `shorts` lacks come as nulls."""
    key = ["symbol", "as_of_date"]
    return with_shorts(momentum_rows.join(trend_rows.select(*key, *TREND), key, "left").join(volatility_rows.select(*key, *VOLATILITY), key, "left"), shorts)


def with_shorts(out: DataFrame, shorts: DataFrame | None) -> DataFrame:
    """Short columns of one row per (symbol, as_of_date) added, nulls where there are none."""
    key = ["symbol", "as_of_date"]
    wanted = ["short_volume_ratio", "short_interest", "days_to_cover"]
    if shorts is None:
        return out.withColumns({c: F.lit(None).cast("double") for c in wanted})
    have = [F.col(c).cast("double").alias(c) if c in shorts.columns else F.lit(None).cast("double").alias(c) for c in wanted]
    return out.join(shorts.select(*key, *have).dropDuplicates(key), key, "left")


def research_features_daily(bars: DataFrame, instruments: DataFrame, shorts: DataFrame | None = None) -> DataFrame:
    """F24 from bars of one row per (symbol, date), in one shuffle of them: momentum, trend and volatility on the same rows. The windows of
    volatility run over the bars with open, high and low apart from the others, as if these weren't there; their own volatility is null."""
    base = _numbered(bars, instruments).withColumn("_full", _complete())
    by = ["symbol", "_full"]
    base = base.withColumns({"_vn": F.row_number().over(ordered(by, "as_of_date")), "_vprev": F.lag("adj_close").over(ordered(by, "as_of_date"))})
    out = _volatility(_trend(_momentum(base)), "_vn", "_vprev", by)
    out = out.select(*KEYS, "adj_close", *MOMENTUM, *TREND, *(F.when(F.col("_full"), F.col(c)).alias(c) for c in VOLATILITY))
    return with_shorts(out, shorts)
