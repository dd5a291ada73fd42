"""Signals and backtests as set-based programs: no loop over dates, no driver-side book.

A scored frame has symbol, as_of_date, score, target_return (and adj_close, volume where said). Windows
without a key run over daily frames only, which have one row per trading date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.shared import stored
from ..functions.windows import ordered, ratio

MIN_NAMES = 50


def signal_short_ratio(c: Column, threshold: float, raw: bool = False) -> Column:
    """B1: the ratio where it reaches the threshold, else 0; or as it is."""
    return c if raw else F.when(c.isNotNull(), F.when(c >= threshold, c).otherwise(0.0))


def signal_rsi(c: Column, oversold: float = 30.0) -> Column:
    """B2: 1 at or under the threshold, else 0; null stays."""
    return F.when(c.isNotNull(), (c <= oversold).cast("double"))


def signal_sma_cross(fast: Column, slow: Column) -> Column:
    """1 where fast is over slow, else 0; null if either is."""
    return F.when(fast.isNotNull() & slow.isNotNull(), (fast > slow).cast("double"))


def signal_sma_cross_rsi(fast: Column, slow: Column, rsi: Column, most: float) -> Column:
    """B3 where rsi is at most `most`."""
    return F.when(fast.isNotNull() & slow.isNotNull() & rsi.isNotNull(), ((fast > slow) & (rsi <= most)).cast("double"))


def _positions(rows: DataFrame, keys: list[str], bps: float) -> DataFrame:
    """Rows (signal_value, fwd_return_1d) with position, turnover, cost and net return; the position before the first row is 0."""
    active = F.coalesce((F.col("signal_value") > 0).cast("double"), F.lit(0.0))
    rows = rows.withColumn("active", active)
    rows = rows.withColumn("turnover", F.abs(F.col("active") - F.lag("active", 1, 0.0).over(ordered([*keys, "symbol"], "as_of_date")))).where("fwd_return_1d is not null")
    rows = rows.withColumns({"gross": F.col("active") * F.col("fwd_return_1d"), "cost": F.col("turnover") * (bps / 10000)})
    return rows.withColumn("net", F.col("gross") - F.col("cost"))


def strategy_metrics(pnl: DataFrame, keys: list[str]) -> DataFrame:
    """Averages, sums, spread, sharpe and turnover per key."""
    out = pnl.groupBy(*keys).agg(F.avg("gross").alias("avg_gross"), F.sum("gross").alias("gross_return"), F.sum("cost").alias("total_cost"), F.sum("net").alias("net_return"), F.avg("net").alias("avg_net"), F.stddev_samp("net").alias("volatility"), F.avg("turnover").alias("turnover"), F.count("*").alias("n_obs"))
    return out.withColumn("sharpe", ratio(F.col("avg_net"), F.col("volatility")))


def signal_backtest(rows: DataFrame, bps: float = 10.0, keys: list[str] = ["partition_name"]) -> DataFrame:
    """Rows (symbol, as_of_date, partition_name, signal_value, fwd_return_1d) to A7 per partition. The previous position is the
    symbol's last one in any partition."""
    return strategy_metrics(_positions(rows, [k for k in keys if k != "partition_name"], bps), keys)


def signal_grid(rows: DataFrame, pairs: list[tuple[int, int]], bps: float = 10.0) -> DataFrame:
    """B6 of the crossings of all (fast, slow) pairs of sma_ columns, in one job: one row of each pair for each row."""
    each = F.array(*(F.struct(F.lit(f).alias("fast"), F.lit(s).alias("slow"), signal_sma_cross(F.col(f"sma_{f}"), F.col(f"sma_{s}")).alias("signal_value")) for f, s in pairs))
    return signal_backtest(rows.withColumn("_p", F.explode(each)).select("symbol", "as_of_date", "partition_name", "fwd_return_1d", "_p.*"), bps, ["fast", "slow", "partition_name"])


def signal_performance(existing: DataFrame, results: DataFrame) -> DataFrame:
    """Existing rows and those results whose (backtest_name, partition_name) isn't there yet."""
    return existing.unionByName(results.join(existing.select("backtest_name", "partition_name"), ["backtest_name", "partition_name"], "left_anti"))


def cross_section(rows: DataFrame, min_names: int = MIN_NAMES, score: str = "score") -> DataFrame:
    """Rows of dates with enough names, with _n, _up and _down (ranks by score from below and above, ties in symbol order) and _z."""
    by = Window.partitionBy("as_of_date")
    rows = rows.where(F.col(score).isNotNull() & F.col("target_return").isNotNull()).withColumn("_n", F.count("*").over(by)).where(F.col("_n") >= min_names)
    up = F.row_number().over(by.orderBy(F.col(score).asc(), F.col("symbol").asc()))
    rows = rows.withColumns({"_up": up, "_z": (F.col(score) - F.avg(score).over(by)) / F.nullif(F.stddev_samp(score).over(by), F.lit(0.0))})
    return rows.withColumn("_down", F.col("_n") - F.col("_up") + 1)


def _bucket(share: float, at_least_one: bool) -> Column:
    k = F.floor(F.col("_n") * share)
    return F.greatest(k, F.lit(1)) if at_least_one else k


def decile_long_short(rows: DataFrame, share: float = 0.1, reverse: bool = False, at_least_one: bool = False, min_names: int = MIN_NAMES) -> DataFrame:
    """Per date the mean return of the top and the bottom `share` by score (swapped if `reverse`) and their difference."""
    x, k = cross_section(rows, min_names), _bucket(share, at_least_one)
    long, short = ("_up", "_down") if reverse else ("_down", "_up")
    out = x.groupBy("as_of_date").agg(F.avg(F.when(F.col(long) <= k, F.col("target_return"))).alias("long"), F.avg(F.when(F.col(short) <= k, F.col("target_return"))).alias("short"))
    return out.withColumn("long_short", F.col("long") - F.col("short"))


def summarize(daily: DataFrame, column: str = "long_short") -> DataFrame:
    """Mean and sharpe (not annualized) of a daily column, one row."""
    return daily.agg(F.count(column).alias("days"), F.avg(column).alias("mean_ls"), (F.avg(column) / F.nullif(F.stddev_samp(column), F.lit(0.0))).alias("sharpe_ls"))


def zscore_reversal(rows: DataFrame, share: float = 0.1, min_names: int = MIN_NAMES) -> DataFrame:
    """Long the lowest, short the highest cross-sectional z-scores."""
    return decile_long_short(rows, share, True, min_names=min_names)


def multifactor_alpha(rows: DataFrame, share: float = 0.1, min_names: int = MIN_NAMES) -> DataFrame:
    """score = z(short_volume_ratio) - z(returns_20d) - z(volatility_20d) within the date, then B9."""
    by, factors = Window.partitionBy("as_of_date"), ("returns_20d", "volatility_20d", "short_volume_ratio")
    rows = rows.dropna(subset=[*factors, "target_return"])
    z = {c: (F.col(c) - F.avg(c).over(by)) / F.nullif(F.stddev_samp(c).over(by), F.lit(0.0)) for c in factors}
    return decile_long_short(rows.withColumn("score", z["short_volume_ratio"] - z["returns_20d"] - z["volatility_20d"]), share, min_names=min_names)


def alpha_weighted(rows: DataFrame, min_names: int = MIN_NAMES) -> DataFrame:
    """Per date the return of weights (score - mean) / sum of their sizes."""
    by = Window.partitionBy("as_of_date")
    x = cross_section(rows, min_names).withColumn("_a", F.col("score") - F.avg("score").over(by))
    return x.groupBy("as_of_date").agg((F.sum(F.col("_a") * F.col("target_return")) / F.nullif(F.sum(F.abs("_a")), F.lit(0.0))).alias("long_short"))


def zscore_weighted_buckets(rows: DataFrame, share: float = 0.05, min_names: int = MIN_NAMES) -> DataFrame:
    """Tails weighted by z over the tail's sum of sizes. The short weights are negative already, and the short side is subtracted again; kept so."""
    x, k = cross_section(rows, min_names), _bucket(share, True)
    side = lambda rank: F.sum(F.when(F.col(rank) <= k, F.col("_z") * F.col("target_return"))) / F.nullif(F.sum(F.when(F.col(rank) <= k, F.abs("_z"))), F.lit(0.0))
    out = x.groupBy("as_of_date").agg(side("_down").alias("long"), side("_up").alias("short"))
    return out.withColumn("long_short", F.col("long") - F.col("short"))


def _turnover(book: DataFrame) -> DataFrame:
    """as_of_date, turnover: sum over symbols of the change in weight from the last date with a book, exits included.

    Each position adds its change from the symbol's position of the date before, and, unless the symbol stays, its exit at the next date."""
    days = book.select("as_of_date").distinct().withColumn("_i", F.row_number().over(Window.orderBy("as_of_date")))
    w = Window.partitionBy("symbol").orderBy("_i")
    near = lambda i, weight: F.when(i, weight).otherwise(0.0)
    enter = F.abs(F.col("weight") - near(F.coalesce(F.lag("_i").over(w) == F.col("_i") - 1, F.lit(False)), F.lag("weight").over(w)))
    leave = near(~F.coalesce(F.lead("_i").over(w) == F.col("_i") + 1, F.lit(False)), F.abs("weight"))
    moves = book.select("as_of_date", "symbol", F.coalesce("weight", F.lit(0.0)).alias("weight")).join(days, "as_of_date").select("_i", enter.alias("enter"), leave.alias("leave"))
    each = moves.select(F.explode(F.array(F.struct("_i", F.col("enter").alias("v")), F.struct((F.col("_i") + 1).alias("_i"), F.col("leave").alias("v")))).alias("m")).select("m.*")
    return days.join(each.groupBy("_i").agg(F.sum("v").alias("turnover")), "_i").select("as_of_date", "turnover")


def ranker_book(rows: DataFrame, share: float = 0.05, min_names: int = MIN_NAMES) -> DataFrame:
    """B14, positions: the tails by z, weighted by its positive part long and its negative part short."""
    x, k, by = cross_section(rows, min_names), _bucket(share, True), Window.partitionBy("as_of_date", "_side")
    x = x.withColumn("_side", F.when(F.col("_down") <= k, 1).when(F.col("_up") <= k, -1)).where("_side is not null")
    part = F.greatest(F.col("_z") * F.col("_side"), F.lit(0.0))
    return x.withColumn("_part", part).withColumn("weight", F.col("_side") * F.col("_part") / (F.sum("_part").over(by) + 1e-9)).select("as_of_date", "symbol", F.col("_z").alias("signal"), "target_return", "weight")


def ranker_portfolio(book: DataFrame, bps: float = 10.0) -> DataFrame:
    """B14, daily: positions, gross, turnover against the previous book, net and hit rate."""
    book = stored(book.select("as_of_date", "symbol", "weight", "target_return"), "book")
    pnl = F.col("weight") * F.col("target_return")
    daily = book.groupBy("as_of_date").agg(F.count("*").alias("selected_count"), F.sum(pnl).alias("gross"), F.avg((pnl > 0).cast("double")).alias("hit_rate"))
    return daily.join(_turnover(book), "as_of_date").withColumn("net", F.col("gross") - F.col("turnover") * (bps / 10000))


def compound(daily: DataFrame, column: str = "net") -> DataFrame:
    """Daily rows with capital, the running product of 1 + max(column, -0.999)."""
    w = Window.orderBy("as_of_date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("capital", F.exp(F.sum(F.ln(1 + F.greatest(F.coalesce(F.col(column), F.lit(0.0)), F.lit(-0.999)))).over(w)))


def long_only_next_day(rows: DataFrame, share: float = 0.05, min_price: float = 5.0, min_dollar_volume: float = 1e6, cap: float = 0.5, bps: float = 20.0, deny: tuple[str, ...] = (), min_names: int = MIN_NAMES) -> DataFrame:
    """Equal weights in the top `share` of rows over the floors, returns capped both ways, cost by turnover, compounded."""
    rows = rows.where((F.col("adj_close") >= min_price) & (F.col("adj_close") * F.col("volume") >= min_dollar_volume))
    rows = rows.where(~F.col("symbol").isin(*deny)) if deny else rows
    rows = rows.where("target_return is not null")
    x = cross_section(rows.withColumn("target_return", F.greatest(F.least("target_return", F.lit(cap)), F.lit(-cap))), min_names)
    x = x.where(F.col("_down") <= _bucket(share, True))
    book = x.withColumn("weight", 1 / F.count("*").over(Window.partitionBy("as_of_date"))).select("as_of_date", "symbol", "target_return", "weight")
    book = stored(book, "book")
    daily = book.groupBy("as_of_date").agg(F.sum(F.col("weight") * F.col("target_return")).alias("gross"), F.count("*").alias("names")).join(_turnover(book), "as_of_date")
    return compound(daily.withColumn("net", F.col("gross") - F.col("turnover") * (bps / 10000)))


def overlapping_sleeves(rows: DataFrame, hold: int = 20, share: float = 0.05, bps: float = 20.0, capital_fraction: float = 1.0, min_names: int = MIN_NAMES) -> DataFrame:
    """Each date opens a sleeve in the top `share`; its return over `hold` dates less cost, times `capital_fraction`, is spread over
    these dates and compounded. A fraction of 1 / hold gives each sleeve its part of the capital only."""
    x = cross_section(rows, min_names)
    sleeves = x.where(F.col("_down") <= _bucket(share, True)).groupBy("as_of_date").agg((F.avg("target_return") - bps / 10000).alias("sleeve"))
    days = rows.where("target_return is not null and score is not null").select("as_of_date").distinct().join(sleeves, "as_of_date", "left")
    w = Window.orderBy("as_of_date").rowsBetween(-(hold - 1), 0)
    return compound(days.withColumn("net", F.coalesce(F.sum("sleeve").over(w), F.lit(0.0)) * (capital_fraction / hold)).select("as_of_date", "net"))


def price_only_momentum(prices: DataFrame, names: int, min_close: float, min_volume: float) -> DataFrame:
    """Per date the mean return from the next close to the one after of the `names` highest and lowest 20-row momenta; full days only."""
    every = ordered(["symbol"], "price_date")
    lag, t1, t2 = F.lag("close", 20).over(every), F.lead("close", 1).over(every), F.lead("close", 2).over(every)
    x = prices.withColumns({"_lag": lag, "_t1": t1, "_t2": t2}).where(F.col("_lag").isNotNull() & F.col("_t2").isNotNull() & F.col("close").isNotNull() & (F.col("close") >= min_close) & (F.col("volume") >= min_volume))
    x = x.withColumns({"_m": ratio(F.col("close"), F.col("_lag")) - 1, "_r": ratio(F.col("_t2"), F.col("_t1")) - 1})
    by = Window.partitionBy("price_date")
    x = x.withColumns({"_long": F.row_number().over(by.orderBy(F.col("_m").desc_nulls_last(), "symbol")), "_short": F.row_number().over(by.orderBy(F.col("_m").asc_nulls_last(), "symbol"))})
    pick = lambda c: F.avg(F.when(F.col(c) <= names, F.col("_r")))
    out = x.groupBy("price_date").agg(pick("_long").alias("long_ret"), pick("_short").alias("short_ret"), F.avg("_r").alias("universe_ret"), F.count("*").alias("universe_names")).where(F.col("universe_names") >= names)
    return out.withColumn("long_short_spread_ret", F.col("long_ret") - F.col("short_ret"))


def return_series_metrics(daily: DataFrame, column: str, year: int = 252) -> DataFrame:
    """One row: days, total return, CAGR, mean, spread, annual sharpe, deepest drawdown and share of gains."""
    rows = compound(daily.where(F.col(column).isNotNull()), column)
    w = Window.orderBy("as_of_date").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_fall", F.col("capital") / F.max("capital").over(w) - 1)
    end, n, std = F.max_by("capital", "as_of_date"), F.count("*"), F.stddev_samp(column)
    return rows.agg(n.alias("days"), (end - 1).alias("total_return"), (F.pow(end, year / F.nullif(n, F.lit(0))) - 1).alias("cagr"), F.avg(column).alias("mean_daily"), std.alias("vol_daily"), (F.avg(column) / F.nullif(std, F.lit(0.0)) * float(year) ** 0.5).alias("sharpe_annualized"), F.min("_fall").alias("max_drawdown"), F.avg((F.col(column) > 0).cast("double")).alias("win_rate"))
