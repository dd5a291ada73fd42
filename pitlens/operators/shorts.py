"""Short volume and short interest: newest rows, rolling pressure, squeeze features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.windows import latest, ordered, ratio, trailing
from .clean import clean_keys, market_selection
from .joins import asof_bitemporal


def short_volume_history(rows: DataFrame) -> DataFrame:
    """H1: newest row per (symbol, trade_date, source_file) with both ratios, null where the total is 0."""
    rows = clean_keys(rows, "symbol").where("trade_date is not null")
    rows = rows.withColumns({"short_volume_ratio": ratio(F.col("short_volume"), F.col("total_volume")), "short_exempt_ratio": ratio(F.col("short_exempt_volume"), F.col("total_volume"))})
    return latest(rows, ["symbol", "trade_date", "source_file"], F.col("available_at").desc_nulls_last())


def overlap_window(rows: DataFrame, history: DataFrame, days: int = 7, date: str = "trade_date") -> DataFrame:
    """H1, increments: rows not older than `days` before the newest history date; all without a history."""
    start = history.agg(F.coalesce(F.date_sub(F.max(date), days), F.lit("1900-01-01").cast("date")).alias("_start"))
    return rows.crossJoin(F.broadcast(start)).where(F.col(date) >= F.col("_start")).drop("_start")


def short_interest_history(rows: DataFrame) -> DataFrame:
    """H2: newest row per (symbol, settlement_date, source_file) with days_to_cover and short_interest_pct_float, null where the divisor isn't positive."""
    rows = clean_keys(rows, "symbol").where("settlement_date is not null and trim(source_file) != ''")
    rows = latest(rows, ["symbol", "settlement_date", "source_file"], F.col("ingested_at").desc_nulls_last())
    over = lambda c: F.when(F.col(c) > 0, F.col("short_interest") / F.col(c))
    return rows.withColumns({"days_to_cover": over("avg_daily_volume"), "short_interest_pct_float": over("shares_float")})


def short_interest_latest(history: DataFrame) -> DataFrame:
    """H3: newest settlement of each symbol."""
    return latest(history, ["symbol"], F.col("settlement_date").desc_nulls_last(), F.col("ingested_at").desc_nulls_last())


def short_interest_counts(rows: DataFrame, universe: DataFrame, market: str) -> DataFrame:
    """H4: per file the rows, those of the market, and those that are in the universe too."""
    marked = rows.join(universe.where("include_in_universe").select("symbol", F.lit(1).alias("_in")).distinct(), "symbol", "left")
    chosen = market_selection(marked, market).groupBy("source_file").agg(F.count("*").alias("market_rows"), F.count("_in").alias("accepted_rows"))
    return marked.groupBy("source_file").agg(F.count("*").alias("total_rows")).join(chosen, "source_file", "left").fillna(0, ["market_rows", "accepted_rows"])


def short_daily(rows: DataFrame) -> DataFrame:
    """A2: volumes summed per (symbol, as_of_date), with the newest availability."""
    rows = clean_keys(rows, "symbol").where("trade_date is not null")
    return rows.groupBy("symbol", F.col("trade_date").alias("as_of_date")).agg(*(F.sum(c).alias(c) for c in ("short_volume", "short_exempt_volume", "total_volume")), F.max("available_at").alias("max_source_available_at"))


def short_rolling(daily: DataFrame) -> DataFrame:
    """H5: short_volume_ratio, 20-row means of volume and ratio, and the ratio's 20-row spread."""
    w = trailing(["symbol"], "as_of_date", 20)
    daily = daily.withColumn("short_volume_ratio", F.when(F.col("total_volume") > 0, F.col("short_volume") / F.col("total_volume")))
    return daily.withColumns({"short_volume_20d_avg": F.avg("short_volume").over(w), "short_volume_ratio_20d_avg": F.avg("short_volume_ratio").over(w), "short_volume_ratio_20d_std": F.stddev_samp("short_volume_ratio").over(w)})


def short_features(rolling: DataFrame, history: DataFrame, full_history: bool = False) -> DataFrame:
    """H6: J4 of the rolling rows with short interest, its change, z-scores of days to cover and of pressure, and their sum as squeeze score.

    The window of days_to_cover_zscore restarts each month, unless `full_history`.
    """
    facts = history.select("symbol", "settlement_date", "ingested_at", "short_interest", "previous_short_interest", "avg_daily_volume", "days_to_cover", "shares_float", "short_interest_pct_float")
    rows = asof_bitemporal(rolling, facts, "symbol", "as_of_date", "max_source_available_at", "settlement_date", "ingested_at", placed=True).drop("settlement_date", "ingested_at")
    keys = [F.col("symbol")] if full_history else [F.col("symbol"), F.trunc("as_of_date", "month")]
    w = Window.partitionBy(*keys).orderBy("as_of_date").rowsBetween(-19, 0)
    change = F.col("short_interest") - F.col("previous_short_interest")
    rows = rows.withColumns(
        {
            "short_interest_change": change,
            "short_interest_change_pct": ratio(change, F.col("previous_short_interest").cast("double")),
            "days_to_cover_zscore": ratio(F.col("days_to_cover") - F.avg("days_to_cover").over(w), F.stddev_samp("days_to_cover").over(w)),
            "short_pressure_zscore": ratio(F.col("short_volume_ratio") - F.col("short_volume_ratio_20d_avg"), F.col("short_volume_ratio_20d_std")),
        }
    )
    known = F.col("days_to_cover").isNotNull() | F.col("short_volume_ratio").isNotNull()
    return rows.withColumn("short_squeeze_score", F.when(known, F.coalesce("short_pressure_zscore", F.lit(0.0)) + F.coalesce("days_to_cover_zscore", F.lit(0.0)))).drop("short_volume_ratio_20d_std")


def feature_window_start(features: DataFrame, days: int = 45) -> DataFrame:
    """H7: one row, window_start: `days` before the newest feature date, or 1900-01-01."""
    return features.agg(F.coalesce(F.date_sub(F.max("as_of_date"), days), F.lit("1900-01-01").cast("date")).alias("window_start"))


def refresh_features(daily: DataFrame, history: DataFrame, start: str, look_back: int = 19) -> DataFrame:
    """H7: features from `start` on, equal to a full build: `look_back` rows of each symbol and the days of its month before `start` are read too."""
    w = ordered(["symbol"], "as_of_date").rowsBetween(0, look_back)
    first = F.lit(start).cast("date")
    needed = daily.withColumn("_last", F.max("as_of_date").over(w)).where((F.col("_last") >= first) | (F.col("as_of_date") >= F.date_sub(F.trunc(first, "month"), 31))).drop("_last")
    return short_features(short_rolling(needed), history).where(F.col("as_of_date") >= first)


def late_ranges(daily: DataFrame, late_daily: DataFrame, late_interest: DataFrame, look_ahead: int = 19) -> DataFrame:
    """H7: symbol, range_from, range_to: where features change after rows came late, ranges of a symbol that touch joined to one.

    A late or changed row of `daily`, named by (symbol, as_of_date), changes its own day and the next `look_ahead` rows of its symbol, whose windows hold it. A late settlement
    (symbol, settlement_date) may be the newest known on any later day."""
    marks = late_daily.select("symbol", "as_of_date", F.lit(True).alias("_late")).distinct()
    both = daily.select("symbol", "as_of_date", F.lit(False).alias("_late")).union(marks)
    here = Window.partitionBy("symbol").orderBy("as_of_date").rangeBetween(Window.currentRow, Window.currentRow)
    marked = both.withColumn("_hit", F.max("_late").over(here)).where("not _late")
    reach = marked.withColumn("range_to", F.max("as_of_date").over(ordered(["symbol"], "as_of_date").rowsBetween(0, look_ahead)))
    rows = reach.where("_hit").select("symbol", F.col("as_of_date").alias("range_from"), "range_to")
    facts = late_interest.groupBy("symbol").agg(F.min("settlement_date").alias("range_from")).select("symbol", "range_from", F.lit("9999-12-31").cast("date").alias("range_to"))
    w = Window.partitionBy("symbol").orderBy("range_from", "range_to")
    both = rows.unionByName(facts).withColumn("_before", F.max("range_to").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    both = both.withColumn("_n", F.sum((F.col("_before").isNull() | (F.col("range_from") > F.col("_before"))).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return both.groupBy("symbol", "_n").agg(F.min("range_from").alias("range_from"), F.max("range_to").alias("range_to")).drop("_n")


def _in_ranges(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """`rows` with _in, whether a range of their symbol holds their as_of_date, and _touched, whether it has a range. The latest end of those that have begun is carried along the time."""
    axis = rows.withColumn("_row", F.lit(True)).unionByName(ranges.select("symbol", F.col("range_from").alias("as_of_date"), F.col("range_to").alias("_end")), allowMissingColumns=True)
    w = Window.partitionBy("symbol").orderBy(F.col("as_of_date").asc_nulls_first(), F.col("_row").asc_nulls_first())
    held = F.coalesce(F.col("as_of_date") <= F.max("_end").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(False))
    return axis.withColumns({"_in": held, "_touched": F.max("_end").over(Window.partitionBy("symbol")).isNotNull()}).where("_row").drop("_row", "_end")


def refresh_late(features: DataFrame, daily: DataFrame, history: DataFrame, late_daily: DataFrame, late_interest: DataFrame, look_back: int = 19, whole: bool = False) -> tuple[DataFrame, DataFrame]:
    """H7: (features of symbols with late rows, these symbols), equal to a full build of `daily` and `history`, which hold the late rows already (`late_ranges`).

    Only rows in the ranges and the `look_back` rows before each are computed; the other rows of these symbols come from `features`, and other symbols are left
    alone: `sinks.replace_groups` by symbol stores the result. `whole` gives the features of the other symbols with them.

    Every step lies by symbol, so `daily` is shuffled once for the ranges, by its dates alone, and once for the rest, and `features` only if they don't lie by symbol."""
    ranges = late_ranges(daily, late_daily, late_interest, look_back)
    near = F.max("_in").over(ordered(["symbol"], "as_of_date").rowsBetween(0, look_back))
    needed = _in_ranges(daily, ranges).where("_touched").drop("_touched").withColumn("_near", near).where("_near").drop("_near")
    new = short_features(short_rolling(needed), history).where("_in").drop("_in")
    old = _in_ranges(features, ranges).where("not _in" if whole else "_touched and not _in").drop("_in", "_touched")
    return old.unionByName(new), ranges.select("symbol").distinct()
