"""Canonical prices: one row per symbol and date from several sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.windows import latest, ordered
from .joins import semi_allowed


def effective_prices(base: DataFrame, preferred: DataFrame) -> DataFrame:
    """Rows of both sources, one per (symbol, price_date): the preferred source, then the newest, then the highest tie-break."""
    rows = base.withColumn("_priority", F.lit(1)).unionByName(preferred.withColumn("_priority", F.lit(2)), allowMissingColumns=True)
    rows = rows.withColumn("symbol", F.upper(F.trim("symbol"))).where("symbol is not null and price_date is not null and close is not null")
    return latest(rows, ["symbol", "price_date"], F.col("_priority").desc(), F.col("ingested_at").desc_nulls_last(), F.col("source_name").desc_nulls_last()).drop("_priority")


def best_available_source(*sources: DataFrame) -> DataFrame:
    """Newest row per (symbol, price_date) of the first source that has rows."""
    chosen = next((s for s in sources if not s.isEmpty()), sources[-1])
    return latest(chosen, ["symbol", "price_date"], F.col("ingested_at").desc_nulls_last())


def filter_universe_prices(prices: DataFrame, universe: DataFrame) -> DataFrame:
    """Newest row per (symbol, price_date) of included symbols."""
    return latest(semi_allowed(prices, universe), ["symbol", "price_date"], F.col("ingested_at").desc_nulls_last())


def price_bars(prices: DataFrame, instruments: DataFrame, adjustment: float = 1.0) -> DataFrame:
    """C4: bars with instrument ids; adjusted values are the raw ones times a factor."""
    names = instruments.select("symbol", "instrument_id").dropDuplicates(["symbol"])
    adjusted = [(F.col(c) * adjustment).alias(f"adj_{c}") for c in ("open", "high", "low", "close")]
    return prices.join(names, "symbol", "left").select("instrument_id", "symbol", F.col("price_date").alias("bar_date"), *adjusted, "volume", F.lit(adjustment).alias("adjustment_factor"))


def price_quality_flags(prices: DataFrame, most: float = 0.8) -> DataFrame:
    """A row per flaw with flag_type and flag_value: close_nonpositive, volume_negative, and raw_return_abs_gt_80pct, the size of a return beyond `most`
    from a positive close."""
    before = F.lag("close").over(ordered(["symbol"], "price_date"))
    rows = prices.withColumn("_change", F.when(before > 0, F.abs(F.col("close") / before - 1)))
    flaws = {"close_nonpositive": (F.col("close") <= 0, "close"), "volume_negative": (F.col("volume") < 0, "volume"), "raw_return_abs_gt_80pct": (F.col("_change") > most, "_change")}
    found = F.array(*(F.when(c, F.struct(F.lit(name).alias("flag_type"), F.col(value).cast("double").alias("flag_value"))) for name, (c, value) in flaws.items()))
    return rows.select("symbol", "price_date", "source_name", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("f")).select("symbol", "price_date", "f.*", "source_name")


def bar_flags(bars: DataFrame) -> DataFrame:
    """C5, the checks of single bars: high_below_low and negative_volume, with the value true."""
    flaws = {"high_below_low": F.col("high") < F.col("low"), "negative_volume": F.col("volume") < 0}
    found = F.filter(F.array(*(F.when(c, name) for name, c in flaws.items())), lambda x: x.isNotNull())
    return bars.select("symbol", "price_date", F.explode(found).alias("flag_type"), F.lit("true").alias("flag_value"), "source_name")


def price_latest(prices: DataFrame, symbols: list[str] | None = None) -> DataFrame:
    """Newest row of each symbol, or of some."""
    rows = prices.where(F.col("symbol").isin(symbols)) if symbols is not None else prices
    return latest(rows, ["symbol"], F.col("price_date").desc_nulls_last(), F.col("ingested_at").desc_nulls_last()).select("symbol", F.col("price_date").alias("latest_price_date"), "close", "volume", "source_name")


def price_history_compat(prices: DataFrame) -> DataFrame:
    """The plain price columns."""
    return prices.select("symbol", "price_date", "open", "high", "low", "close", "volume", "source_name", "ingested_at")


def permanent_failures(failures: DataFrame, now: str, days: int = 7, least: int = 2, words: tuple[str, ...] = ("delisted", "not found", "no data")) -> DataFrame:
    """Symbols whose failures of the last `days` number `least` or more and name a lasting reason."""
    recent = F.col("last_seen_at") >= F.lit(now).cast("timestamp") - F.expr(f"interval {days} days")
    return failures.where(recent & (F.col("failure_count") >= least) & F.lower("reason").rlike("|".join(words))).select("symbol").distinct()


def symbols_needing_refresh(scope: DataFrame, prices: DataFrame, target: str) -> DataFrame:
    """Symbols in scope whose last price date is missing or before `target`."""
    last = prices.groupBy("symbol").agg(F.max("price_date").alias("last_price_date"))
    return scope.select("symbol").distinct().join(last, "symbol", "left").where(F.col("last_price_date").isNull() | (F.col("last_price_date") < F.lit(target).cast("date")))


def price_date_counts(prices: DataFrame, days: int = 30, complete: float = 0.9) -> DataFrame:
    """The last `days` price dates with their symbols, the most symbols of any of them, and whether a date has `complete` of that."""
    counts = prices.groupBy("price_date").agg(F.countDistinct("symbol").alias("symbols")).orderBy(F.col("price_date").desc()).limit(days)
    expected = counts.agg(F.max("symbols").alias("expected"))
    return counts.crossJoin(F.broadcast(expected)).withColumn("is_complete", F.col("symbols") >= complete * F.col("expected"))


def refresh_window(counts: DataFrame, today: str, catch_up: int = 30) -> DataFrame:
    """One row (action, start_date, end_date) from A12: the end is the last weekday up to `today`; without prices it is a bootstrap; if the
    last date is partial, it starts there again; else after the last complete date, at most `catch_up` days back; up_to_date if nothing is left."""
    day = F.lit(today).cast("date")
    end = F.date_sub(day, F.when(F.dayofweek(day) == 7, 1).when(F.dayofweek(day) == 1, 2).otherwise(0))
    state = counts.agg(F.max("price_date").alias("last"), F.max(F.when(F.col("is_complete"), F.col("price_date"))).alias("done"))
    state = state.withColumn("end_date", end).withColumn("_from", F.when(F.col("last") > F.coalesce("done", F.lit("1900-01-01").cast("date")), F.col("last")).otherwise(F.date_add("done", 1)))
    action = F.when(F.col("last").isNull(), "bootstrap").when(F.col("_from") > F.col("end_date"), "up_to_date").when(F.col("_from") == F.col("last"), "partial_latest").otherwise("catch_up")
    start = F.when(action == "bootstrap", F.date_sub("end_date", catch_up)).when(action != "up_to_date", F.greatest("_from", F.date_sub("end_date", catch_up)))
    return state.select(action.alias("action"), start.alias("start_date"), F.when(action != "up_to_date", F.col("end_date")).alias("end_date"))
