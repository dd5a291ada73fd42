"""Forward labels and datasets. Labels read later rows only, features earlier ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.windows import ordered, ratio
from .joins import interval_membership


def _forward(k: int):
    return ratio(F.lead("adj_close", k).over(ordered(["symbol"], "bar_date")), F.col("adj_close")) - 1


def return_labels(bars: DataFrame, horizons: tuple[int, ...] = (1, 5, 20)) -> DataFrame:
    """L1: forward returns and their direction 1, -1 or 0."""
    out = bars.withColumns({f"fwd_return_{h}d": _forward(h) for h in horizons})
    return out.select("symbol", "bar_date", *(f"fwd_return_{h}d" for h in horizons), *(F.signum(f"fwd_return_{h}d").cast("int").alias(f"direction_{h}d") for h in horizons))


def _log_return(bars: DataFrame):
    prev = F.lag("adj_close").over(ordered(["symbol"], "bar_date"))
    return bars.withColumn("_log", F.when((F.col("adj_close") > 0) & (prev > 0), F.ln(F.col("adj_close") / prev)))


def forward_volatility(bars: DataFrame, n: int = 20) -> DataFrame:
    """L2: sample standard deviation of the next `n` log returns."""
    w = ordered(["symbol"], "bar_date").rowsBetween(1, n)
    return _log_return(bars).select("symbol", "bar_date", F.stddev_samp("_log").over(w).alias(f"realized_vol_{n}d_fwd"))


def trailing_volatility(bars: DataFrame, n: int = 20, least: int = 10) -> DataFrame:
    """L3: sample standard deviation of simple returns over the last `n` rows, null with fewer than `least` of them."""
    every = ordered(["symbol"], "bar_date")
    bars = bars.withColumn("_r", ratio(F.col("adj_close"), F.lag("adj_close").over(every)) - 1)
    w = every.rowsBetween(-(n - 1), 0)
    return bars.select("symbol", "bar_date", F.when(F.count("_r").over(w) >= least, F.stddev_samp("_r").over(w)).alias(f"realized_vol_{n}d"))


def research_labels(bars: DataFrame, horizons: tuple[int, ...] = (1, 5, 10, 20), most: float = 5.0) -> DataFrame:
    """L4: forward returns, null beyond `most` in size, and target_up 1 or 0."""
    out = bars.withColumns({f"return_fwd_{h}d": _forward(h) for h in horizons})
    out = out.withColumns({f"return_fwd_{h}d": F.when(F.abs(f"return_fwd_{h}d") <= most, F.col(f"return_fwd_{h}d")) for h in horizons})
    return out.select("symbol", F.col("bar_date").alias("as_of_date"), *(f"return_fwd_{h}d" for h in horizons), *(F.when(F.col(f"return_fwd_{h}d") > 0, 1).when(F.col(f"return_fwd_{h}d") <= 0, 0).alias(f"target_up_{h}d") for h in horizons))


def training_dataset(features: DataFrame, labels: DataFrame, horizon: int, feature: str) -> DataFrame:
    """Features with the label of one horizon, both known."""
    label = f"return_fwd_{horizon}d"
    return features.join(labels.select("symbol", "as_of_date", F.col(label).alias("target_return")), ["symbol", "as_of_date"]).where(f"target_return is not null and {feature} is not null")


def split_by_date(rows: DataFrame, train_end: str, valid_end: str, date: str = "as_of_date") -> DataFrame:
    """Train up to `train_end`, val up to `valid_end`, then test."""
    return rows.withColumn("split", F.when(F.col(date) <= F.lit(train_end).cast("date"), "train").when(F.col(date) <= F.lit(valid_end).cast("date"), "val").otherwise("test"))


def split_by_manifest(rows: DataFrame, manifest: DataFrame, date: str = "as_of_date") -> DataFrame:
    """Partition by the closed ranges of a one-row manifest; rows in none are dropped."""
    m = F.broadcast(manifest.limit(1).select(*(f"{p}_{e}" for p in ("train", "valid", "test") for e in ("start", "end"))))
    part = F.lit(None).cast("string")
    for p in ("test", "valid", "train"):
        part = F.when(F.col(date).between(F.col(f"{p}_start"), F.col(f"{p}_end")), p).otherwise(part)
    return rows.crossJoin(m).withColumn("partition_name", part).where("partition_name is not null").drop(*m.columns)


def latest_available(prices: DataFrame, facts: DataFrame, key: str, payload: str, date: str = "bar_date") -> DataFrame:
    """Prices with the newest fact of the key available on their date, as JSON in `payload`; null where there is none."""
    from .joins import asof

    packed = facts.where("available_at is not null").withColumns({"_day": F.to_date("available_at"), payload: F.to_json(F.struct(*facts.columns))}).select(key, "_day", "available_at", payload)
    return asof(prices, packed, [key], date, "_day", ["available_at", payload]).drop("_day", "available_at")


def research_dataset(features: DataFrame, memberships: DataFrame, labels: DataFrame, name: str, version: str) -> DataFrame:
    """Features of members on their date, with labels where there are any, tagged."""
    rows = interval_membership(features, memberships, "symbol", "as_of_date")
    return rows.join(labels, ["symbol", "as_of_date"], "left").withColumns({"dataset_name": F.lit(name), "dataset_version": F.lit(version)})


def ranking_frame(rows: DataFrame, horizon: int, min_price: float, min_dollar_volume: float, buckets: int = 5) -> DataFrame:
    """Rows (symbol, as_of_date, adj_close, volume) over the floors with their forward return, relevance 0 .. buckets - 1 by date and the date's group size."""
    forward = ratio(F.lead("adj_close", horizon).over(ordered(["symbol"], "as_of_date")), F.col("adj_close")) - 1
    rows = rows.withColumn("target_return", forward).where((F.col("adj_close") >= min_price) & (F.col("adj_close") * F.col("volume") >= min_dollar_volume) & F.col("target_return").isNotNull())
    by_date = Window.partitionBy("as_of_date")
    return rows.withColumns({"relevance": F.ntile(buckets).over(by_date.orderBy(F.col("target_return").asc_nulls_last(), "symbol")) - 1, "group_size": F.count("*").over(by_date)})


def relevance_pct_rank(rows: DataFrame, levels: int = 5) -> DataFrame:
    """Grade 0 .. levels - 1 from the rank of the target within its date, ties in symbol order."""
    w = Window.partitionBy("as_of_date")
    pct = F.row_number().over(w.orderBy(F.col("target_return").asc_nulls_last(), "symbol")) / F.count("*").over(w)
    return rows.withColumn("relevance", F.least(F.greatest(F.floor(pct * levels), F.lit(0)), F.lit(levels - 1)).cast("int"))


def dataset_version_row(rows: DataFrame, name: str, version: str, date: str = "as_of_date") -> DataFrame:
    """One row with count and date range."""
    return rows.agg(F.count("*").alias("row_count"), F.min(date).alias("start_date"), F.max(date).alias("end_date")).select(F.lit(name).alias("dataset_name"), F.lit(version).alias("dataset_version"), "*")
