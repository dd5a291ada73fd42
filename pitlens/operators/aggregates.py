"""Summaries, signatures and quality counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def coverage_summary(rows: DataFrame, key: str, date: str, columns: list[str]) -> DataFrame:
    """A1: rows, distinct keys, date range, and the non-null count of each column."""
    return rows.agg(F.count("*").alias("row_count"), F.countDistinct(key).alias("symbol_count"), F.min(date).alias("min_date"), F.max(date).alias("max_date"), *(F.count(c).alias(f"{c}_count") for c in columns))


def split_stats(rows: DataFrame) -> DataFrame:
    """Per split the rows, symbols, dates, target mean and share of positive targets."""
    up = F.avg(F.when(F.col("target_return").isNotNull(), (F.col("target_return") > 0).cast("double")))
    return rows.groupBy("split").agg(F.count("*").alias("row_count"), F.countDistinct("symbol").alias("symbol_count"), F.countDistinct("as_of_date").alias("date_count"), F.avg("target_return").alias("target_mean"), up.alias("positive_rate"))


DATE_COLUMNS = ("as_of_date", "bar_date", "price_date", "trade_date", "settlement_date", "period_end_date", "date")


def table_signature(rows: DataFrame, name: str) -> DataFrame:
    """One row: count, date bounds and an order-free checksum over (symbol, date); the date is the first known column there is, and
    a missing date or symbol column counts as null."""
    date = next((c for c in DATE_COLUMNS if c in rows.columns), None)
    when = F.col(date).cast("date") if date else F.lit(None).cast("date")
    symbol = F.col("symbol") if "symbol" in rows.columns else F.lit(None).cast("string")
    mark = F.conv(F.substring(F.md5(F.concat_ws("|", F.coalesce(symbol, F.lit("")), F.coalesce(when.cast("string"), F.lit(""))).cast("binary")), 1, 8), 16, 10).cast("decimal(38,0)")
    return rows.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"), F.min(when).alias("min_date"), F.max(when).alias("max_date"), F.coalesce(F.sum(mark).cast("long"), F.lit(0)).alias("checksum"))


def data_quality_counts(rows: DataFrame, columns: list[str], date: str, low: str, high: str) -> DataFrame:
    """A10: nulls of each column and dates out of range."""
    out = F.col(date).isNull() | (F.col(date) < F.lit(low).cast("date")) | (F.col(date) > F.lit(high).cast("date"))
    return rows.agg(*(F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns), F.count_if(out).alias("dates_out_of_range"))


def top_groups(rows: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The `n` most frequent keys, ties in key order."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), F.col(key).asc_nulls_last()).limit(n)


def universe_summary(prices: DataFrame, memberships: DataFrame) -> DataFrame:
    """Per symbol the first and last bar, their number, latest close and dollar volume, and the range of its memberships."""
    last = F.struct("price_date", "ingested_at")
    bars = prices.groupBy("symbol").agg(F.min("price_date").alias("first_bar"), F.max("price_date").alias("last_bar"), F.count("*").alias("bar_count"), F.max_by("close", last).alias("latest_close"), F.max_by(F.col("close") * F.col("volume"), last).alias("latest_dollar_volume"))
    spans = memberships.groupBy("symbol").agg(F.min("effective_from").alias("member_from"), F.max("effective_to").alias("member_to"))
    return bars.join(spans, "symbol", "left")


def file_row_counts(rows: DataFrame, *keys: str, loaded: str = "ingested_at") -> DataFrame:
    """Rows and newest load per file and further keys."""
    return rows.groupBy("source_file", *keys).agg(F.count("*").alias("row_count"), F.max(loaded).alias("last_loaded_at"))


def duplicate_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def breakdown(rows: DataFrame, key: str) -> DataFrame:
    """Rows per value."""
    return rows.groupBy(key).agg(F.count("*").alias("n"))


def changed_sources(current: DataFrame, stored: DataFrame) -> DataFrame:
    """Signatures of A9 that differ from the stored ones, or are new."""
    s = stored.select(F.col("table_name"), *(F.col(c).alias(f"old_{c}") for c in ("row_count", "min_date", "max_date", "checksum")), F.lit(True).alias("_known"))
    same = F.col("_known").isNotNull()
    for c in ("row_count", "min_date", "max_date", "checksum"):
        same = same & F.col(c).eqNullSafe(F.col(f"old_{c}"))
    return current.join(s, "table_name", "left").where(~same).select("table_name", "row_count", "checksum")


def snapshot_manifest(tables: dict[str, DataFrame], required: list[str]) -> DataFrame:
    """Signatures of the required tables with an error each: missing_table, empty_table, no_date_bounds, inverted_bounds, or null."""
    out, spark = None, next(iter(tables.values())).sparkSession
    for name in required:
        if name in tables:
            part = table_signature(tables[name], name).withColumn("error", F.when(F.col("row_count") == 0, "empty_table").when(F.col("min_date").isNull(), "no_date_bounds").when(F.col("min_date") > F.col("max_date"), "inverted_bounds"))
        else:
            part = spark.range(1).select(F.lit(name).alias("table_name"), F.lit(0).cast("long").alias("row_count"), F.lit(None).cast("date").alias("min_date"), F.lit(None).cast("date").alias("max_date"), F.lit(0).cast("long").alias("checksum"), F.lit("missing_table").alias("error"))
        out = part if out is None else out.unionByName(part)
    return out
