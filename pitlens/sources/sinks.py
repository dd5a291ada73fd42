"""Writers. Tables are parquet folders.

A table is changed in steps that a writer may die between. Each leaves enough beside or in the folder to finish or undo the change,
which the next writer does first: `recover` for whole tables, `recover_keyed` for tables in buckets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.shared import discard, exists, names, remove, rename, stored, touch
from ..functions.windows import latest
from .readers import read_stooq_bars


def recover(spark: SparkSession, path: str) -> None:
    """Finish what a dead writer left of `replace_table`: the new rows if they were all written, else the old ones."""
    new, old = f"{path}._new", f"{path}._old"
    if not exists(spark, path):
        if exists(spark, f"{new}/_SUCCESS"):
            rename(spark, new, path)
        elif exists(spark, old):
            rename(spark, old, path)
    if exists(spark, path):
        remove(spark, old)


def replace_table(df: DataFrame, path: str) -> None:
    """K1: the whole table anew. The rows are written beside it, then take its name, so a writer that dies midway loses nothing; `df` may read what it replaces."""
    spark = df.sparkSession
    recover(spark, path)
    new, old = f"{path}._new", f"{path}._old"
    df.write.mode("overwrite").parquet(new)
    if exists(spark, path):
        rename(spark, path, old)
    rename(spark, new, path)
    remove(spark, old)


def append_dedup(existing: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """K2: rows to append: those whose key isn't there, one each."""
    return rows.dropDuplicates(keys).join(existing.select(*keys).distinct(), keys, "left_anti")


def upsert_by_key(existing: DataFrame, stage: DataFrame, keys: list[str]) -> DataFrame:
    """K3: the table with the stage's rows in place of those of equal key."""
    return existing.join(stage.select(*keys).distinct(), keys, "left_anti").unionByName(stage, allowMissingColumns=True)


def replace_window(existing: DataFrame, stage: DataFrame, date: str, start: str) -> DataFrame:
    """K4: rows before `start` and the stage's rows from `start` on."""
    first = F.lit(start).cast("date")
    return existing.where(F.col(date) < first).unionByName(stage.where(F.col(date) >= first))


def replace_months(df: DataFrame, path: str, month: str = "month_start") -> None:
    """K5: only the months that `df` holds, by dynamic partition overwrite."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month).parquet(path)


def export_rows(df: DataFrame, date: str, start: str, end: str, symbols: list[str] | None, labels: list[str]) -> DataFrame:
    """K6: rows of the closed range, the symbols if given, with any label, in order."""
    rows = df.where(F.col(date).between(F.lit(start).cast("date"), F.lit(end).cast("date")) & F.coalesce(*(F.col(c) for c in labels)).isNotNull())
    return (rows.where(F.col("symbol").isin(symbols)) if symbols else rows).orderBy(date, "symbol")


def export_csv(df: DataFrame, path: str) -> None:
    """K6: with header."""
    df.write.mode("overwrite").csv(path, header=True)


def merge_counter(existing: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """K7: counts raised by the failures seen of the key, one for each row, and last_seen_at renewed; new keys start with their number and first_seen_at;
    others are unchanged."""
    new = seen.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("seen_at").alias("_first"), F.max("seen_at").alias("_last"))
    out = existing.join(new, keys, "full_outer")
    count = F.coalesce("failure_count", F.lit(0)) + F.coalesce("_n", F.lit(0))
    return out.select(*keys, count.alias("failure_count"), F.coalesce("first_seen_at", "_first").alias("first_seen_at"), F.coalesce("_last", "last_seen_at").alias("last_seen_at"))


#: Buckets of a keyed table. A batch rewrites those of its keys, so a bucket should be about a file's size.
BUCKETS = 64


def _bucket(name: str) -> int:
    return int(name[1:].split("-")[0])


def _parts(spark: SparkSession, path: str) -> list[str]:
    """Names of a keyed table's files: b<bucket>-<change>-<name of the written file>."""
    return [n for n in names(spark, path) if n.startswith("b") and n.endswith(".parquet")]


def recover_keyed(spark: SparkSession, path: str) -> None:
    """Put a change's whole buckets, written under _pending, in place of the old ones, and remember the epoch. A change that wasn't
    written to its end is dropped. Doing it again does no harm, so a writer that dies midway leaves it to the next one."""
    for change in names(spark, f"{path}/_pending"):
        folder = f"{path}/_pending/{change}"
        if exists(spark, f"{folder}/_SUCCESS"):
            touched = [n for n in names(spark, folder) if n.startswith("_bucket=")]
            now = {int(n.split("=")[1]) for n in touched}
            for old in _parts(spark, path):
                if _bucket(old) in now and f"-{change}-" not in old:
                    remove(spark, f"{path}/{old}")
            for n in touched:
                for part in names(spark, f"{folder}/{n}"):
                    if part.endswith(".parquet"):
                        rename(spark, f"{folder}/{n}/{part}", f"{path}/b{int(n.split('=')[1]):05d}-{change}-{part}")
            if "@" in change:
                _remember(spark, path, change.split("@")[1])
        remove(spark, folder)


def _remember(spark: SparkSession, path: str, epoch: str) -> None:
    stream, number = epoch.rsplit("=", 1)
    touch(spark, f"{path}/_epochs/{stream}={number}")
    for n in names(spark, f"{path}/_epochs"):
        if n.rsplit("=", 1)[0] == stream and int(n.rsplit("=", 1)[1]) < int(number):
            remove(spark, f"{path}/_epochs/{n}")


def last_epoch(spark: SparkSession, path: str, stream: str) -> int:
    """Number of the last batch of `stream` that the table has taken; -1 before the first."""
    return max((int(n.rsplit("=", 1)[1]) for n in names(spark, f"{path}/_epochs") if n.rsplit("=", 1)[0] == stream), default=-1)


def replace_groups(rows: DataFrame, path: str, keys: list[str], touched: DataFrame | None = None, buckets: int = BUCKETS, stream: str | None = None, epoch: int | None = None) -> None:
    """Put `rows` into a table in hash buckets of its keys: rows of equal key, nulls equal, go, also those of the keys in `touched`. Only the buckets of these keys are read and
    rewritten. With `stream` and `epoch`, a batch that the table has taken already changes nothing; a stream that starts over with a new checkpoint needs a new name.

    New buckets are written whole under _pending and then renamed into place, so a writer that dies at any point loses nothing and mixes nothing for the next
    one; readers should follow a writer, not run beside it. `buckets` belongs to the table and must stay. The driver handles names of buckets only.
    """
    spark = rows.sparkSession
    recover_keyed(spark, path)
    if stream is not None and epoch is not None and epoch <= last_epoch(spark, path, stream):
        return
    at = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    have = _parts(spark, path)
    if have:
        # hashes differ between types, so keys take the table's
        kinds = spark.read.parquet(f"{path}/{have[0]}").schema
        alike = lambda df: df.withColumns({k: F.col(k).cast(kinds[k].dataType) for k in keys})
        rows, touched = alike(rows), None if touched is None else alike(touched)
    # both are read more than once, and may come from the table itself
    rows = batch = stored(rows.withColumn("_bucket", at), "batch")
    gone = rows.select("_bucket", *keys)
    if touched is not None:
        gone = gone.union(touched.select(at.alias("_bucket"), *keys))
    gone = stored(gone.distinct(), "keys")
    # as many rows as buckets at most
    now = {r["_bucket"] for r in gone.select("_bucket").distinct().collect()}
    old = [f"{path}/{n}" for n in have if _bucket(n) in now]
    if old:
        same = F.lit(True)
        for k in ["_bucket", *keys]:
            same = same & F.col(f"o.{k}").eqNullSafe(F.col(f"g.{k}"))
        kept = spark.read.parquet(*old).withColumn("_bucket", at).alias("o").join(gone.alias("g"), same, "left_anti")
        rows = kept.unionByName(rows, allowMissingColumns=True)
    change = uuid.uuid4().hex + (f"@{stream}={epoch}" if stream is not None and epoch is not None else "")
    if now:
        rows.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{path}/_pending/{change}")
        # a bucket that lost all its rows has no folder of its own
        for b in now.difference(int(n.split("=")[1]) for n in names(spark, f"{path}/_pending/{change}") if n.startswith("_bucket=")):
            touch(spark, f"{path}/_pending/{change}/_bucket={b}/_none")
    elif "@" in change:
        _remember(spark, path, change.split("@")[1])
    discard(batch, gone)
    recover_keyed(spark, path)


def upsert_batch(batch: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS, stream: str | None = None, epoch: int | None = None) -> None:
    """K3 as a step of a stream: the folder's rows with the batch's in place of those of equal key, one of each key. A batch handed over again changes nothing; with
    `stream` and `epoch` it isn't even looked at. Files written follow the batch's keys, not the table's size (see `replace_groups`)."""
    replace_groups(latest(batch, keys), path, keys, buckets=buckets, stream=stream, epoch=epoch)


def export_normalized_prices(spark, source: str, path: str, symbols: list[str], etfs: bool = False) -> None:
    """K8: rows of S1 for a symbol list, without ETFs unless asked for, as CSV with header in the columns of S2 and then class and venue."""
    rows = read_stooq_bars(spark, source).where(F.col("symbol").isin(symbols))
    rows = rows if etfs else rows.where("asset_class != 'ETF'")
    rows.select("symbol", "price_date", "open", "high", "low", "close", "volume", F.lit("stooq").alias("source_name"), "asset_class", "venue_group").write.csv(path, header=True)
