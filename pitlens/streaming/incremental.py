"""What plays the role of a stream: rows past a watermark, and files that haven't been processed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def incremental_rows(rows: DataFrame, state: DataFrame, time: str, overlap_days: int = 0) -> DataFrame:
    """Rows past the one-row state's watermark or within the overlap before it; all without a watermark."""
    floor = F.col("watermark") - F.make_dt_interval(F.lit(overlap_days))
    return rows.crossJoin(F.broadcast(state.limit(1).select("watermark"))).where(F.col("watermark").isNull() | (F.col(time) > floor)).drop("watermark")


def advance_watermark(rows: DataFrame, state: DataFrame, time: str) -> DataFrame:
    """One row with the later of the old watermark and the newest row; it never moves back."""
    seen = rows.agg(F.max(time).alias("_seen"))
    return seen.join(F.broadcast(state.limit(1).select("watermark")), how="left").select(F.greatest("watermark", "_seen").alias("watermark"))


def new_files_stream(spark: SparkSession, source: str, schema: str, checkpoint: str, apply: Callable[[DataFrame, int], None]) -> None:
    """Hand each file of a folder to `apply` once, in micro-batches, and stop when all are done; the checkpoint remembers them across runs."""
    stream = spark.readStream.schema(schema).parquet(source)
    query = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
