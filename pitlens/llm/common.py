"""What several corpus operators share: written tables, row keys and text hashing."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.shared import remove, scratch

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


_BATCH_SIZE = "spark.sql.execution.arrow.maxBytesPerBatch"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it again: cuts lineage, survives lost executors and gives
    the planner true sizes."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by `keep` that no result reads any more."""
    for table in tables:
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            remove(table.sparkSession, folder)


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of 8 MB at most from now on in a session that leaves the size at Spark's own, so that tasks and the workers kept between stages stay small."""
    if spark.conf.get(_BATCH_SIZE) == f"{64 << 20}b":
        spark.conf.set(_BATCH_SIZE, "8m")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in UTF-8 bytes."""
    inside = np.empty(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def word_hashes(data: np.ndarray | bytes) -> np.ndarray:
    """XXH3 of each word of UTF-8 bytes, in their order."""
    words = bytes(data).split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _join(a: np.ndarray, b: np.ndarray, salt) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(mix(a + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(3) + b + salt)


def run_hashes(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hash of each run of `sizes` words (1 or more) from `starts`, from the words' hashes: two runs of the largest power of two cover it."""
    out = np.zeros(len(starts), np.uint64)
    level, span = words, 1
    while len(starts):
        here = (sizes >= span) & (sizes < 2 * span)
        if here.any():
            at, n = starts[here], sizes[here]
            out[here] = _join(level[at], level[at + n - span], n.astype(np.uint64))
        if span * 2 > sizes.max():
            break
        level = _join(level[:-span], level[span:], np.uint64(0))
        span *= 2
    return out


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words, from the words' hashes."""
    count = max(0, len(words) - n + 1)
    return run_hashes(words, np.arange(count), np.full(count, n))


def utf8_slices(column) -> list[np.ndarray]:
    """The UTF-8 bytes of each text of an Arrow string column, without copies; none for null."""
    bounds = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else [0]
    data = column.buffers()[2] if len(column) else None
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return [data[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
