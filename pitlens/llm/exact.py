"""Exact sums of integers of any size over partitions, and the integers of vectors."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a limb; sums of limbs are decimals of 38 digits, so some 10**26 partitions may add up.
LIMB = 40
#: What `partial_sums` yields.
SCHEMA = "g int, dim int, limb int, s long"


def finite(v: Column) -> Column:
    """Whether an array column is there and holds finite numbers only."""
    return v.isNotNull() & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))


def whole(v: Column, scale: float) -> Column:
    """floor(scale * component) of a finite array column as doubles, exact also beyond a long."""
    scaled = lambda e: F.lit(scale) * e.cast("double")
    # doubles from 2**52 on are whole, and floor() is a long
    return F.transform(v, lambda e: F.when(F.abs(scaled(e)) < 2.0**52, F.floor(scaled(e)).cast("double")).otherwise(scaled(e)))


def dense(lists: pa.Array, dim: int) -> np.ndarray:
    """Rows of an Arrow list column, filled up with zeros to `dim`."""
    sizes = np.asarray(lists.value_lengths())
    values = np.asarray(lists.flatten())
    out = np.zeros((len(sizes), dim), values.dtype)
    out[np.arange(dim)[None, :] < sizes[:, None]] = values
    return out


def column_sums(x: np.ndarray) -> list[int]:
    """Sum of each column of an int64 matrix of under 2**31 rows."""
    high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
    return [(int(h) << 32) + int(n) for h, n in zip(high, low)]


def partial_sums(sums: Iterable[tuple[int, list[int]]]) -> Iterator[pa.RecordBatch]:
    """Rows of SCHEMA for sums of integers by group."""
    rows = []
    for group, values in sums:
        for dim, value in enumerate(values):
            limb = 0
            while not -(2**62) <= value < 2**62:
                rows.append((group, dim, limb, value & ((1 << LIMB) - 1)))
                value, limb = value >> LIMB, limb + 1
            rows.append((group, dim, limb, value))
    if rows:
        g, dim, limb, s = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(g, pa.int32()), pa.array(dim, pa.int32()), pa.array(limb, pa.int32()), pa.array(s, pa.int64())], ["g", "dim", "limb", "s"])


def total_sums(partials: DataFrame) -> dict[int, dict[int, int]]:
    """group -> dim -> sum. As many rows come to the driver as there are groups, dimensions and limbs, whatever the number of partitions."""
    out: dict[int, dict[int, int]] = {}
    for r in partials.groupBy("g", "dim", "limb").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
        at = out.setdefault(r["g"], {})
        at[r["dim"]] = at.get(r["dim"], 0) + (int(r["s"]) << (LIMB * r["limb"]))
    return out


def as_long(value: int) -> int | None:
    """`value`, null where a long can't hold it."""
    return value if -(2**63) <= value < 2**63 else None
