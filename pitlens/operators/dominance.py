"""For each query point the sum, greatest or least of all points of its key that lie neither right of nor above it, without pairing them.

Along x the points of a key are numbered. The points left of a query are the first c of them, and c is a sum of powers of two, so they are a few blocks of 1, 2, 4, ...
points: each query asks at most log c blocks, each point stands in at most log n, and only in those that some query of its key can ask. Blocks and queries meet by equality;
within a block, sorted by y, a running sum, maximum or minimum answers. Rows are linear times a logarithm, where pairing them takes the square.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dominance(points: DataFrame, queries: DataFrame, keys: list[str], values: dict[str, tuple[Callable[[Column], Column], str]], x: str = "x", y: str = "y") -> DataFrame:
    """The rows of `queries` with a column of each name of `values`: its function (F.sum, F.max or F.min) of a column of those `points` that have the same `keys`, and `x` and `y`
    not beyond the query's. Null without such points. Points with a null key, x or y count nowhere; queries with one stay, without an answer. Repeated queries stay."""
    names = list(values)
    there = F.lit(True)
    for c in [*keys, x, y]:
        there = there & F.col(c).isNotNull()
    ks = [f"_k{i}" for i in range(len(keys))]
    axes = [*(F.col(k).alias(n) for k, n in zip(keys, ks)), F.col(x).alias("_x"), F.col(y).alias("_y")]
    asked = queries.select(*axes, F.struct(*queries.columns).alias("_row"), F.lit(1).alias("_asks"))
    given = points.where(there).select(*axes, *(F.col(c).alias(f"_v{i}") for i, (_, c) in enumerate(values.values())), F.lit(0).alias("_asks"))
    w = Window.partitionBy(*ks).orderBy(F.col("_x").asc_nulls_first(), F.col("_asks"))
    both = asked.unionByName(given, allowMissingColumns=True)
    both = both.withColumns({"_c": F.count(F.when(F.col("_asks") == 0, 1)).over(w.rowsBetween(Window.unboundedPreceding, 0)), "_n": F.row_number().over(w)})
    both = both.withColumn("_c", F.when(F.col("_y").isNull(), 0).otherwise(F.col("_c")))
    # the longest start of the key's points that a query asks for; null or 0: no point is needed
    both = both.withColumn("_most", F.max(F.when(F.col("_asks") == 1, F.col("_c"))).over(Window.partitionBy(*ks)))
    held = "transform(filter(sequence(0, length(bin(_most)) - 1), l -> shiftright(_c - 1, l) % 2 = 0 and shiftleft(shiftright(_c - 1, l) + 1, l) <= _most), l -> struct(l as level, shiftright(_c - 1, l) as block))"
    wanted = "transform(filter(sequence(0, length(bin(_c)) - 1), l -> shiftright(_c, l) % 2 = 1), l -> struct(l as level, shiftright(_c, l + 1) * 2 as block))"
    listed = both.where("_asks = 1 or _c <= _most").withColumn("_at", F.when(F.col("_asks") == 1, F.expr(wanted)).otherwise(F.expr(held)))
    spread = listed.select(*ks, "_n", "_asks", "_y", "_row", *(f"_v{i}" for i in range(len(names))), F.explode_outer("_at").alias("_at")).where("_asks = 1 or _at is not null")
    v = Window.partitionBy(*ks, "_at").orderBy(F.col("_y").asc_nulls_first(), F.col("_asks")).rowsBetween(Window.unboundedPreceding, 0)
    found = spread.withColumns({f"_f{i}": f(F.col(f"_v{i}")).over(v) for i, (f, _) in enumerate(values.values())}).where("_asks = 1")
    # a query without a block has seen only queries
    out = found.groupBy(*ks, "_n").agg(F.first("_row").alias("_row"), *(f(F.col(f"_f{i}")).alias(n) for i, (n, (f, _)) in enumerate(values.items())))
    return out.select("_row.*", *names)
