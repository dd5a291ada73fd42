"""Centroid clustering with an equal-average equal-variance search.

Squared Euclidean distance splits into dim * (difference of means)**2, the (difference of deviations)**2 at least, and the rest. The centroids are sorted
by mean; a vector starts at its own mean and scans outward, nearest mean first. Once the mean alone rules a centroid out, all that follow on
either side are ruled out too; a centroid that mean and deviation rule out together is passed over. The others get their
distance in integers, so ties and results are exact. Bounds carry some slack against rounding and reject only what is truly farther.

Vectors are read once and stored as whole numbers. A round is one pass over them: each task assigns its vectors to the centroids it was sent, at most a few
thousand numbers, and returns sums by centroid, which Spark adds up; only the sums reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, keep, read
from .exact import SCHEMA, as_long, column_sums, dense, finite, partial_sums, total_sums, whole

#: Components up to this size give distances that a long holds, for up to SMALL_DIM components.
SMALL, SMALL_DIM = 1 << 25, 1024
#: Vectors searched at once.
TILE = 8192
SLACK = 1e-9


class Codebook:
    """Centroids as whole numbers; `nearest` finds for each vector the one of smallest distance, ties to the smaller number."""

    def __init__(self, centroids: list[list[int]]):
        self.whole = centroids
        self.small = all(abs(v) <= SMALL for c in centroids for v in c) and len(centroids[0]) <= SMALL_DIM
        if self.small:
            x = np.array(centroids, np.int64)
            mean = x.mean(axis=1)
            self.order = np.argsort(mean, kind="stable")
            self.x, self.mean = x[self.order], mean[self.order]
            self.deviation = np.sqrt(((self.x - self.mean[:, None]) ** 2).sum(axis=1))
        #: Distances computed so far.
        self.computed = 0

    def search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid, squared distance) of int64 vectors of components up to SMALL."""
        dim = x.shape[1]
        mean = x.mean(axis=1)
        deviation = np.sqrt(((x - mean[:, None]) ** 2).sum(axis=1))
        high = np.searchsorted(self.mean, mean)
        low = high - 1
        best, number = np.full(len(x), np.iinfo(np.int64).max), np.full(len(x), len(self.mean))
        means = np.r_[np.inf, self.mean, np.inf]
        active = np.arange(len(x))
        while len(active):
            down, up = np.abs(mean[active] - means[low[active] + 1]), np.abs(means[high[active] + 1] - mean[active])
            lower = down <= up
            gap = np.where(lower, down, up)
            at = np.where(lower, low[active], high[active])
            near = np.maximum(gap - SLACK * (1 + np.abs(mean[active])), 0)
            alive = np.isfinite(gap) & (dim * near * near <= best[active])
            active, at, lower, near = active[alive], at[alive], lower[alive], near[alive]
            low[active[lower]] -= 1
            high[active[~lower]] += 1
            apart = np.maximum(np.abs(deviation[active] - self.deviation[at]) - SLACK * (1 + deviation[active] + self.deviation[at]), 0)
            close = (dim * near * near + apart * apart) * (1 - SLACK) <= best[active]
            rows, cand = active[close], at[close]
            diff = x[rows] - self.x[cand]
            found, name = np.einsum("ij,ij->i", diff, diff), self.order[cand]
            self.computed += len(rows)
            better = (found < best[rows]) | ((found == best[rows]) & (name < number[rows]))
            best[rows[better]], number[rows[better]] = found[better], name[better]
        return number, best

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        """(centroid, squared distance) of vectors of whole floats; those with large components by integers of any size, a distance beyond a long null."""
        small = (np.abs(x) <= SMALL).all(axis=1) & self.small
        number, distance = np.zeros(len(x), np.int32), [None] * len(x)
        for a in range(0, len(x), TILE):
            at = a + np.flatnonzero(small[a : a + TILE])
            if len(at):
                number[at], best = self.search(x[at].astype(np.int64))
                for i, d in zip(at.tolist(), best.tolist()):
                    distance[i] = d
        for i in np.flatnonzero(~small):
            v = list(map(int, x[i].tolist()))
            best, number[i] = min((sum((p - q) ** 2 for p, q in zip(v, c)), n) for n, c in enumerate(self.whole))
            distance[i] = as_long(best)
        return number, distance


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str, dim: int, scale: float) -> DataFrame:
    """id, x array<double> of floor(scale * component) for the vectors of `dim` finite components."""
    v = vectors[vec_col]
    return vectors.where(finite(v) & (F.size(v) == dim)).select(vectors[id_col].alias("id"), whole(v, scale).alias("x"))


def _sums(codebook: Codebook, dim: int):
    """Partial sums by centroid, the number of its vectors last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list[int]] = {}
        for batch in batches:
            x = dense(batch.column(0), dim)
            number, _ = codebook.nearest(x)
            for n in np.unique(number):
                own = x[number == n]
                if np.abs(own).max() < 2.0**62:
                    sums = column_sums(own.astype(np.int64))
                else:
                    sums = [sum(map(int, column)) for column in own.T.tolist()]
                now = totals.setdefault(int(n), [0] * (dim + 1))
                totals[int(n)] = [a + b for a, b in zip(now, [*sums, len(own)])]
        yield from partial_sums(totals.items())

    return run


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: str = "3", id_col: str = "vec_id", vec_col: str = "embedding", dim: int = 64, scale: float = 1024.0) -> tuple[DataFrame, list[list[int]]]:
    """(`id_col`, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector, and the final centroids.

    Vectors take part that have `dim` components, all finite, as whole numbers floor(scale * component). The first centroids are the `k` with smallest
    sha256 of `seed`:id, ties by their components, null ids last; with fewer vectors there are fewer. A round assigns each vector to the nearest centroid by
    squared distance, ties to the smaller number, then moves each centroid that has vectors to their floored mean. Rounds that would change nothing are left out.
    Repeated rows count each and get a row each; other columns are left out; without vectors the result is empty. Distances, and inertias that
    hold one, are null where a long can't hold them; assignments are exact still.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = keep(whole_vectors(vectors, id_col, vec_col, dim, scale), "whole-vectors")
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    # k rows
    first = rows.orderBy(hashed.asc_nulls_last(), "x").limit(k).collect()
    if not first:
        return spark.createDataFrame([], f"{id_col} {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"), []
    centroids = [list(map(int, r["x"])) for r in first]
    for _ in range(rounds):
        totals = total_sums(rows.select("x").mapInArrow(_sums(Codebook(centroids), dim), SCHEMA))
        moved = [[totals[n][d] // totals[n][dim] for d in range(dim)] if n in totals else c for n, c in enumerate(centroids)]
        if moved == centroids:
            break
        centroids = moved
    codebook = Codebook(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, distance = codebook.nearest(dense(batch.column(1), dim))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number, pa.int32()), pa.array(distance, pa.int64())], ["id", "cluster", "distance"])

    done = keep(rows.mapInArrow(assign, f"id {kind}, cluster int, distance long"), "assigned")
    discard(rows)
    # k rows
    stats = done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"), F.count_if(F.col("distance").isNull()).alias("beyond")).collect()
    inertia = {r["cluster"]: None if r["beyond"] else int(r["s"]) for r in stats}
    every = None if None in inertia.values() else as_long(sum(inertia.values()))
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    facts = spark.createDataFrame([(n, None if s is None else as_long(s), every, sha[n]) for n, s in inertia.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # k rows
    out = done.join(F.broadcast(facts), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return out, centroids


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(read(spark, sf_dir, "embeddings"))[0]


def _oracle(k: int = 8, rounds: int = 10, dim: int = 64) -> str:
    """The same in SQL, a pair of tables for each round."""
    steps = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, e) - 1 AS INTEGER) AS c, e FROM (SELECT sha256('3:' || CAST(vec_id AS VARCHAR)) AS h, e FROM v ORDER BY h NULLS LAST, e LIMIT {k}) x)""",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
  SELECT r, vec_id, e, c, d FROM (
    SELECT v.r, v.vec_id, v.e, c.c, list_sum(list_transform(range(1, {dim + 1}), lambda j: (v.e[j] - c.e[j]) * (v.e[j] - c.e[j]))) AS d FROM v CROSS JOIN c{i} c) x
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"""
        )
        if i < rounds:
            steps.append(
                f"""m{i} AS MATERIALIZED (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS e FROM (
    SELECT c, j, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(e) AS x, unnest(range(1, {dim + 1})) AS j FROM a{i}) y GROUP BY c, j) z GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(m{i}.e, c{i}.e) AS e FROM c{i} LEFT JOIN m{i} ON m{i}.c = c{i}.c)"""
            )
    return (
        "WITH "
        + ",\n".join(steps)
        + f"""
SELECT a.vec_id, a.c AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.c = a.c"""
    )


ORACLE = _oracle()
