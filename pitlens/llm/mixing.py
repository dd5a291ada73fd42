"""Mixing sources to target weights with hash-threshold histograms.

Every document has a fixed hash. A source whose target is c whole copies and a remainder takes
each document c times and, once more, the documents whose hash lies under the source's
threshold. The threshold is found without a sort: tokens are summed by source and hash bucket,
the bucket where the running sum passes the remainder is the boundary, and only that bucket is
summed again in finer buckets, three nested levels deep.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keep, n_words, read

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: A source, and a document, is taken at most so many times.
MOST = 3
#: Bits of the hash that each level splits.
LEVELS = (11, 11, 10)
HASH_BITS = sum(LEVELS)


def mix_hash(*cols: Column) -> Column:
    """32 bits of the md5 of the columns as text; the same on every run and engine."""
    text = F.concat_ws("\x1f", *(F.coalesce(c.cast("string"), F.lit("\x00")) for c in cols))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """source, source_size -> also target. Targets share the sum of all sizes by weight; those above `most`
    times their source's size stop there and the excess is shared again.

    The sources that stop are the first ones by size per weight: with them in that order, source i
    stops if its cap lies under its share of what the earlier ones leave. Null counts as a source, the last.
    The windows run over one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("_w", F.element_at(F.array(*map(F.lit, map(float, weights))), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    by_ratio = Window.orderBy((F.col("source_size") / F.col("_w")).asc(), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    capped = (
        ranked.withColumn("_cap", F.col("source_size") * float(most))
        .withColumn("_left", F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("_weight", F.sum("_w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_stops", F.col("_cap") * F.col("_weight") < F.col("_left") * F.col("_w"))
    )
    rest = F.sum("source_size").over(every) - F.sum(F.when(F.col("_stops"), F.col("_cap")).otherwise(0.0)).over(every)
    weight = F.sum(F.when(F.col("_stops"), 0.0).otherwise(F.col("_w"))).over(every)
    return capped.withColumn("target", F.when(F.col("_stops"), F.col("_cap")).otherwise(F.try_divide(rest * F.col("_w"), weight))).select("source", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"))


def thresholds(rows: DataFrame, plan: DataFrame, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """source, source_size, target, copies, threshold: `rows` (source, size, u) with u under `threshold` are taken once
    more than `copies`; their sizes stay within the remainder, and the next hash value would pass it."""
    state = plan.withColumn("copies", F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MOST))).otherwise(0).cast("long"))
    state = state.withColumn("_rest", F.col("target") - F.col("copies") * F.col("source_size")).withColumn("threshold", F.lit(0).cast("long"))
    state = keep(state, "mix-plan")
    shift = sum(levels)
    for bits in levels:
        width, shift = shift, shift - bits
        inside = rows.join(state.select(F.col("source").alias("_s"), "threshold"), F.col("source").eqNullSafe(F.col("_s"))).where(F.expr(f"u >= threshold and u < threshold + {1 << width}L"))
        summed = inside.groupBy("source", F.shiftright("u", shift).alias("_bucket")).agg(F.sum("size").alias("_sum"))
        running = summed.withColumn("_upto", F.sum("_sum").over(Window.partitionBy("source").orderBy("_bucket")))
        passed = (
            running.join(state.select(F.col("source").alias("_s"), F.col("_rest").alias("_r")), F.col("source").eqNullSafe(F.col("_s")))
            .where(F.col("_upto") > F.col("_r"))
            .groupBy("source")
            .agg(F.min("_bucket").alias("_b"), F.min_by(F.col("_upto") - F.col("_sum"), "_bucket").alias("_before"))
            .withColumnRenamed("source", "_s")
        )
        state = state.join(passed, F.col("source").eqNullSafe(F.col("_s")), "left").select(
            "source",
            "source_size",
            "target",
            "copies",
            (F.col("_rest") - F.coalesce("_before", F.lit(0))).alias("_rest"),
            # a source that never passes its remainder takes all: its threshold lies beyond every hash
            F.coalesce(F.shiftleft("_b", shift), F.when(F.col("_rest") > 0, F.lit(1 << sum(levels))).otherwise(F.col("threshold"))).alias("threshold"),
        )
        state = keep(state, "mix-level")
    return state.drop("_rest")


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(docs[id_col].alias("_id"), docs[source_col].alias("source"), n_words(docs[text_col]).alias("size"), mix_hash(docs[id_col], docs[source_col]).alias("u"))


def _copies() -> Column:
    return F.col("copies") + (F.col("u") < F.col("threshold")).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """One row per document: `id_col`, size (its words), source, source_size, target, copies (times it is taken), taken (words).

    Null and empty texts have size 0. A null source is one source, the last. Repeated rows share
    their hash and are taken alike. Other columns are left out; an empty table gives an empty one.
    """
    rows = keep(_rows(docs, id_col, text_col, source_col), "mix-rows")
    found = thresholds(rows, targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights)).withColumnRenamed("source", "_s")
    return rows.join(found, F.col("source").eqNullSafe(F.col("_s"))).select(F.col("_id").alias(id_col), "source", "size", "source_size", "target", _copies().alias("copies"), (_copies() * F.col("size")).alias("taken"))


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it; all columns stay, whatever their names."""
    rows = keep(_rows(docs, id_col, text_col, source_col), "mix-rows")
    found = thresholds(rows, targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights)).withColumnRenamed("source", "_s")
    packed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs[source_col].alias("source"), mix_hash(docs[id_col], docs[source_col]).alias("u"))
    taken = packed.join(found, F.col("source").eqNullSafe(F.col("_s"))).where(_copies() > 0)
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), _copies().cast("int")))).select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(concat_ws(chr(31), coalesce(CAST(doc_id AS VARCHAR), chr(0)), coalesce(source, chr(0)))), 1, 8) AS BIGINT) AS u
  FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
weighed AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM sources),
lefts AS (
  SELECT *, 3.0 * source_size AS cap,
    sum(source_size) OVER () - coalesce(sum(3.0 * source_size) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
    sum(w) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws
  FROM weighed),
stops AS (SELECT *, cap * ws < remaining * w AS stop FROM lefts),
plan AS (
  SELECT source, source_size, CASE WHEN stop THEN CAST(cap AS DOUBLE)
    ELSE CAST(sum(source_size) OVER () - sum(CASE WHEN stop THEN cap ELSE 0 END) OVER () AS DOUBLE) * w / sum(CASE WHEN stop THEN 0 ELSE w END) OVER () END AS target
  FROM stops),
cut AS (SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size) AS BIGINT), 3) ELSE 0 END AS copies FROM plan),
run AS (
  SELECT d.doc_id, d.size, c.source_size, c.target, c.copies, c.target - c.copies * c.source_size AS rest,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.u RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM docs d JOIN cut c ON d.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size, source_size, target, CAST(size * (copies + CASE WHEN upto <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM run
"""
