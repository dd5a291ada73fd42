"""Vector bin packing of documents into shards, balancing bytes, tokens and rows jointly.

Documents of equal text form a group. Groups are packed in bundles: a heavy group is dealt over
several bundles by id, all others over a fixed number of bundles by text hash. Sizes of the bundles are
summed by Spark; their number has a bound that doesn't depend on the input, so the greedy placement
runs on them alone: largest first, each item goes to the shard whose residual capacity has the highest
dot product with the item's demand. The bundles of one group are one item, so equal texts share a
shard; only a group that no shard has room for is split, and each of its bundles is placed like an item.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keep, n_words, read

SHARDS = 8
#: Bundles of light groups; also, a group with over 1/BUNDLES of all bytes or rows is heavy.
BUNDLES = 2048
DIMENSIONS = ("size", "tokens", "rows")


def place(demand: np.ndarray, item: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each row of `demand` (bundles x dimensions); rows of one `item` (numbers from 0) go together. First the largest item; each where the
    dot product of its demand with the residual capacity is highest, among the shards it fits. One that fits none is split: its
    rows are placed one by one, in any shard if they fit none."""
    share = demand / np.maximum(demand.sum(axis=0), 1)
    whole = np.column_stack([np.bincount(item, share[:, d]) for d in range(demand.shape[1])]) if len(item) else share
    room = np.full((shards, demand.shape[1]), 1 / shards)
    out = np.zeros(len(demand), np.int32)

    def put(rows: np.ndarray, need: np.ndarray, forced: bool) -> bool:
        fits = (room >= need - 1e-12).all(axis=1)
        if not fits.any() and not forced:
            return False
        to = int(np.where(fits | ~fits.any(), room @ need, -np.inf).argmax())
        out[rows] = to
        room[to] -= need
        return True

    rows_of = np.split(np.argsort(item, kind="stable"), np.cumsum(np.bincount(item))[:-1]) if len(item) else []
    for i in np.lexsort((np.arange(len(whole)), -whole.max(axis=1))):
        if not put(rows_of[i], whole[i], len(rows_of[i]) == 1):
            for row in rows_of[i]:
                put(row, share[row], True)
    return out


def shard(docs: DataFrame, n_shards: int = SHARDS, bundles: int = BUNDLES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: `id_col`, size (UTF-8 bytes of the text plus 1), tokens (words), text_crc32 (of the UTF-8 bytes,
    null text as empty), bundle, shard, slot (gapless from 0 within the shard).

    Null texts are a group of their own. Null ids and repeated rows are dealt like others. An
    empty table gives an empty one; other columns are left out.
    """
    spark = docs.sparkSession
    text = docs[text_col]
    rows = keep(
        docs.select(
            docs[id_col].alias("_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            n_words(text).alias("tokens"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.xxhash64(text, F.lit(1)).alias("_group"),
            F.xxhash64(docs[id_col], F.lit(2)).alias("_deal"),
        ),
        "shard-rows",
    )
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size"), F.count("*").alias("rows")).first()
    # at most 2 * bundles groups are heavy, as each holds over 1/bundles of the bytes or of the rows
    groups = rows.groupBy("_group").agg(F.sum("size").alias("_s"), F.count("*").alias("_n"))
    shares = F.greatest(F.col("_s") * bundles / max(1, total["size"]), F.col("_n") * bundles / max(1, total["rows"]))
    heavy = groups.where((shares > 1) & (F.col("_n") > 1)).select("_group", F.least(F.ceil(shares * 2), F.col("_n")).cast("int").alias("_pieces"))
    heavy = keep(heavy, "shard-heavy")
    piece = F.when(F.col("_pieces").isNotNull(), F.pmod("_deal", F.col("_pieces"))).otherwise(F.lit(-1))
    bundle = F.when(F.col("_pieces").isNotNull(), F.concat_ws("-", F.lit("h"), "_group", piece)).otherwise(F.concat_ws("-", F.lit("l"), F.pmod("_group", F.lit(bundles))))
    # 2 * bundles rows of 12 bytes at most
    dealt = rows.join(F.broadcast(heavy), "_group", "left").withColumn("bundle", bundle)
    sums = dealt.groupBy("bundle").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")).toPandas().sort_values("bundle", ignore_index=True)
    demand = sums[list(DIMENSIONS)]
    group = sums["bundle"].str.replace(r"^(h-.*)-\d+$", r"\1", regex=True)
    sums["shard"] = place(demand.to_numpy(float), group.astype("category").cat.codes.to_numpy().astype(int), n_shards)
    sums["first"] = sums.groupby("shard")["rows"].cumsum() - sums["rows"]
    plan = spark.createDataFrame(list(sums[["bundle", "shard", "first"]].itertuples(index=False, name=None)), "bundle string, shard int, first long")
    order = Window.partitionBy("bundle").orderBy("_id", "_group")
    return (
        dealt.join(F.broadcast(plan), "bundle")
        .withColumn("slot", F.col("first") + F.row_number().over(order) - 1)
        .select(F.col("_id").alias(id_col), "size", "tokens", "text_crc32", "bundle", "shard", "slot")
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = shard(read(spark, sf_dir, "documents"))
    return packed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
