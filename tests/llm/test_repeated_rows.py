"""Thousands of repeated rows cost their own rows, not their square."""

import collections
import time

from pyspark.sql import functions as F

from pitlens.llm import minhash, substring

TEXT = " ".join(f"w{i * 7919 % 100_003}" for i in range(5_000))


def test_passages_of_repeated_rows(spark):
    """5,000 equal rows of a text of 5,000 words, beside a document that shares 40 words of it."""
    few = [(1, TEXT), (2, "a b c " + " ".join(TEXT.split()[100:140]) + " d e f"), (3, "x y z"), (3, "x y z"), (None, None), (4, " ".join(f"v{i}" for i in range(40)))]
    base = spark.createDataFrame(few, "doc_id long, text string")
    many = base.union(spark.range(4_999).select(F.lit(1).cast("long").alias("doc_id"), F.lit(TEXT).alias("text")))
    start = time.time()
    got = substring.dedup(many).groupBy("doc_id", "n_words", "n_removed", "text").count().collect()
    assert time.time() - start < 120
    found = {(r["doc_id"], r["n_words"], r["n_removed"], r["text"]): r["count"] for r in got}
    assert found == {(1, 5_000, 5_000, ""): 5_000, (2, 46, 40, "a b c d e f"): 1, (3, 3, 0, "x y z"): 2, (None, 0, 0, ""): 1, (4, 40, 0, few[-1][1]): 1}
    # without repeated rows the long text loses only what it shares
    single = {r["doc_id"]: r["n_removed"] for r in substring.dedup(base.where("doc_id < 3")).collect()}
    assert single == {1: 40, 2: 40}


def test_near_copies_of_repeated_rows(spark):
    near = TEXT.split()
    near[2_000] = "changed"
    texts = spark.createDataFrame([(1, TEXT), (2, " ".join(near)), (3, "another text of its own")], "doc_id long, text string")
    many = texts.where("doc_id < 3").crossJoin(spark.range(5_000)).select("doc_id", "text").union(texts.where("doc_id = 3")).repartition(16)
    start = time.time()
    got = collections.Counter((r["doc_id"], r["component_id"]) for r in minhash.cluster(many).collect())
    assert time.time() - start < 150
    assert got == {(1, 1): 5_000, (2, 1): 5_000, (3, 3): 1}
    assert sorted(r["doc_id"] for r in minhash.representatives(many).collect()) == [1, 3]
