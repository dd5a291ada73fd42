"""Late short rows: what a refresh shuffles, and the bitemporal join of rows that lie by key already."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from pitlens.operators import joins
from pitlens.plans import catalog

SF = "/root/testdata/sf0.001"


def test_refresh_shuffles_few_rows(spark):
    context = spark.sparkContext._jsc.sc()

    def stages():
        """Rows shuffled by each stage."""
        context.listenerBus().waitUntilEmpty()
        found = context.statusStore().stageList(None, False, False, spark._sc._gateway.new_array(spark._jvm.double, 0), None)
        return {found.apply(i).stageId(): found.apply(i).shuffleWriteRecords() for i in range(found.size())}

    before = max(stages(), default=-1)
    # the tables are large ones' stand-ins, which aren't sent whole
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        catalog.QUERIES["H7_refresh_late"](spark, SF).write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    given = spark.read.parquet(f"{SF}/lineitem.parquet").count() + spark.read.parquet(f"{SF}/orders.parquet").count()
    assert sum(n for stage, n in stages().items() if stage > before) < 6 * given


def test_rows_that_lie_by_key_find_the_same(spark):
    draw, day = random.Random(3), lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    left = [(draw.choice(["a", "b", "c", "d", None]), i, day(draw.randrange(40)), draw.choice([None, *(day(n) for n in range(40))])) for i in range(300)]
    right = [(draw.choice(["a", "b", "c", None]), draw.choice([None, *(day(n) for n in range(60))]), draw.choice([None, *(day(n) for n in range(40))]), i) for i in range(200)]
    left = spark.createDataFrame(left, "i string, n int, at date, known date").select("n", "i", "at", "known")
    right = spark.createDataFrame(right, "i string, at date, known date, v int")
    placed = left.withColumn("_r", F.row_number().over(Window.partitionBy("i").orderBy("n"))).drop("_r")
    join = lambda df, **k: joins.asof_bitemporal(df, right, "i", "at", "known", "at", "known", **k)
    got, want = join(placed, placed=True), join(left)
    assert got.columns == want.columns == ["n", "i", "at", "known", "r_at", "r_known", "v"]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.where("v is not null").count() > 100
    best = {}
    facts = right.collect()
    for r in left.collect():
        best[r.n] = max(((f.at, f.known, f.v) for f in facts if r.i and f.i == r.i and f.at and f.known and r.known and f.at <= r.at and f.known <= r.known), default=(None, None, None))
    assert {r.n: (r.r_at, r.r_known, r.v) for r in got.collect()} == best
