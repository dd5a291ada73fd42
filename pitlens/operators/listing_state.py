"""Listing history kept up day by day: a snapshot is merged into a stored state, in order or late.

The state has a row for each stretch: the longest run of snapshots, none missing between them, in which an identity is seen with the same values. With it goes what a
version's end depends on: how many snapshots lack the identity after the stretch, and the date of the last one allowed. That says all there is to say about the
observations, so they aren't read again:

* a snapshot that lacks an identity it falls within splits the stretch; one that falls into a gap raises its number of missing snapshots;
* a sighting is a stretch of one date, which joins its neighbours where it continues them;
* identities that are closed before the snapshot's date, or open after it, aren't touched.

Versions (U6) and symbol references (U9) are windows over the stretches of an identity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.shared import exists
from ..sources.sinks import BUCKETS, recover, recover_keyed, replace_groups, replace_table
from .universe import listing_identity

VALUES = ["symbol", "exchange", "security_type", "company_name", "cik"]
#: What stretches of one identity follow each other by.
ORDER = ["first_date", "symbol", "exchange", "security_type"]


def _numbered(dates: DataFrame) -> DataFrame:
    """Snapshot dates with their number; one row per date."""
    return dates.select("as_of_date").distinct().withColumn("snapshot", F.row_number().over(Window.orderBy("as_of_date")))


def _joined(rows: DataFrame, dates: DataFrame, grace: int) -> DataFrame:
    """Stretches of `rows` (identity, VALUES, first_date, last_date), neighbours joined; next_date: where the identity's next stretch starts, missing:
    snapshots between, `grace` at most, as more change nothing, gone_date: the `grace`-th of them."""
    days = _numbered(dates)
    day = lambda d, n: days.select(F.col("as_of_date").alias(d), F.col("snapshot").alias(n))
    rows = rows.select("identity", *VALUES, "first_date", "last_date").join(day("first_date", "_first"), "first_date").join(day("last_date", "_last"), "last_date")
    w = Window.partitionBy("identity").orderBy(*(F.col(c).asc_nulls_first() for c in [*ORDER, "last_date"]))
    fresh = F.lag("_last").over(w).isNull() | (F.col("_first") - F.lag("_last").over(w) > 1)
    for c in VALUES:
        fresh = fresh | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    rows = rows.withColumn("_fresh", fresh.cast("int")).withColumn("_run", F.sum("_fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = rows.groupBy("identity", "_run", *VALUES).agg(*(f(c).alias(c) for f, c in ((F.min, "first_date"), (F.max, "last_date"), (F.min, "_first"), (F.max, "_last"))))
    v = Window.partitionBy("identity").orderBy("_run")
    runs = runs.crossJoin(F.broadcast(days.agg(F.max("snapshot").alias("_all")))).withColumns({"next_date": F.lead("first_date").over(v), "_next": F.coalesce(F.lead("_first").over(v), F.col("_all") + 1)})
    runs = runs.withColumn("missing", F.least(F.greatest(F.col("_next") - F.col("_last") - 1, F.lit(0)), F.lit(grace)).cast("int"))
    runs = runs.withColumn("_gone", F.when(F.col("missing") >= grace, F.col("_last") + grace))
    return runs.join(day("gone_date", "_gone"), "_gone", "left").select("identity", *VALUES, "first_date", "last_date", "next_date", "missing", "gone_date")


def _sightings(observations: DataFrame) -> DataFrame:
    return observations.select(listing_identity().alias("identity"), *VALUES, F.col("as_of_date").alias("first_date"), F.col("as_of_date").alias("last_date"))


def listing_stretches(observations: DataFrame, grace: int = 2) -> DataFrame:
    """The state of all snapshots at once."""
    return _joined(_sightings(observations), observations.select("as_of_date"), grace)


def apply_snapshot(stretches: DataFrame, dates: DataFrame, snapshot: DataFrame, date, grace: int = 2) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The state after the snapshot of `date`, whose rows are `snapshot`, before or after others: (new stretches of the touched identities, these identities, all dates).

    Touched are identities that the snapshot has, and those for which it counts as missing: seen around it, or gone for too short to be closed. A
    snapshot that comes again replaces the earlier one of its date; an empty one is a date on which all are missing.
    """
    day = F.lit(date).cast("date")
    dates = dates.select("as_of_date").union(snapshot.sparkSession.range(1).select(day.alias("as_of_date"))).distinct()
    around = dates.agg(F.max(F.when(F.col("as_of_date") < day, F.col("as_of_date"))).alias("_before"), F.min(F.when(F.col("as_of_date") > day, F.col("as_of_date"))).alias("_after"))
    seen = _sightings(snapshot.where(F.col("as_of_date") == day))
    spans = (F.col("first_date") <= day) & (F.col("last_date") >= day)
    waits = (F.col("last_date") < day) & (F.col("next_date").isNull() | (F.col("next_date") > day)) & (F.col("gone_date").isNull() | (F.col("gone_date") > day))
    touched = stretches.where(spans | waits).select("identity").union(seen.select("identity")).distinct()
    old = stretches.join(touched, "identity", "left_semi").crossJoin(F.broadcast(around))
    before = F.when(F.col("first_date") < day, F.struct("first_date", F.least("last_date", "_before").alias("last_date")))
    after = F.when(F.col("last_date") > day, F.struct(F.greatest("first_date", "_after").alias("first_date"), "last_date"))
    whole = F.when(~spans, F.array(F.struct("first_date", "last_date"))).otherwise(F.filter(F.array(before, after), lambda p: p.isNotNull()))
    pieces = old.select("identity", *VALUES, F.explode(whole).alias("_p")).select("identity", *VALUES, "_p.*")
    return _joined(pieces.unionByName(seen), dates, grace), touched, dates


def listing_versions(stretches: DataFrame, grace: int = 2) -> DataFrame:
    """U6 of the state: a version ends where symbol, exchange or type change, or at the `grace`-th snapshot in a row without the identity."""
    key = F.struct(*ORDER)
    w = Window.partitionBy("identity").orderBy(*(F.col(c).asc_nulls_first() for c in ORDER))
    gap = F.coalesce(F.lag("missing").over(w) >= grace, F.lit(False))
    fresh = gap | (F.row_number().over(w) == 1)
    for c in ("symbol", "exchange", "security_type"):
        fresh = fresh | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    rows = stretches.withColumns({"_gap": gap, "_fresh": fresh.cast("int")}).withColumn("version", F.sum("_fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    spans = rows.groupBy("identity", "version").agg(*(F.min_by(c, key).alias(c) for c in VALUES), F.min("first_date").alias("effective_from"), F.max("last_date").alias("last_seen"), F.max_by("gone_date", key).alias("_gone"), F.min_by("_gap", key).alias("_after_gap"))
    v = Window.partitionBy("identity").orderBy("version")
    end = F.when(F.lead("_after_gap").over(v), F.lit(None).cast("date")).otherwise(F.lead("effective_from").over(v))
    out = spans.withColumn("effective_to", F.coalesce(end, "_gone"))
    return out.withColumn("is_active", F.col("effective_to").isNull()).drop("_gone", "_after_gap")


def sightings_of(stretches: DataFrame) -> DataFrame:
    """The first observation of each stretch, from which U9 follows like from all."""
    return stretches.withColumnRenamed("first_date", "as_of_date")


def build_state(observations: DataFrame, path: str, grace: int = 2, buckets: int = BUCKETS) -> None:
    """Store the state of all snapshots at once under `path`: stretches in buckets of the identity, and the dates."""
    replace_groups(listing_stretches(observations, grace), f"{path}/stretches", ["identity"], buckets=buckets)
    replace_table(observations.select("as_of_date").distinct(), f"{path}/dates")


def read_state(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(stretches, dates), after finishing what a dead writer left."""
    recover_keyed(spark, f"{path}/stretches")
    recover(spark, f"{path}/dates")
    return spark.read.parquet(f"{path}/stretches"), spark.read.parquet(f"{path}/dates")


def update_state(snapshot: DataFrame, date, path: str, grace: int = 2, buckets: int = BUCKETS) -> None:
    """Merge one snapshot into the stored state; only the buckets of touched identities are rewritten. A snapshot merged again, also by a
    writer that died between the two tables, gives the same state."""
    spark = snapshot.sparkSession
    if not exists(spark, f"{path}/dates"):
        recover(spark, f"{path}/dates")
    if not exists(spark, f"{path}/dates"):
        build_state(snapshot.where(F.col("as_of_date") == F.lit(date).cast("date")), path, grace, buckets)
        return
    stretches, dates = read_state(spark, path)
    new, touched, dates = apply_snapshot(stretches, dates, snapshot, date, grace)
    replace_groups(new, f"{path}/stretches", ["identity"], touched, buckets)
    replace_table(dates, f"{path}/dates")
