"""A place that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that the session names. A local session that names none gets a folder of its own; a cluster must name one."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again, for results that are used several times."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by `stored` that nothing reads any more."""
    for table in tables:
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            remove(table.sparkSession, folder)


def _at(spark: SparkSession, path: str):
    """(file system, path) as the cluster's own objects."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file by Spark's own file systems."""
    store, target = _at(spark, path)
    store.delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    store, target = _at(spark, path)
    return store.exists(target)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder or file a new path, whose parent is made."""
    store, target = _at(spark, path)
    goal = _at(spark, to)[1]
    store.mkdirs(goal.getParent())
    if not store.rename(target, goal):
        raise OSError(f"{path} can't be renamed to {to}")


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if it isn't there."""
    store, target = _at(spark, path)
    return sorted(f.getPath().getName() for f in store.listStatus(target)) if store.exists(target) else []


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    store, target = _at(spark, path)
    store.create(target, True).close()
