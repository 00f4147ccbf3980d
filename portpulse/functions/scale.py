"""Helpers that keep joins and rankings safe when the data is large or skewed."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: Folders made for sessions of one process, by application.
_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Where it is unset, a session of one process makes its own; on a cluster that is an
    error, as executors do not see each other's disks.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = own_folder(spark.sparkContext.master)
    return _OWN[app]


def own_folder(master: str) -> str:
    if not re.fullmatch(r"local(\[[^]]*\])?", master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="portpulse-")


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/settled-{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Delete all tables that this application has settled; none may be read any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read on from there.

    Done for tables that several later steps read. It cuts the lineage, survives the
    loss of an executor, and gives Spark the table's true size, so that a join
    broadcasts it only while it is below ``spark.sql.autoBroadcastJoinThreshold`` and
    falls back to a shuffled join, with adaptive skew handling, beyond that.
    :func:`release` deletes what a session has settled.
    """
    spark = df.sparkSession
    path = f"{_own_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts_for(df: DataFrame, rows: int, each: Column | None = None) -> int:
    """How many partitions of about ``rows`` rows ``df`` makes, at least one for each core.

    For a shuffle whose tasks hold far more than they read, where Spark's own choice by
    bytes read makes too few. Counts ``df``: of a stored table that reads file footers only.
    ``each`` tells how many rows a row of ``df`` stands for.
    """
    n = df.count() if each is None else df.agg(F.sum(each)).first()[0] or 0
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-n // rows))


def numbered_within(
    df: DataFrame, group: Sequence[str], key: str, name: str
) -> DataFrame:
    """1-based position of each distinct ``key`` inside its ``group``, in key order.

    Returns one row per distinct (group, key). No group is ever sorted in one
    task: distinct keys are range-partitioned on (group, key), numbered inside
    each range, and shifted by the number of keys in the group's earlier ranges.
    The cut is written down because both halves have to see the same one.
    """
    cols = [*group, key]
    ranges = settle(
        df.select(*cols)
        .distinct()
        .repartitionByRange(*cols)
        .withColumn("_range", F.spark_partition_id())
    )
    in_range = Window.partitionBy(*group, "_range").orderBy(key)
    earlier = (
        Window.partitionBy(*group)
        .orderBy("_range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        ranges.groupBy(*group, "_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_n")
    )
    return (
        ranges.withColumn("_pos", F.row_number().over(in_range))
        .join(offsets, [*group, "_range"])
        .select(*cols, (F.col("_pos") + F.col("_before")).cast("bigint").alias(name))
    )


def all_not_null(columns: Sequence[str]) -> Column:
    condition = F.lit(True)
    for c in columns:
        condition = condition & F.col(c).isNotNull()
    return condition
