"""Operator outages: log rows to drop and synthetic rows to add."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portpulse.functions.clock import bucket_second, epoch_minute, epoch_second, ntz
from portpulse.functions.scale import settle
from portpulse.schema import BUCKET_SECONDS, MISSING, PORT_KEYS

CPO_PORT = ["cpo_name", *PORT_KEYS]


def closed_windows(windows: DataFrame, hi: datetime) -> DataFrame:
    """Windows with an end; one still open lasts to the end of the period."""
    return windows.select(
        "cpo_name",
        "offline_timestamp",
        F.coalesce("online_timestamp", ntz(hi)).alias("online_timestamp"),
    )


def windows_by_half_hour(windows: DataFrame) -> DataFrame:
    """One row per operator and half hour with the windows that touch it.

    Keyed by half hour so that the join with the log is an equi-join whose right key
    is unique: each log row meets at most one short array, and a busy operator's rows
    spread over as many keys as the period has half hours. Overlapping windows cover
    the same moments as one long window, so they are merged first, which keeps the
    arrays short however many outages are reported.
    """
    begin, end = F.col("offline_timestamp"), F.col("online_timestamp")
    touched = F.sequence(
        bucket_second(epoch_second(begin)),
        bucket_second(epoch_second(end)),
        F.lit(BUCKET_SECONDS).cast("bigint"),
    )
    key = ["cpo_name", "_bucket"]
    ordered = Window.partitionBy(*key).orderBy("offline_timestamp", "online_timestamp")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return (
        windows.where(end > begin)
        .select("*", F.explode(touched).alias("_bucket"))
        .withColumn("_before", F.max("online_timestamp").over(earlier))
        .withColumn("_starts", F.when(begin < F.col("_before"), 0).otherwise(1))
        .withColumn("_run", F.sum("_starts").over(ordered))
        .groupBy(*key, "_run")
        .agg(F.min("offline_timestamp").alias("off"), F.max("online_timestamp").alias("on"))
        .groupBy(*key)
        .agg(F.collect_list(F.struct("off", "on")).alias("_windows"))
    )


def flag_in_outage(log: DataFrame, windows: DataFrame, flag: str) -> DataFrame:
    """Add a boolean: is the row strictly inside a window of its operator?"""
    ts = F.col("update_time")

    def covers(w: Column) -> Column:
        return (ts > w["off"]) & (ts < w["on"])

    return (
        log.withColumn("_bucket", bucket_second(epoch_second(ts)))
        .join(windows_by_half_hour(windows), ["cpo_name", "_bucket"], "left")
        .withColumn(
            flag,
            F.when(F.col("_windows").isNull(), False).otherwise(F.exists("_windows", covers)),
        )
        .drop("_bucket", "_windows")
    )


def outside_outages(log: DataFrame, windows: DataFrame) -> DataFrame:
    """Drop the rows strictly inside an outage of their operator."""
    return flag_in_outage(log, windows, "_out").where(~F.col("_out")).drop("_out")


def synthetic_rows(ports: DataFrame, windows: DataFrame) -> DataFrame:
    """Two rows per port and window: back online, and gone ``Missing``.

    ``_times`` is passed on, where the windows have it.
    """
    more = [c for c in windows.columns if c == "_times"]
    pairs = ports.join(windows, "cpo_name")
    edges = F.array(
        F.struct(F.lit(None).cast("string").alias("status"), F.col("online_timestamp").alias("t")),
        F.struct(F.lit(MISSING).alias("status"), F.col("offline_timestamp").alias("t")),
    )
    return pairs.select(*CPO_PORT, *more, F.explode(edges).alias("_e")).select(
        *CPO_PORT, F.col("_e.status").alias("status"), F.col("_e.t").alias("update_time"), *more
    )


def repeated(rows: DataFrame) -> DataFrame:
    """Each row as many times as its ``_times`` says."""
    columns = [c for c in rows.columns if c != "_times"]
    return rows.select(*columns, F.explode(F.array_repeat(F.lit(0), F.col("_times").cast("int"))).alias("_i")).select(*columns)


def with_outage_rows(log: DataFrame, windows: DataFrame) -> DataFrame:
    """The log without rows inside outages, plus the synthetic rows of each window."""
    return repeated(counted_outage_rows(log, windows))


def counted_outage_rows(log: DataFrame, windows: DataFrame) -> DataFrame:
    """:func:`with_outage_rows` with equal windows taken once; ``_times`` tells how often they came.

    The status at ``online`` is the last one known before the outage. To find it,
    the port's rows are first reduced to the last one of each minute, split at any
    ``online`` moment inside that minute, so that the ordered window sees a number
    of rows bounded by the length of the period, however chatty a port is. Log rows
    themselves never enter a window.
    """
    once = F.lit(1).cast("bigint").alias("_times")
    windows = settle(windows.groupBy(*windows.columns).agg(F.count(F.lit(1)).alias("_times")))
    # Read for its ports, for the last known statuses and for its rows.
    kept = settle(outside_outages(log, windows))
    ports = kept.select(*CPO_PORT).distinct()
    synthetic = synthetic_rows(ports, windows)

    onlines = windows.groupBy(
        "cpo_name", epoch_minute(F.col("online_timestamp")).alias("_minute")
    ).agg(F.collect_list("online_timestamp").alias("_onlines"))
    ts = F.col("update_time")
    segment = F.when(F.col("_onlines").isNull(), 0).otherwise(
        F.size(F.filter("_onlines", lambda o: o < ts))
    )
    known = (
        kept.withColumn("_minute", epoch_minute(ts))
        .join(onlines, ["cpo_name", "_minute"], "left")
        .groupBy(*CPO_PORT, "_minute", segment.alias("_segment"))
        .agg(
            F.max_by("status", F.struct("update_time", "status")).alias("status"),
            F.max("update_time").alias("update_time"),
        )
        .select(*CPO_PORT, "status", "update_time", once, F.lit(False).alias("_added"))
    )
    back = synthetic.where(F.col("status").isNull()).withColumn("_added", F.lit(True))
    upto = (
        Window.partitionBy(*CPO_PORT)
        .orderBy("update_time", "_added")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = (
        known.unionByName(back)
        .withColumn("status", F.last("status", ignorenulls=True).over(upto))
        .where(F.col("_added"))
        .drop("_added")
    )
    gone = synthetic.where(F.col("status") == MISSING)
    logged = kept.select(*CPO_PORT, "status", "update_time", once)
    return logged.unionByName(filled).unionByName(gone)
