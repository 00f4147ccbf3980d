"""Charging sessions of grant-funded ports."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portpulse.functions.clock import epoch_second, to_datetime
from portpulse.functions.scale import all_not_null, numbered_within
from portpulse.functions.text import place_text
from portpulse.operators.privacy import CPO_PRIVACY, Numbers, relabel
from portpulse.schema import BUCKET_SECONDS, NOT_FUNDED
from portpulse.sources.readers import of_range
from portpulse.sources.writers import replace_label

SESSION_KEYS = ["cpo_name", "location", "evse_id", "evse_port_id"]


def charging_rows(fact: DataFrame) -> DataFrame:
    """Half hours in which a funded port charged, with its location text."""
    return fact.where(
        (F.col("government_funded") != NOT_FUNDED) & (F.col("Charging") > 0)
    ).select(
        "cpo_name",
        place_text(F.col("address"), F.col("suburb"), F.col("postcode")).alias("location"),
        "evse_id",
        "evse_port_id",
        "power",
        "government_funded",
        "interval",
        F.col("Charging").alias("value"),
    )


def session_spans(fact: DataFrame, gap_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Runs of charging half hours with their first and last one; a gap longer than half an
    hour starts a new one.

    The ordered window holds one port's half hours only. Rows without power or
    location drop out.
    """
    rows = charging_rows(fact).where(
        all_not_null([*SESSION_KEYS, "power", "government_funded"])
    )
    spans = rows.withColumn("first", F.col("interval")).withColumnRenamed("interval", "last")
    return stitched(spans.withColumnRenamed("value", "charge_duration"), gap_seconds)


def stitched(spans: DataFrame, gap_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Spans of a port that follow each other within the gap, put together.

    Half hours are spans of their own; so are the sessions of single periods, of which
    the last of one and the first of the next may be one.
    """
    port = Window.partitionBy(*SESSION_KEYS).orderBy("first", "last")
    gap = epoch_second(F.col("first")) - epoch_second(F.lag("last").over(port))
    running = port.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        spans.withColumn("_new", F.when(gap > gap_seconds, 1).otherwise(0))
        .withColumn("session", F.sum("_new").over(running))
        .groupBy(*SESSION_KEYS, "session", "power", "government_funded")
        .agg(
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            F.sum("charge_duration").cast("bigint").alias("charge_duration"),
        )
    )


def as_sessions(spans: DataFrame) -> DataFrame:
    return spans.withColumnRenamed("first", "session_start_interval").drop("last")


def charging_sessions(fact: DataFrame, gap_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """The sessions of :func:`session_spans`."""
    return as_sessions(session_spans(fact, gap_seconds))


def store_period(fact: DataFrame, path: str, period_start: datetime | str) -> None:
    """Store the sessions of one period's rows in place of the former ones."""
    begin = to_datetime(period_start)
    label = {"year": begin.year, "month": begin.month}
    replace_label(session_spans(fact).drop("session"), path, label, ("year", "month"), "evse_port_id")


def stored_sessions(
    spark: SparkSession, path: str, start: datetime | str, end: datetime | str, gap_seconds: int = BUCKET_SECONDS
) -> DataFrame:
    """Sessions of the stored periods that hold a range of local time: those that a period's
    border cuts are whole again. Reads session rows, not half hours."""
    stored = of_range(spark.read.parquet(path), None, start, end).drop("year", "month")
    return as_sessions(stitched(stored, gap_seconds))


def streamed_sessions(rows: DataFrame, late: str = "1 day", gap_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Sessions of a stream of :func:`charging_rows`, for append mode: one is given out once
    nothing that comes within ``late`` can prolong it."""
    moment = F.col("interval").cast("timestamp")  # event time is a zoned type; the session's zone must be UTC
    window = F.session_window("_at", f"{gap_seconds + 1} seconds")
    return (
        rows.where(all_not_null([*SESSION_KEYS, "power", "government_funded"]))
        .withColumn("_at", moment)
        .withWatermark("_at", late)
        .groupBy(*SESSION_KEYS, "power", "government_funded", window.alias("_w"))
        .agg(F.sum("value").cast("bigint").alias("charge_duration"))
        .select(
            *SESSION_KEYS, "power", "government_funded",
            F.col("_w.start").cast("timestamp_ntz").alias("session_start_interval"), "charge_duration",
        )
    )


def session_table(
    sessions: DataFrame, privacy: Mapping[str, bool] = CPO_PRIVACY, numbers: Numbers = numbered_within
) -> DataFrame:
    """The sessions as handed out: relabelled (``numbers`` as in ``relabel``), with energy and minutes."""
    start = F.col("session_start_interval")
    seconds = F.col("charge_duration")
    day = F.date_format(start.cast("date"), "yyyy-MM-dd")

    def two(n):
        return F.lpad(n.cast("string"), 2, "0")

    clock = F.concat_ws(":", two(F.hour(start)), two(F.minute(start)), two(F.second(start)))
    return relabel(sessions, privacy, numbers).select(
        clock.alias("start_interval"),
        day.alias("date"),
        "cpo_name",
        "location",
        "charge_station",
        "connector",
        "government_funded",
        F.bround(F.col("power") * (seconds / F.lit(3600.0)), 0).alias("max_usage_kwh"),
        F.bround(seconds / F.lit(60.0), 1).alias("charge_duration_min"),
    )
