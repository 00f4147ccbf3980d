"""The status log as a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portpulse.sources import sample

EVENT_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
)


def split_by_day(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write the sample events as one folder per day, as a feed would drop them."""
    events = sample.table(spark, sf_dir, "events")
    days = events.withColumn("day", F.col("ts").cast("date"))
    # Tasks of equal volume, however the events spread over the days.
    days.hint("rebalance", "day").write.partitionBy("day").parquet(path)


def stream_events(spark: SparkSession, path: str, files_per_batch: int = 16) -> DataFrame:
    """Streaming event files under ``path``."""
    return (
        spark.readStream.schema(EVENT_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
        .parquet(path)
    )


def stream_log(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """Streaming status log over event files under ``path``."""
    return sample.status_log(spark, sf_dir, stream_events(spark, path))
