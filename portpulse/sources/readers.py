"""Readers. A missing file is an error, never an empty table."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portpulse.functions.clock import to_datetime
from portpulse.schema import NORMALIZED, PERIOD_SHIFT_HOURS, conform


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a declared schema; bad rows fail the read."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(path)
    )


def read_normalized_parquet(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The seven operational tables, one parquet folder each."""
    return {
        name: conform(spark.read.parquet(f"{root}/{name}"), schema, name)
        for name, schema in NORMALIZED.items()
    }


def read_normalized_jdbc(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str],
    history_bounds: tuple[datetime | str, datetime | str],
    partitions: int = 64,
) -> dict[str, DataFrame]:
    """The seven operational tables over JDBC.

    The history is read in parallel slices between ``history_bounds``, its own first and
    last time: with narrower ones all older rows come in one slice. Filters on it are
    pushed into the database.
    """
    tables = {}
    for name, schema in NORMALIZED.items():
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", name)
        reader = reader.options(**dict(properties)).option("preferTimestampNTZ", True)
        if name == "port_status_history":
            lo, hi = history_bounds
            reader = (
                reader.option("partitionColumn", "updated_timestamp")
                .option("lowerBound", str(to_datetime(lo)))
                .option("upperBound", str(to_datetime(hi)))
                .option("numPartitions", partitions)
            )
        tables[name] = conform(reader.load(), schema, name)
    return tables


def _feature(properties: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField("properties", properties), T.StructField("geometry", T.StringType())]
    )


def read_boundaries(
    spark: SparkSession, path: str, key: str, properties: T.StructType
) -> DataFrame:
    """Attributes of the features of GeoJSON collections, keyed by one of them.

    The geometry stays the text it is.
    """
    document = T.StructType([T.StructField("features", T.ArrayType(_feature(properties)))])
    whole = spark.read.schema(document).option("mode", "FAILFAST").option("multiLine", True)
    features = whole.json(path).select(F.explode("features").alias("f"))
    return features.select("f.properties.*", F.col("f.geometry").alias("geometry")).where(
        F.col(key).isNotNull()
    )


def read_boundary_lines(
    spark: SparkSession, path: str, key: str, properties: T.StructType
) -> DataFrame:
    """The same for newline-delimited features, which Spark can split."""
    rows = spark.read.schema(_feature(properties)).option("mode", "FAILFAST").json(path)
    return rows.select("properties.*", "geometry").where(F.col(key).isNotNull())


def read_fact(
    spark: SparkSession,
    path: str,
    state: str | None,
    start: datetime | str,
    end: datetime | str,
    shift_hours: int = PERIOD_SHIFT_HOURS,
) -> DataFrame:
    """The periods of one state (or of all) that hold a range of local time.

    Periods are ``shift_hours`` ahead of UTC and no state is further ahead, so a local
    time lies in the period of its own month or, in its last hours, in the next one.
    The filters are on partition columns, so other states and months are not listed
    into the scan.
    """
    return of_range(spark.read.parquet(path), state, start, end, shift_hours)


def of_range(
    table: DataFrame,
    state: str | None,
    start: datetime | str,
    end: datetime | str,
    shift_hours: int = PERIOD_SHIFT_HOURS,
) -> DataFrame:
    """Rows of a table stored by state and period that may lie in a range of local time."""
    lo, hi = to_datetime(start), to_datetime(end) + timedelta(hours=shift_hours)
    month = F.col("year") * 12 + F.col("month")
    if state is not None:
        table = table.where(F.col("state") == state)
    return table.where(
        F.col("year").between(lo.year, hi.year)
        & month.between(lo.year * 12 + lo.month, hi.year * 12 + hi.month)
    )
