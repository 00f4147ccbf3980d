"""Statistics over rolled-up rates."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portpulse.functions.clock import epoch_second, ntz, to_datetime, week_of_month
from portpulse.operators.metrics import PORT_COUNT
from portpulse.schema import LABELLED_VARIABLES


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows without any null."""
    return df.na.drop("any")


def standard_error(value: Column) -> Column:
    """Sample deviation over the root of the row count, null values counted too."""
    return F.stddev_samp(value) / F.sqrt(F.count(F.lit(1)))


def mean_se_labels(
    rates: DataFrame, groups: Sequence[str], variables: Sequence[str] = LABELLED_VARIABLES
) -> DataFrame:
    """Mean of each variable per group and a ``mean ± standard error`` label."""
    aggregates = []
    for v in variables:
        aggregates += [F.avg(v).alias(v), standard_error(F.col(v)).alias(f"_{v}_se")]

    def two_digits(name: str) -> Column:
        return F.coalesce(F.bround(F.col(name), 2).cast("string"), F.lit("nan"))

    labels = [
        F.concat(two_digits(v), F.lit(" ± "), two_digits(f"_{v}_se")).alias(f"{v}_label")
        for v in variables
    ]
    return rates.groupBy(*groups).agg(*aggregates).select(*groups, *variables, *labels)


def at_interval(
    rates: DataFrame, when: datetime | str, variables: Sequence[str] = LABELLED_VARIABLES
) -> DataFrame:
    """The rows of one interval, rounded to two digits."""
    return rates.where(F.col("interval") == ntz(when)).withColumns(
        {v: F.bround(F.col(v), 2) for v in variables}
    )


def period_number(ts: Column, interval: str) -> Column:
    """Position of a time inside its day, week, month or year."""
    numbers = {
        "60min": F.hour(ts) + 1,
        "1440min": F.weekday(ts) + 1,
        "10080min": week_of_month(ts),
        "ME": F.month(ts),
        "Q": F.quarter(ts),
        "Y": F.year(ts),
    }
    return numbers.get(interval, F.hour(ts)).cast("int")


def period_profile(rates: DataFrame, variable: str, interval: str) -> DataFrame:
    """Mean, deviation, count and standard error per operator and period position."""
    value = F.col(variable)
    return (
        rates.groupBy("cpo_name", period_number(F.col("interval"), interval).alias("period_number"))
        .agg(
            F.avg(value).alias("mean_status"),
            F.stddev_samp(value).alias("std_status"),
            F.count(value).alias("count_status"),
        )
        .withColumn(
            "std_err",
            F.bround(F.try_divide(F.col("std_status"), F.sqrt(F.col("count_status"))), 2),
        )
        .withColumn("mean_status", F.bround("mean_status", 2))
    )


def cpo_statistics(
    rates: DataFrame, start: datetime | str, end: datetime | str
) -> DataFrame:
    """Summary of each operator's series, all operators in one pass.

    The gap to the previous interval weighs the missing share; the first row takes
    the gap of the second. One row alone stands for its whole month.
    """
    series = Window.partitionBy("cpo_name").orderBy(PORT_COUNT, "interval")
    at = F.col("interval")
    last, following = F.lag("interval").over(series), F.lead("interval").over(series)

    def minutes(later: Column, earlier: Column) -> Column:
        return (epoch_second(later) - epoch_second(earlier)) / F.lit(60.0)

    gap = F.coalesce(minutes(at, last), minutes(following, at))
    rows = rates.withColumn("_gap", gap)
    observed = minutes(F.max("interval"), F.min("interval"))
    month_minutes = F.dayofmonth(F.last_day(F.max("interval").cast("date"))) * F.lit(1440.0)
    single = F.count(F.lit(1)) == 1
    weighted = F.try_divide(F.sum(F.col("Missing") / 100 * F.col("_gap")), observed) * 100
    days = (to_datetime(end) - to_datetime(start)).days
    return rows.groupBy("cpo_name").agg(
        F.avg("Uptime").alias("average_uptime"),
        F.min("Uptime").alias("minimum_uptime"),
        F.avg("Utilisation").alias("average_utilisation"),
        F.max("Utilisation").alias("max_utilisation"),
        F.max("Unavailability").alias("maximum_unavailability"),
        F.avg("Unavailability").alias("average_unavailability"),
        F.max(PORT_COUNT).alias("charge_station_count"),
        F.lit(days).cast("bigint").alias("period_duration"),
        F.when(single, month_minutes).otherwise(observed).alias("total_observed_time"),
        F.when(single, F.max("Missing")).otherwise(weighted).alias("missing_duration"),
    )
