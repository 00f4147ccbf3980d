"""From the dense table to rates per group and calendar bin.

The tables here are wide: one row per port (charger, group) and interval with one
column of seconds per status. That is an eighth of the rows of the long form in
every shuffle, and metrics and rates are row arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portpulse.functions.clock import (
    bucket_start,
    clock_changes,
    from_epoch_second,
    local_time,
    local_second_between,
    local_time_between,
    midnight,
    ntz,
    seconds_of,
    to_datetime,
)
from portpulse.functions.rates import metric_seconds, rate
from portpulse.functions.scale import all_not_null, parts_for, settle
from portpulse.operators import durations
from portpulse.schema import (
    BUCKET_SECONDS,
    EVSE_KEYS,
    METRICS,
    NOT_FUNDED,
    PORT_KEYS,
    SITE_KEYS,
    STATUSES,
    TOTAL,
)

PORT_COUNT = "evse_port_count"
SITE_PORT_COUNT = "evse_port_site_count"
#: Rows of ports that one task folds and counts, about.
PORT_ROWS = 500_000


def with_location(durations: DataFrame, location: DataFrame) -> DataFrame:
    """Durations of the ports that have a location; ports without one drop out."""
    return durations.join(location, PORT_KEYS)


def pivot_statuses(
    long: DataFrame, ids: Sequence[str], variable: str, value: str, statuses: Sequence[str]
) -> DataFrame:
    """Long -> wide over a declared list of statuses; an absent cell is null."""
    sums = [F.sum(F.when(F.col(variable) == s, F.col(value))).alias(s) for s in statuses]
    return long.groupBy(*ids).agg(*sums)


def dashboard_names(fact: DataFrame) -> DataFrame:
    return fact.withColumnsRenamed(
        {"update_time": "interval", "status": "variable", "status_duration": "value"}
    )


def in_local_time(df: DataFrame, column: str = "interval") -> DataFrame:
    """UTC -> local wall-clock time of the row's state; unknown states stay on UTC."""
    return df.withColumn(column, local_time(F.col(column), F.col("state")))


def local_between_dates(
    df: DataFrame, start: datetime | str, end: datetime | str, column: str = "interval"
) -> DataFrame:
    """Rows whose local time is between two moments, both inclusive, in local time.

    The coarse bounds on the UTC column reach the scan.
    """
    margin = timedelta(days=1)
    at = F.col(column)
    coarse = at.between(ntz(to_datetime(start) - margin), ntz(to_datetime(end) + margin))
    local = local_time_between(at, F.col("state"), start, end)
    return between_dates(df.where(coarse).withColumn(column, local), start, end)


def local_runs(runs: DataFrame, start: datetime | str, end: datetime | str) -> DataFrame:
    """:func:`local_between_dates` for runs: moved to local time and clipped.

    A run in which the clocks change falls into its half hours, so that in local time
    too a run has all half hours between its ends.
    """
    margin = 86_400
    near = (F.col("_to") >= seconds_of(start) - margin) & (F.col("_from") <= seconds_of(end) + margin)
    begin, last = F.col("_from"), F.col("_to")

    def local(second: Column) -> Column:
        return local_second_between(second, F.col("state"), start, end)

    changes = [
        F.col("state").isin(states) & (begin < second) & (last >= second)
        for states, second in clock_changes(start, end)
    ]
    moved = runs.where(near)
    if changes:
        steady = ~F.coalesce(reduce(or_, changes), F.lit(False))
        width = F.lit(BUCKET_SECONDS).cast("bigint")
        moved = moved.withColumn("_steady", steady).withColumn(
            "_at", F.explode(F.sequence(begin, F.when(F.col("_steady"), begin).otherwise(last), width))
        )
        moved = moved.withColumns({"_from": F.col("_at"), "_to": F.when(F.col("_steady"), last).otherwise(F.col("_at"))})
        moved = moved.drop("_steady", "_at")
    return runs_between(moved.withColumns({"_from": local(begin), "_to": local(last)}), start, end)


def runs_between(runs: DataFrame, start: datetime | str, end: datetime | str) -> DataFrame:
    """:func:`between_dates` for runs: each keeps its half hours between two moments, both inclusive."""
    width = F.lit(BUCKET_SECONDS).cast("bigint")
    lo = to_datetime(start)
    lo_s, hi_s = seconds_of(lo) + (1 if lo.microsecond else 0), seconds_of(end)
    begin, last = F.col("_from"), F.col("_to")

    def steps(seconds: Column) -> Column:
        """Whole half hours that cover so many seconds, in seconds."""
        up = F.greatest(seconds, F.lit(0).cast("bigint")) + width - 1
        return up - F.pmod(up, width)

    clipped = runs.withColumns({"_from": begin + steps(F.lit(lo_s) - begin), "_to": last - steps(last - F.lit(hi_s))})
    return clipped.where(begin <= last)


def between_dates(df: DataFrame, start: datetime | str, end: datetime | str) -> DataFrame:
    """Both bounds inclusive; an end given as a date means its midnight only."""
    return df.where(F.col("interval").between(ntz(start), ntz(end)))


def funding_filter(choice: str) -> Column:
    funded = F.col("government_funded")
    return {
        "funded": funded != NOT_FUNDED,
        "not_funded": funded == NOT_FUNDED,
        "all": funded.isNotNull(),
    }[choice]


def area_filter(
    df: DataFrame, areas: Sequence[str], cpos: Sequence[str], funding: str = "all"
) -> DataFrame:
    return df.where(
        F.col("lga_name").isin(list(areas))
        & F.col("cpo_name").isin(list(cpos))
        & funding_filter(funding)
    )


def months_spanned(df: DataFrame, column: str = "interval") -> DataFrame:
    """Whole months between the first and the last interval, across year ends.

    Quarter and year roll-ups make sense from three months up.
    """
    first, last = F.min(column), F.max(column)
    months = (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first)
    return df.agg(
        months.cast("bigint").alias("months"),
        (months >= 3).alias("long_bins"),
    )


def suburb_names(df: DataFrame, locations: DataFrame) -> DataFrame:
    """Add the display name of each postcode (the last one, if it has several)."""
    names = locations.groupBy(F.col("postcode").cast("string").alias("postcode")).agg(
        F.max("suburb").alias("suburb_name")
    )
    return (
        df.withColumn("postcode", F.col("postcode").cast("string"))
        .join(names, "postcode", "left")
        .withColumn("suburb_name", F.coalesce("suburb_name", F.lit("Unknown Suburb")))
    )


def month_starts(df: DataFrame, column: str) -> DataFrame:
    """First of each month from January of the first year to January after the last."""
    bounds = df.agg(
        F.make_date(F.min(F.year(column)), F.lit(1), F.lit(1)).alias("lo"),
        F.make_date(F.max(F.year(column)) + 1, F.lit(1), F.lit(1)).alias("hi"),
    )
    step = F.make_ym_interval(F.lit(0), F.lit(1))
    months = bounds.select(F.explode(F.sequence("lo", "hi", step)).alias("month_start"))
    return months.select(midnight(F.col("month_start")).alias("month_start"))


def evse_level(
    fact: DataFrame, statuses: Sequence[str] = STATUSES, more_keys: Sequence[str] = ()
) -> DataFrame:
    """Port rows -> charger rows: summed seconds and the number of distinct ports."""
    keys = [*EVSE_KEYS, *more_keys, "interval"]
    count = _runs_with_port_count if durations.is_runs(fact) else _with_port_count
    return count(fact, keys, "evse_id", ["evse_port_id"], PORT_COUNT, statuses)


def site_level(fact: DataFrame, statuses: Sequence[str] = STATUSES) -> DataFrame:
    """Port rows -> site rows, the report's input, with distinct ports per interval."""
    keys = [*SITE_KEYS, "interval"]
    count = _runs_with_port_count if durations.is_runs(fact) else _with_port_count
    return count(fact, keys, "address", PORT_KEYS, SITE_PORT_COUNT, statuses)


def _with_port_count(
    fact: DataFrame,
    keys: Sequence[str],
    spread: str,
    port: Sequence[str],
    name: str,
    statuses: Sequence[str],
) -> DataFrame:
    """Sums plus a distinct count, null keys dropped.

    Ports are folded first and counted next, so neither step holds a set of ports
    per group in memory. Both steps share one shuffle on a part of their keys; the
    interval in it spreads a crowded charger or site over as many tasks as there
    are half hours. Tasks hold their groups, so there are as many as the rows need: their
    few bytes in the shuffle would make too few.
    """
    values = [*statuses, TOTAL]
    per_port = (
        fact.where(all_not_null(keys))
        .repartition(parts_for(fact, PORT_ROWS), spread, "interval")
        .groupBy(*keys, *[c for c in port if c not in keys])
        .agg(*[F.sum(v).alias(v) for v in values])
    )
    counted = F.count(F.when(all_not_null(port), 1)).alias(name)
    return per_port.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values], counted)


def _runs_with_port_count(
    runs: DataFrame,
    keys: Sequence[str],
    spread: str,
    port: Sequence[str],
    name: str,
    statuses: Sequence[str],
) -> DataFrame:
    """:func:`_with_port_count` of runs of equal half hours.

    Runs are dealt by charger or site and day and become half hours only in the task that sums
    them. A run counts its port in those half hours of its day that no earlier run of the port
    has, which a bit each tells, so ports are folded by run and not by half hour.
    """
    values = [*statuses, TOTAL]
    keys = [k for k in keys if k != "interval"]
    parts = parts_for(runs, PORT_ROWS, durations.half_hours())
    days = durations.by_day(runs.where(all_not_null(keys))).repartition(parts, spread, "_day")
    slot, bits = durations.SLOT, durations.day_bits()
    of_port = Window.partitionBy(*dict.fromkeys([*keys, *port]), "_day").orderBy("_from", "_to")
    before = F.bit_or("_bits").over(of_port.rowsBetween(Window.unboundedPreceding, -1))
    new = F.col("_bits").bitwiseAND(F.bitwise_not(F.coalesce(before, F.lit(0).cast("bigint"))))
    rows = (
        days.withColumn("_bits", bits)
        .withColumn("_new", F.when(all_not_null(port), new).otherwise(F.lit(0).cast("bigint")))
        .select(*keys, "_day", "_new", *values, F.explode(F.sequence("_from", "_to", F.lit(BUCKET_SECONDS).cast("bigint"))).alias("_at"))
    )
    counted = F.sum(F.bit_get("_new", F.expr(slot % "_at")).cast("bigint")).alias(name)
    level = rows.groupBy(*keys, "_day", "_at").agg(*[F.sum(v).alias(v) for v in values], counted)
    return level.select(*keys, from_epoch_second(F.col("_at")).alias("interval"), *values, name)


def evse_runs(
    runs: DataFrame, statuses: Sequence[str] = STATUSES, more_keys: Sequence[str] = ()
) -> DataFrame:
    """:func:`evse_level` of runs, as runs that add up to it."""
    return _runs_of_level(runs, [*EVSE_KEYS, *more_keys], ["evse_port_id"], PORT_COUNT, statuses)


def site_runs(runs: DataFrame, statuses: Sequence[str] = STATUSES) -> DataFrame:
    """:func:`site_level` of runs, as runs that add up to it."""
    return _runs_of_level(runs, SITE_KEYS, PORT_KEYS, SITE_PORT_COUNT, statuses)


def _runs_of_level(
    runs: DataFrame, keys: Sequence[str], port: Sequence[str], name: str, statuses: Sequence[str]
) -> DataFrame:
    """:func:`_runs_with_port_count` left as runs: a half hour's row is the sum of the runs that cover it.

    Seconds add up over ports as they are, so their runs need no shuffle and no half hours.
    Ports are counted on their own: a port's half hours of a day are the bits of one
    integer, which combine map-side however often a port is listed or its runs overlap, and
    ports of a charger or site that have the same half hours become one run with their number.
    """
    values = [*statuses, TOTAL]
    zero = F.lit(0).cast("bigint")
    rows = runs.where(all_not_null(keys))
    of_port = list(dict.fromkeys([*keys, *port]))
    ports = (
        durations.by_day(rows.where(all_not_null(port)).select(*of_port, "_from", "_to"))
        .groupBy(*of_port, "_day")
        .agg(F.bit_or(durations.day_bits()).alias("_bits"))
        .groupBy(*keys, "_day", "_bits")
        .agg(F.count(F.lit(1)).alias(name))
    )
    counted = ports.select(*keys, name, F.inline(durations.runs_of_bits()))
    seconds = rows.select(*keys, "_from", "_to", *values, zero.alias(name))
    return seconds.unionByName(counted, allowMissingColumns=True)


def level_of_runs(
    runs: DataFrame, keys: Sequence[str], spread: str, name: str, statuses: Sequence[str] = STATUSES
) -> DataFrame:
    """The half hours of :func:`evse_runs` or :func:`site_runs`, made in the task that sums them."""
    values = [*statuses, TOTAL, name]
    parts = parts_for(runs, PORT_ROWS, durations.half_hours())
    days = durations.by_day(runs).repartition(parts, spread, "_day")
    half_hours = F.explode(F.sequence("_from", "_to", F.lit(BUCKET_SECONDS).cast("bigint"))).alias("_at")
    level = days.select(*keys, "_day", *values, half_hours).groupBy(*keys, "_day", "_at").agg(*[F.sum(v).alias(v) for v in values])
    return level.select(*keys, from_epoch_second(F.col("_at")).alias("interval"), *values)


def long_variables(
    wide: DataFrame, count: str = PORT_COUNT, statuses: Sequence[str] = STATUSES
) -> DataFrame:
    """Wide -> long with the port count as one more variable."""
    values = [*statuses, TOTAL, count]
    ids = [c for c in wide.columns if c not in values]
    return wide.unpivot(ids, values, "variable", "value").where(F.col("value").isNotNull())


# --- calendar bins ---------------------------------------------------------
_STEP = {
    "30min": "INTERVAL '30' MINUTE",
    "60min": "INTERVAL '60' MINUTE",
    "1440min": "INTERVAL '1' DAY",
    "10080min": "INTERVAL '7' DAY",
    "ME": "INTERVAL '1' MONTH",
    "Q": "INTERVAL '3' MONTH",
    "Y": "INTERVAL '12' MONTH",
}
INTERVALS = list(_STEP)


def bin_start(ts: Column, interval: str, first_day: Column) -> Column:
    """Start of the bin of ``ts``. Weeks count from the group's own first day."""
    day = ts.cast("date")
    if interval == "30min":
        return bucket_start(ts, 1800)
    if interval == "60min":
        return bucket_start(ts, 3600)
    if interval == "1440min":
        return midnight(day)
    if interval == "10080min":
        days = F.date_diff(day, first_day)
        return midnight(F.date_sub(day, F.pmod(days, F.lit(7)).cast("int")))
    if interval == "ME":
        return midnight(F.make_date(F.year(ts), F.month(ts), F.lit(1)))
    if interval == "Q":
        month = (F.quarter(ts) - 1) * 3 + 1
        return midnight(F.make_date(F.year(ts), month, F.lit(1)))
    if interval == "Y":
        return midnight(F.make_date(F.year(ts), F.lit(1), F.lit(1)))
    raise ValueError(f"interval must be one of {INTERVALS}, not {interval!r}")


def bin_label(start: Column, interval: str) -> Column:
    """Month, quarter and year bins carry their last day, the others their start."""
    if interval == "ME":
        return midnight(F.last_day(start.cast("date")))
    if interval == "Q":
        return midnight(F.last_day(F.add_months(start.cast("date"), 2)))
    if interval == "Y":
        return midnight(F.make_date(F.year(start), F.lit(12), F.lit(31)))
    return start


def rollup(
    evse: DataFrame,
    keys: Sequence[str],
    interval: str,
    statuses: Sequence[str] = STATUSES,
    count: str = PORT_COUNT,
) -> DataFrame:
    """Rates in percent per group, port count and calendar bin.

    ``evse`` has half hours, or runs that add up to them (:func:`evse_runs`). Each group's bins run from its own first to its own last one; a bin without
    rows has 0 time and null rates. A change in the port count starts a new series.
    Gaps are filled from one row to the next in the ordered group, which holds at
    most one row per bin, so no table of bins is built or joined.
    """
    values = [*statuses, TOTAL]
    if durations.is_runs(evse):
        rows = _group_rows(evse, keys, interval, values, count)
    else:
        rows = (
            evse.where(all_not_null([*keys, "interval"]))
            .groupBy(*keys, "interval")
            .agg(*[F.sum(v).alias(v) for v in values], F.sum(count).alias(count))
        )
    rows = rows.withColumns(metric_seconds(statuses)).where(F.col(count).isNotNull())
    series = [*keys, count]
    summed = [*METRICS, *values]
    first_day = F.min(F.col("interval").cast("date")).over(Window.partitionBy(*series))
    start = bin_start(F.col("interval"), interval, F.col("_day0"))
    rows = rows.withColumn("_day0", first_day) if interval == "10080min" else rows
    bins = (
        rows.withColumn("_bin", start)
        .groupBy(*series, "_bin")
        .agg(*[F.coalesce(F.sum(v), F.lit(0)).alias(v) for v in summed])
    )
    following = F.lead("_bin").over(Window.partitionBy(*series).orderBy("_bin"))
    step = F.expr(_STEP[interval])
    covered = F.sequence("_bin", F.coalesce(F.col("_next") - step, F.col("_bin")), step)
    filled = bins.withColumn("_next", following).select("*", F.explode(covered).alias("_at"))
    own = F.col("_at") == F.col("_bin")
    filled = filled.select(
        *series,
        bin_label(F.col("_at"), interval).alias("interval"),
        *[F.when(own, F.col(v)).otherwise(0).cast("bigint").alias(v) for v in summed],
    )
    return filled.select(
        *series, "interval", *[rate(v, statuses, 100.0).alias(v) for v in [*METRICS, *statuses]]
    )


def _group_rows(
    runs: DataFrame, keys: Sequence[str], interval: str, values: Sequence[str], count: str
) -> DataFrame:
    """A group's sums from runs: per half hour, or per day where its bins are made of days.

    Equal runs of a group are folded before they become half hours, and a day has no more
    than some hundred different ones. A day in which all ports of a group have the same half hours
    has one port count, so its seconds are summed as they are; only other days, and
    those with absent cells, are looked at by half hours.
    """
    summed = [*values, count]
    pieces = durations.by_day(runs.where(all_not_null(keys))).select(*keys, "_day", "_from", "_to", *summed)

    def by_half_hour(pieces: DataFrame) -> DataFrame:
        folded = pieces.groupBy(*keys, "_day", "_from", "_to").agg(*[F.sum(v).alias(v) for v in summed])
        half_hours = durations.unrolled(folded, [*keys, "update_time", *summed])
        rows = half_hours.groupBy(*keys, "update_time").agg(*[F.sum(v).alias(v) for v in summed])
        return rows.withColumnRenamed("update_time", "interval")

    if interval in ("30min", "60min"):
        return by_half_hour(pieces)
    bits, length = durations.day_bits(), durations.half_hours()
    ports = F.when(F.col(count) > 0, bits)
    absent = (F.col(count) == 0) & ~all_not_null(values)
    days = settle(
        pieces.groupBy(*keys, "_day").agg(
            *[F.sum(F.col(v) * length).alias(v) for v in values],
            F.sum(count).alias(count),
            F.bit_or(bits).alias("_bits"),
            F.min(ports).alias("_least"),
            F.max(ports).alias("_most"),
            F.count(F.when(absent, 1)).alias("_absent"),
        )
    )
    same = F.col("_most").isNull() | ((F.col("_least") == F.col("_most")) & (F.col("_most") == F.col("_bits")))
    even = same & (F.col("_absent") == 0)
    rows = days.where(even).select(*keys, from_epoch_second(F.col("_day")).alias("interval"), *summed)
    uneven = days.where(~even).select(*keys, "_day")
    if uneven.isEmpty():
        return rows
    return rows.unionByName(by_half_hour(pieces.join(uneven, [*keys, "_day"], "left_semi")))


CPO_ROLLUP: list[str] = ["cpo_name"]
SITE_ROLLUP = ["cpo_name", "address", "suburb", "postcode", "latitude", "longitude"]
POSTCODE_ROLLUP = ["postcode"]


def standing_rollups(
    evse: DataFrame,
    interval: str,
    funded_only: bool,
    statuses: Sequence[str] = STATUSES,
    only: Sequence[str] = ("cpo", "site", "postcode"),
) -> dict[str, DataFrame]:
    """The dashboard's three roll-ups, or some; operators are told apart only on funded data."""
    keys = {"cpo": CPO_ROLLUP if funded_only else [], "site": SITE_ROLLUP, "postcode": POSTCODE_ROLLUP}
    return {name: rollup(evse, keys[name], interval, statuses) for name in only}


def with_boundaries(df: DataFrame, boundaries: DataFrame, key: str) -> DataFrame:
    """Rows whose area has a boundary, with the boundary's attributes."""
    left = df.withColumn(key, F.col(key).cast("string"))
    return left.join(boundaries.withColumn(key, F.col(key).cast("string")), key)
