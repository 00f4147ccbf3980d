"""The monthly report: snapshots with an Overall row, rankings, breakdowns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portpulse.functions.clock import epoch_second, from_epoch_second
from portpulse.functions.rates import metric_seconds, percent, rate
from portpulse.functions.scale import all_not_null
from portpulse.operators.durations import half_hours, is_runs
from portpulse.operators.metrics import SITE_PORT_COUNT
from portpulse.functions.scale import settle
from portpulse.schema import (
    METRICS,
    OVERALL,
    SITE_KEYS,
    STATUSES,
    TOTAL,
    UNAVAILABILITY_PARTS_REPORT,
)


def share(name: str) -> str:
    return "out_of_order_prop" if name == "Out of order" else f"{name}_prop"


def _shares(statuses: Sequence[str]) -> list[Column]:
    return [rate(v, statuses).alias(share(v)) for v in [*METRICS, *statuses]]


def latest_interval(df: DataFrame) -> Column:
    """The last interval of a table, as a scalar; of a plain scan it is cheap."""
    if is_runs(df):
        return df.select(from_epoch_second(F.max("_to"))).scalar()
    return df.select(F.max("interval")).scalar()


def interval_count(df: DataFrame) -> Column:
    return df.select(F.count_distinct("interval")).scalar()


def snapshot(
    sites: DataFrame,
    groups: Sequence[str],
    latest: Column | None = None,
    statuses: Sequence[str] = STATUSES,
) -> DataFrame:
    """Shares of time per group, plus the same without the operator as ``Overall``.

    ``value`` is the number of ports at the latest interval, ``evse_port_site_count``
    its sum over time. Both levels and the port count come from one aggregation over
    grouping sets, after the rows of a group have been summed. ``latest`` may come from
    the table the sites were made of, which saves making them twice. ``sites`` has half hours,
    or runs that add up to them (``metrics.site_runs``), which count for as many.
    """
    groups = list(groups)
    others = [g for g in groups if g != "cpo_name"]
    values = [*statuses, TOTAL, SITE_PORT_COUNT]
    latest = latest_interval(sites) if latest is None else latest
    times, at_latest = F.lit(1), F.col("interval") == latest
    if is_runs(sites):
        times, at_latest = half_hours(), epoch_second(latest).between(F.col("_from"), F.col("_to"))
    base = (
        sites.where(all_not_null(groups))
        .groupBy(*groups)
        .agg(
            *[F.sum(F.col(v) * times).alias(v) for v in values],
            F.sum(F.when(at_latest, F.col(SITE_PORT_COUNT))).alias("value"),
        )
    )
    sets = base.groupingSets([[F.col(g) for g in groups], [F.col(g) for g in others]], *[F.col(g) for g in groups])
    rows = sets.agg(
        F.grouping("cpo_name").alias("_overall"),
        *[F.sum(v).alias(v) for v in [*values, "value"]],
    )
    rows = rows.where(F.col("value").isNotNull()).withColumn(
        "cpo_name", F.when(F.col("_overall") == 1, F.lit(OVERALL)).otherwise(F.col("cpo_name"))
    )
    rows = rows.withColumns(metric_seconds(statuses, UNAVAILABILITY_PARTS_REPORT))
    return rows.select(*groups, SITE_PORT_COUNT, *_shares(statuses), "value")


def site_report(
    sites: DataFrame, intervals: Column | None = None, statuses: Sequence[str] = STATUSES
) -> DataFrame:
    """Shares in percent per site over the whole period, and its mean port count."""
    values = [*statuses, TOTAL, SITE_PORT_COUNT]
    intervals = interval_count(sites) if intervals is None else intervals
    rows = (
        sites.where(all_not_null(SITE_KEYS))
        .groupBy(*SITE_KEYS)
        .agg(*[F.sum(v).alias(v) for v in values])
        .withColumns(metric_seconds(statuses, UNAVAILABILITY_PARTS_REPORT))
    )
    return rows.select(
        *SITE_KEYS,
        F.try_divide(F.col(SITE_PORT_COUNT).cast("double"), intervals).alias(SITE_PORT_COUNT),
        *[percent(rate(v, statuses)).alias(share(v)) for v in [*METRICS, *statuses]],
    )


def without_overall(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("cpo_name") != OVERALL)


def ranked(
    rows: DataFrame, by: Sequence[str], keep: Sequence[str], n: int | None = None
) -> DataFrame:
    """Rows without Overall, largest first, ties in key order; the first ``n`` if given."""
    keys = [c for c in ("lga_name", "cpo_name", "government_funded") if c in rows.columns]
    order = [F.col(b).desc_nulls_last() for b in by] + [F.col(k).asc() for k in keys]
    result = without_overall(rows).orderBy(*order).select(*keep)
    return result if n is None else result.limit(n)


UTILISATION_TABLE = ["lga_name", "cpo_name", "Utilisation_prop", "Uptime_prop", "value"]
UNAVAILABILITY_TABLE = ["lga_name", "cpo_name", "Unavailability_prop", "value"]
UTILISATION_BREAKDOWN = [
    "lga_name",
    "cpo_name",
    "Charging_prop",
    "Finishing_prop",
    "Reserved_prop",
    "Available_prop",
]
UNAVAILABILITY_BREAKDOWN = [
    "lga_name",
    "cpo_name",
    "Unavailable_prop",
    "out_of_order_prop",
    "Unknown_prop",
    "Missing_prop",
]


def top_utilisation(areas: DataFrame, n: int = 10) -> DataFrame:
    return ranked(areas, ["Utilisation_prop", "Uptime_prop"], UTILISATION_TABLE, n)


def top_unavailability(areas: DataFrame, n: int = 10) -> DataFrame:
    return ranked(areas, ["Unavailability_prop"], UNAVAILABILITY_TABLE, n)


def top_utilisation_breakdown(areas: DataFrame, n: int = 10) -> DataFrame:
    return ranked(areas, ["Utilisation_prop"], UTILISATION_BREAKDOWN, n)


def top_unavailability_breakdown(areas: DataFrame, n: int = 10) -> DataFrame:
    return ranked(areas, ["Unavailability_prop"], UNAVAILABILITY_BREAKDOWN, n)


def funded_uptime_table(areas: DataFrame) -> DataFrame:
    return ranked(
        areas, ["Uptime_prop", "Utilisation_prop"], ["government_funded", *UTILISATION_TABLE]
    )


def funded_unavailability_table(areas: DataFrame) -> DataFrame:
    return ranked(areas, ["Unavailability_prop"], ["government_funded", *UNAVAILABILITY_TABLE])


def numbered(
    rows: DataFrame, by: Sequence[str], keep: Sequence[str], name: str = "rank"
) -> DataFrame:
    """The rows of :func:`ranked` with their place, for tables whose order matters.

    Places are counted inside ranges of the order and shifted by the rows of the ranges before.
    """
    keys = [c for c in ("lga_name", "cpo_name", "government_funded") if c in rows.columns]
    order = [F.col(b).desc_nulls_last() for b in by] + [F.col(k).asc() for k in keys]
    ranges = settle(
        without_overall(rows).repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    )
    # a line for each range
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = offsets.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) + F.col("_before")
    return ranges.join(offsets, "_range").select(place.cast("int").alias(name), *keep)


def area_extremes(areas: DataFrame, shares: Sequence[str]) -> DataFrame:
    """Best and worst area per share, and the largest and smallest, with their rates."""
    rows = without_overall(areas).withColumn("size", F.col("value").cast("double"))
    rates = ["Utilisation_prop", "Uptime_prop", "Unavailability_prop", "value"]
    return extremes(rows, [*shares, "size"], ["lga_name", "cpo_name", *rates])


def mostly_unavailable(areas: DataFrame, above: float = 0.5) -> DataFrame:
    return without_overall(areas).where(F.col("Unavailable_prop") > above)


def top_three(areas: DataFrame, variable: str) -> DataFrame:
    return ranked(areas, [variable], ["lga_name", "cpo_name", "value", variable], 3)


def charging_summary(areas: DataFrame) -> DataFrame:
    """What the report says of the three areas that charge most."""
    areas = settle(areas)  # a line for each area and operator, read twice
    top = top_three(areas, "Charging_prop")
    unavailable = mostly_unavailable(areas).agg(
        F.coalesce(F.sum("value"), F.lit(0)).cast("bigint").alias("n")
    )
    return top.agg(
        F.mode("cpo_name", True).alias("most_frequent_cpo"),
        F.sum("value").cast("bigint").alias("ports_charging_most"),
        percent(F.min("Charging_prop")).alias("lowest_percent"),
        percent(F.max("Charging_prop")).alias("highest_percent"),
    ).withColumn("ports_mostly_unavailable", unavailable.scalar())


def extremes(
    rows: DataFrame, shares: Sequence[str], companions: Sequence[str] = ("cpo_name", "value")
) -> DataFrame:
    """Best and worst row per share, with companion columns; ties by operator name."""
    aggregates = []
    for s in shares:
        tie = F.struct(*[F.col(c) for c in companions])
        for which, sign in (("max", -1), ("min", 1)):
            packed = F.struct((F.col(s) * sign).alias("share"), tie.alias("row"))
            aggregates.append(F.min(F.when(F.col(s).isNotNull(), packed)).alias(f"_{s}_{which}"))
    found = rows.agg(*aggregates)
    lines = []
    for s in shares:
        for which, sign in (("max", -1), ("min", 1)):
            best = F.col(f"_{s}_{which}")
            lines.append(
                F.struct(
                    F.lit(s).alias("share_name"),
                    F.lit(which).alias("which"),
                    (best["share"] * sign).alias("share"),
                    *[best["row"][c].alias(c) for c in companions],
                )
            )
    return found.select(F.inline(F.array(*lines)))


def composition(rows: DataFrame, whole: str, parts: Sequence[str]) -> DataFrame:
    """In the row with the largest ``whole``: its largest part and that part's share."""
    best = rows.where(F.col(whole).isNotNull()).agg(
        F.min_by(
            F.struct("cpo_name", *parts), F.struct(-F.col(whole), F.col("cpo_name"))
        ).alias("r")
    )
    pairs = F.array(*[F.struct(F.col(f"r.{p}").alias("v"), F.lit(p).alias("name")) for p in parts])
    total = sum((F.col(f"r.{p}") for p in parts), F.lit(0.0))
    largest = F.array_max(pairs)
    return best.select(
        F.col("r.cpo_name").alias("cpo_name"),
        largest["name"].alias("largest_part"),
        percent(F.try_divide(largest["v"], total)).alias("largest_percent"),
    )


def available_ratio(rows: DataFrame) -> DataFrame:
    """How many times more Available the best operator is than the worst."""
    worst = F.min_by("Unavailable_prop", F.struct("Available_prop", "cpo_name"))
    return rows.agg(
        F.bround(F.try_divide(F.max("Available_prop"), F.min("Available_prop")), 1).alias("ratio"),
        percent(worst).alias("worst_unavailable_percent"),
    )


def area_distribution(areas: DataFrame, variable: str, at_least: int = 5) -> DataFrame:
    """Per operator: spread of a share over its areas, and whether it has enough of them.

    Operators with fewer areas are shown as single points instead.
    """
    value = percent(F.col(variable))
    quartiles = F.percentile("_v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return (
        without_overall(areas)
        .withColumn("_v", value)
        .groupBy("cpo_name")
        .agg(
            F.count(F.lit(1)).alias("areas"),
            F.min("_v").alias("lowest"),
            quartiles.alias("_q"),
            F.max("_v").alias("highest"),
        )
        .select(
            "cpo_name",
            "areas",
            (F.col("areas") >= at_least).alias("shown_as_box"),
            "lowest",
            F.col("_q")[0].alias("q1"),
            F.col("_q")[1].alias("median"),
            F.col("_q")[2].alias("q3"),
            "highest",
        )
    )


# Status share -> display name.
SEGMENTS = {
    "Charging_prop": "Charging",
    "Finishing_prop": "Finishing",
    "Reserved_prop": "Reserved",
    "Available_prop": "Available",
    "Unavailable_prop": "Unavailable",
    "out_of_order_prop": "Out of Order",
    "Unknown_prop": "Unknown",
    "Missing_prop": "Missing",
}


def segments(rows: DataFrame) -> DataFrame:
    """Status shares in percent, one row per operator and display name."""
    named = rows.select("cpo_name", *[F.col(c).alias(n) for c, n in SEGMENTS.items()])
    return named.unpivot("cpo_name", list(SEGMENTS.values()), "variable", "value").withColumn(
        "value", percent(F.col("value"))
    )
