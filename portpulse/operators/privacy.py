"""Small-group privacy and coverage."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portpulse.functions.scale import numbered_within, path_exists, settle
from portpulse.schema import NOT_FUNDED
from portpulse.sources.writers import replace_label

#: Rows, group columns, key column and a name -> the number of each key in its group.
Numbers = Callable[[DataFrame, Sequence[str], str, str], DataFrame]


def shared_areas(fact: DataFrame) -> DataFrame:
    """Areas in which more than one operator has chargers that are not funded."""
    return (
        fact.where(F.col("government_funded") == NOT_FUNDED)
        .select("lga_name", "cpo_name")
        .distinct()
        .groupBy("lga_name")
        .agg(F.count(F.lit(1)).alias("cpo_count"))
        .where((F.col("cpo_count") > 1) & F.col("lga_name").isNotNull())
        .select("lga_name")
    )


def hide_single_operator_areas(fact: DataFrame) -> DataFrame:
    """Keep the rows of shared areas, and funded rows anywhere."""
    return in_shared_areas(fact, settle(shared_areas(fact)))


def in_shared_areas(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """The rows of some areas, and funded rows anywhere."""
    return (
        rows.join(shared.withColumn("_shared", F.lit(True)), "lga_name", "left")
        .where(F.col("_shared").isNotNull() | (F.col("government_funded") != NOT_FUNDED))
        .select(*rows.columns)
    )


def hidden_areas(everything: DataFrame, reported: DataFrame) -> DataFrame:
    """Areas with data that are not reported."""
    areas = reported.select("lga_name").distinct()
    return everything.select("lga_name").distinct().join(areas, "lga_name", "left_anti")


def coverage(everything: DataFrame, reported: DataFrame, population: DataFrame) -> DataFrame:
    """Reporting over hidden areas, and covered over all populated areas."""

    def areas(df: DataFrame, flag: str) -> DataFrame:
        return df.select("lga_name").distinct().withColumn(flag, F.lit(1))

    joined = (
        areas(everything, "_any")
        .join(areas(reported, "_reported"), "lga_name", "full")
        .join(areas(population, "_populated"), "lga_name", "full")
    )
    reporting = F.count("_reported")
    hidden = F.count(F.when(F.col("_any").isNotNull() & F.col("_reported").isNull(), 1))
    return joined.agg(
        reporting.alias("reporting_areas"),
        hidden.alias("hidden_areas"),
        F.try_divide(reporting.cast("double"), hidden.cast("double")).alias("reporting_ratio"),
        F.try_divide(
            F.count("_any").cast("double"), F.count("_populated").cast("double")
        ).alias("coverage_ratio"),
    )


# Operators with relabelled stations, and whether the operator and
# its locations are relabelled as well.
CPO_PRIVACY: Mapping[str, bool] = {
    "Exploren": False,
    "ChargeN'Go": False,
    "Wevolt": False,
    "Charge Post": False,
    "Sonic Charge": False,
    "CasaCharge": False,
    "Charge Hub": False,
}


@dataclass(frozen=True)
class LabelStore:
    """Numbers of identifiers that stay when others come: a dictionary that only grows.

    What a load brings for the first time is numbered, in key order, after what its group has
    already. A load that is run again numbers its own keys again.
    """

    spark: SparkSession
    path: str
    load: int

    def numbers(self, rows: DataFrame, group: Sequence[str], key: str, name: str) -> DataFrame:
        """As :func:`numbered_within`, with the numbers of earlier loads kept."""
        folder, columns = f"{self.path}/{name.strip('_')}", [*group, key]
        schema = ", ".join([*(f"{c} string" for c in columns), f"{name} bigint, load bigint"])
        told = path_exists(self.spark, folder)
        stored = self.spark.read.schema(schema).parquet(folder) if told else self.spark.createDataFrame([], schema)
        earlier = stored.where(F.col("load") < self.load).drop("load")
        fresh = rows.select(*columns).distinct().join(earlier, columns, "left_anti")
        last = earlier.groupBy(*group).agg(F.max(name).alias("_last"))
        new = numbered_within(fresh, group, key, "_nth").join(last, list(group), "left")
        number = F.col("_nth") + F.coalesce("_last", F.lit(0))
        given = settle(new.select(*columns, number.cast("bigint").alias(name)))
        replace_label(given, folder, {"load": self.load}, ("load",), key)
        return earlier.unionByName(given)


def relabel(
    sessions: DataFrame, privacy: Mapping[str, bool] = CPO_PRIVACY, numbers: Numbers = numbered_within
) -> DataFrame:
    """Replace identifiers by positions: Location i, station j, Port k, CPO n.

    Positions follow the sorted identifiers, so the same data always gets the same
    labels; with ``numbers`` of a :class:`LabelStore` they also stay when identifiers are
    added. Operators missing from ``privacy`` get no station and port labels.
    """
    known = sessions.where(F.col("cpo_name").isin(list(privacy)))
    places = known.select("cpo_name", "location", "evse_id", "evse_port_id").distinct()
    hidden = [c for c, hide in privacy.items() if hide]
    result = sessions
    for group, key, name, rows in (
        (["cpo_name"], "location", "_location_no", places.where(F.col("cpo_name").isin(hidden))),
        (["cpo_name", "location"], "evse_id", "_station_no", places),
        (["cpo_name", "location", "evse_id"], "evse_port_id", "_port_no", places),
    ):
        result = result.join(numbers(rows, group, key, name), [*group, key], "left")
    label = F.lit(None).cast("string")
    for n, cpo in enumerate(hidden, start=1):
        label = F.when(F.col("cpo_name") == cpo, F.lit(f"CPO {n}")).otherwise(label)
    return result.select(
        *[c for c in sessions.columns if c not in ("cpo_name", "location")],
        F.coalesce(label, "cpo_name").alias("cpo_name"),
        F.when(
            F.col("_location_no").isNotNull(),
            F.concat(F.lit("Location "), F.col("_location_no").cast("string")),
        )
        .otherwise(F.col("location"))
        .alias("location"),
        F.concat(F.lit("station "), F.col("_station_no").cast("string")).alias("charge_station"),
        F.concat(F.lit("Port "), F.col("_port_no").cast("string")).alias("connector"),
    )
