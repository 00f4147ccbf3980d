"""Charging-network tables derived from the star-schema sample tables.

``events`` stands in for the status log (one port per ``user_id``), ``customer``
and ``nation`` for the sites. Everything is derived with Spark, so each table
grows with the sample it is read from.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portpulse.operators.location import state_of_postcode
from portpulse.schema import NORMALIZED, conform

PERIOD_START = "2024-01-02 00:00:00"
PERIOD_END = "2024-01-28 00:00:00"
REQUIRED_STATES = ["NSW", "ACT", "VIC", "QLD"]

# An error event this severe takes its operator's whole feed offline.
OUTAGE_SEVERITY = 300.0
PORTS_PER_EVSE = 3
EVSES_PER_SITE = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _evse(user_id: Column) -> Column:
    return F.floor(user_id / PORTS_PER_EVSE)


def _site(user_id: Column) -> Column:
    return F.floor(user_id / (PORTS_PER_EVSE * EVSES_PER_SITE))


def _evse_id(user_id: Column) -> Column:
    return F.concat(F.lit("E"), _evse(user_id).cast("string"))


def _port_id(user_id: Column) -> Column:
    return F.concat(F.lit("P"), user_id.cast("string"))


def status_name(event_type: Column, value: Column) -> Column:
    return (
        F.when(event_type == "view", "Available")
        .when(event_type == "click", "Charging")
        .when(event_type == "purchase", "Finishing")
        .when((event_type == "signup") & (value < 5), "Unknown")
        .when(event_type == "signup", "Reserved")
        .when((event_type == "error") & (value < 20), "Unavailable")
        .when((event_type == "error") & (value < 30), "Inoperative")
        .when((event_type == "error") & (value < 40), "Blocked")
        .otherwise("Out of order")
    )


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: the operator and the address parts of its site."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment"
    )
    region = F.col("n_regionkey")
    first_postcode = (
        F.when(region == 0, 2000)
        .when(region == 1, 2605)
        .when(region == 2, 3000)
        .when(region == 3, 4000)
        .otherwise(5900)
    )
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("site"),
        F.col("c_mktsegment").alias("cpo_name"),
        F.col("c_name").alias("address"),
        F.concat(F.lit("Suburb "), region.cast("string")).alias("suburb"),
        (first_postcode + F.col("c_nationkey") % 3).cast("int").alias("postcode"),
        F.concat(F.lit("LGA "), (F.col("c_nationkey") % 8).cast("string")).alias("lga_name"),
        (F.lit(-35.0) + (F.col("c_custkey") % 97) / F.lit(97.0)).alias("latitude"),
        (F.lit(149.0) + (F.col("c_custkey") % 89) / F.lit(89.0)).alias("longitude"),
    )


def ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id").distinct()


def location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The location dimension before its state is known: one row per port."""
    user = F.col("user_id")
    port = ports(spark, sf_dir).select(
        _evse_id(user).alias("evse_id"),
        _port_id(user).alias("evse_port_id"),
        _site(user).alias("site"),
        (_evse(user) % EVSES_PER_SITE).alias("bay"),
        (F.lit(7.0) + F.lit(15.0) * (_evse(user) % 4)).alias("power"),
    )
    return port.join(sites(spark, sf_dir), "site").select(
        "evse_id",
        "evse_port_id",
        "cpo_name",
        "address",
        "suburb",
        "postcode",
        "lga_name",
        F.lit(None).cast("string").alias("state"),
        (F.col("latitude") + F.col("bay") * F.lit(0.0005)).alias("latitude"),
        "longitude",
        "power",
    )


def status_log(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """The state-change log. ``events`` may be a streaming DataFrame."""
    events = table(spark, sf_dir, "events") if events is None else events
    operator = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("site"), F.col("c_mktsegment").alias("cpo_name")
    )
    user = F.col("user_id")
    return (
        events.select("ts", "user_id", "event_type", "value")
        .withColumn("site", _site(user))
        .join(operator, "site")
        .select(
            _evse_id(user).alias("evse_id"),
            _port_id(user).alias("evse_port_id"),
            "cpo_name",
            status_name(F.col("event_type"), F.col("value")).alias("status"),
            F.col("ts").alias("update_time"),
        )
    )


def outages(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Operator outage windows: the most severe errors open one."""
    events = table(spark, sf_dir, "events") if events is None else events
    operator = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("site"), F.col("c_mktsegment").alias("cpo_name")
    )
    return (
        events.where((F.col("event_type") == "error") & (F.col("value") >= OUTAGE_SEVERITY))
        .select("event_id", "ts", _site(F.col("user_id")).alias("site"))
        .join(operator, "site")
        .select(
            "cpo_name",
            F.col("ts").alias("offline_timestamp"),
            (
                F.col("ts")
                + F.make_dt_interval(
                    F.lit(0), F.lit(0), (F.lit(60) + F.col("event_id") % 400).cast("int")
                )
            ).alias("online_timestamp"),
        )
    )


def funded_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grant-funded sites: every third site that has ports."""
    has_ports = ports(spark, sf_dir).select(_site(F.col("user_id")).alias("site")).distinct()
    site = F.col("site")
    return (
        sites(spark, sf_dir)
        .where(site % 3 == 0)
        .join(has_ports, "site", "left_semi")
        .select(
            F.lit(None).cast("string").alias("evse_id"),
            F.lit(None).cast("string").alias("evse_port_id"),
            "cpo_name",
            F.when(site % 2 == 0, F.concat(F.lit("Grant "), F.col("address")))
            .otherwise("Unlisted")
            .alias("address"),
            "suburb",
            F.col("postcode").cast("string").alias("postcode"),
            F.lit(None).cast("string").alias("lga_code"),
            F.concat(F.lit("Shire "), site.cast("string")).alias("lga_name"),
            state_of_postcode(F.col("postcode")).alias("state"),
            (F.col("latitude") + F.lit(0.0002)).alias("latitude"),
            "longitude",
            F.lit("Destination Charging").alias("program"),
            (F.lit(1) + site % 2).cast("int").alias("round"),
        )
    )


def normalized(
    spark: SparkSession, sf_dir: str, status: Callable[[Column, Column], Column] = status_name
) -> dict[str, DataFrame]:
    """The same data as the seven operational tables; ``status`` names an event's status."""
    site = sites(spark, sf_dir)
    user = F.col("user_id")
    port = ports(spark, sf_dir)
    events = table(spark, sf_dir, "events").withColumn(
        "status", status(F.col("event_type"), F.col("value"))
    )

    def operator_id(name: Column) -> Column:
        return F.crc32(name)

    tables = {
        "charge_point_operators": site.select("cpo_name")
        .distinct()
        .select(operator_id(F.col("cpo_name")).alias("id"), F.col("cpo_name").alias("name")),
        "charge_locations": port.select(
            _evse(user).alias("id"),
            _site(user).alias("site"),
            (_evse(user) % EVSES_PER_SITE).alias("bay"),
        )
        .distinct()
        .join(site, "site")
        .select(
            "id",
            operator_id(F.col("cpo_name")).alias("cpo_id"),
            F.col("address").alias("address_street_1"),
            F.col("suburb").alias("address_suburb_town"),
            F.col("postcode").alias("address_postcode"),
            "lga_name",
            F.lit(None).cast("string").alias("address_state"),
            (F.col("latitude") + F.col("bay") * F.lit(0.0005)).alias("latitude"),
            "longitude",
        ),
        "charge_points": port.select(
            _evse(user).alias("id"),
            _evse(user).alias("location_id"),
            _evse_id(user).alias("evse_id"),
        ).distinct(),
        "charge_point_ports": port.select(
            user.alias("id"),
            _evse(user).alias("charge_point_id"),
            _port_id(user).alias("evse_port_id"),
            (F.lit(7.0) + F.lit(15.0) * (_evse(user) % 4)).alias("power_kilowatts"),
        ),
        "port_status_history": events.select(
            user.alias("port_id"),
            F.crc32(F.col("status")).alias("status_type_id"),
            F.col("ts").alias("updated_timestamp"),
        ),
        "port_status_types": events.select("status")
        .distinct()
        .select(F.crc32(F.col("status")).alias("id"), F.col("status").alias("name")),
        "charge_point_operators_offline": outages(spark, sf_dir).select(
            operator_id(F.col("cpo_name")).alias("cpo_id"),
            "offline_timestamp",
            "online_timestamp",
        ),
    }
    return {name: conform(df, NORMALIZED[name], name) for name, df in tables.items()}
