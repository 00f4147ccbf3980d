"""Scans of the normalized tables: locations, status history, outage windows."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portpulse.functions.clock import ntz
from portpulse.schema import PORT_KEYS


def location_scan(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct ports with their operator and site."""
    operators = tables["charge_point_operators"].select(
        F.col("id").alias("cpo_id"), F.col("name").alias("cpo_name")
    )
    locations = tables["charge_locations"].withColumnRenamed("id", "location_id")
    points = tables["charge_points"].withColumnRenamed("id", "charge_point_id")
    ports = tables["charge_point_ports"]
    return (
        ports.join(points, "charge_point_id")
        .join(locations, "location_id")
        .join(operators, "cpo_id")
        .select(
            "evse_id",
            "evse_port_id",
            "cpo_name",
            F.col("address_street_1").alias("address"),
            F.col("address_suburb_town").alias("suburb"),
            F.col("address_postcode").alias("postcode"),
            "lga_name",
            F.col("address_state").alias("state"),
            "latitude",
            "longitude",
            F.col("power_kilowatts").alias("power"),
        )
        .distinct()
    )


def history_scan(tables: Mapping[str, DataFrame], until: datetime | None = None) -> DataFrame:
    """The status log in flat form: history joined to ports, operators and types.

    The history is the only big side; it is cut at ``until`` before any join.
    """
    ports = (
        tables["charge_point_ports"]
        .select(F.col("id").alias("port_id"), "charge_point_id", "evse_port_id")
        .join(
            tables["charge_points"].select(
                F.col("id").alias("charge_point_id"), "location_id", "evse_id"
            ),
            "charge_point_id",
        )
        .join(
            tables["charge_locations"].select(F.col("id").alias("location_id"), "cpo_id"),
            "location_id",
        )
        .join(
            tables["charge_point_operators"].select(
                F.col("id").alias("cpo_id"), F.col("name").alias("cpo_name")
            ),
            "cpo_id",
        )
        .select("port_id", "evse_id", "evse_port_id", "cpo_name")
    )
    types = tables["port_status_types"].select(
        F.col("id").alias("status_type_id"), F.col("name").alias("status")
    )
    history = tables["port_status_history"]
    if until is not None:
        history = history.where(F.col("updated_timestamp") <= ntz(until))
    return (
        history.join(types, "status_type_id")
        .join(ports, "port_id")
        .select(
            "evse_id",
            "evse_port_id",
            "cpo_name",
            "status",
            F.col("updated_timestamp").alias("update_time"),
        )
    )


def offline_scan(tables: Mapping[str, DataFrame], lo: datetime, hi: datetime) -> DataFrame:
    """Outage windows that begin inside the period, ordered by their begin."""
    operators = tables["charge_point_operators"].select(
        F.col("id").alias("cpo_id"), F.col("name").alias("cpo_name")
    )
    return (
        windows_in_period(tables["charge_point_operators_offline"], lo, hi)
        .join(operators, "cpo_id")
        .select("cpo_name", "offline_timestamp", "online_timestamp")
        .orderBy("offline_timestamp", "cpo_name")
    )


def windows_in_period(windows: DataFrame, lo: datetime, hi: datetime) -> DataFrame:
    begin = F.col("offline_timestamp")
    return windows.where((begin > ntz(lo)) & (begin < ntz(hi)))


def restrict_ports(log: DataFrame, location: DataFrame) -> DataFrame:
    """Rows of the ports that are in ``location``."""
    return log.join(location.select(*PORT_KEYS), PORT_KEYS, "left_semi")


def port_bounds(
    log: DataFrame, lo: datetime, hi: datetime, carry_idle_ports: bool = False
) -> DataFrame:
    """First moment to read per port: its last status before the period.

    The time of the row before the first in-period row is either the last row at
    or before ``lo`` or, without one, the first in-period row itself once a second
    follows. So one aggregate with map-side combine answers it and no port's
    history is ever sorted. A port whose only row is inside the period has no such
    row and drops out, and so does one without a row in the period unless
    ``carry_idle_ports``.
    """
    ts = F.col("update_time")
    inside = (ts > ntz(lo)) & (ts < ntz(hi))
    bounds = log.groupBy(*PORT_KEYS).agg(
        F.max(F.when(ts <= ntz(lo), ts)).alias("_carried"),
        F.min(F.when(inside, ts)).alias("_first"),
        F.count(F.when(inside, 1)).alias("_inside"),
    )
    earliest = F.coalesce("_carried", F.when(F.col("_inside") >= 2, F.col("_first")))
    if not carry_idle_ports:
        bounds = bounds.where(F.col("_inside") >= 1)
    return bounds.select(*PORT_KEYS, earliest.alias("_from")).where(F.col("_from").isNotNull())


def history_window(
    log: DataFrame, lo: datetime, hi: datetime, carry_idle_ports: bool = False
) -> DataFrame:
    """All log rows from each port's lower bound to the end of the period."""
    log = log.where(F.col("update_time") <= ntz(hi))
    bounds = port_bounds(log, lo, hi, carry_idle_ports)
    columns = log.columns
    return (
        log.join(bounds, PORT_KEYS)
        .where(F.col("update_time") >= F.col("_from"))
        .select(*columns)
    )
