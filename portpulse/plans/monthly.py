"""The monthly batch job: status log in, dense half-hourly fact table out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from portpulse.functions.clock import period_bounds
from portpulse.functions.scale import settle
from portpulse.operators import durations, history, location as places, metrics
from portpulse.schema import (
    LOCATION,
    OFFLINE,
    PERIOD_SHIFT_HOURS,
    PORT_KEYS,
    STATUS_LOG,
    STATUSES,
    conform,
)


@dataclass(frozen=True)
class Period:
    """First and last local date; the last day counts in full."""

    start: datetime | str
    end: datetime | str
    shift_hours: int = PERIOD_SHIFT_HOURS

    @property
    def bounds(self) -> tuple[datetime, datetime]:
        return period_bounds(self.start, self.end, self.shift_hours)


def statuses_of(types: DataFrame, name: str = "name") -> list[str]:
    """The statuses of a feed's table of types (a few rows), the known ones first."""
    told = {r[0] for r in types.select(name).distinct().collect() if r[0] is not None}
    return [*STATUSES, *sorted(told - set(STATUSES))]


def prepared_location(
    location: DataFrame,
    required_states: DataFrame | Sequence[str],
    funded: DataFrame | None = None,
    geocoded: DataFrame | None = None,
    lookup: DataFrame | None = None,
) -> DataFrame:
    """State from the postcode, required states only, funding program, gaps filled.

    Null areas and addresses are filled from geocoded coordinates (``geocode_parts``) and
    the table of area names, after the funded sites have been matched. Several later
    steps read the result, so the caller had better write it once.
    """
    ready = places.in_required_states(places.with_postcode_state(location), required_states)
    if funded is not None:
        ready = places.match_funded_sites(ready, funded)
    if geocoded is not None and lookup is not None:
        ready = places.fill_missing(ready, geocoded, lookup)
    return ready


def port_timeline(
    log: DataFrame,
    location: DataFrame,
    windows: DataFrame | None,
    period: Period,
    statuses: Sequence[str] = STATUSES,
    every_edge: bool = True,
) -> DataFrame:
    lo, hi = period.bounds
    ports = location.select("evse_id", "evse_port_id", "cpo_name").distinct()
    log = history.restrict_ports(log, ports)
    if windows is not None:
        windows = settle(history.windows_in_period(windows, lo, hi))
    return durations.timeline(log, ports, lo, hi, windows, statuses, every_edge=every_edge)


def fact_table(
    log: DataFrame,
    location: DataFrame,
    windows: DataFrame | None,
    period: Period,
    statuses: Sequence[str] = STATUSES,
    residual: str = "reference",
) -> DataFrame:
    """One row per port and half hour: location columns and seconds per status.

    A status outside the list counts as ``Unknown``; :func:`fact_of_feed` takes the list from the
    feed.
    """
    return half_hourly(fact_runs(log, location, windows, period, statuses, residual))


def half_hourly(runs: DataFrame) -> DataFrame:
    """The half hours of a fact table's runs."""
    rest = [c for c in runs.columns if c not in (*PORT_KEYS, "_from", "_to")]
    return durations.unrolled(runs, [*PORT_KEYS, "update_time", *rest])


def fact_runs(
    log: DataFrame,
    location: DataFrame,
    windows: DataFrame | None,
    period: Period,
    statuses: Sequence[str] = STATUSES,
    residual: str = "reference",
) -> DataFrame:
    """:func:`fact_table` with one row per port and run of equal half hours, ``_from`` to ``_to``.

    ``location`` is a prepared one. Its columns are joined to the runs, of which there are few,
    and the join keeps the partitioning by port. An input that lacks a column is an error here.
    """
    log = conform(log, STATUS_LOG, "status log")
    conform(location, LOCATION, "location")
    if windows is not None:
        windows = conform(windows, OFFLINE, "outage windows")
    # Written once: two facts about the whole timeline and its pieces are read from it.
    rows = settle(port_timeline(log, location, windows, period, statuses, every_edge=False))
    runs = durations.dense_runs(rows, period.bounds[0], statuses, residual)
    return places.apply_cpo_cleaning(metrics.with_location(runs, location))


def fact_of_feed(
    tables: Mapping[str, DataFrame], location: DataFrame, period: Period, residual: str = "reference"
) -> tuple[DataFrame, list[str]]:
    """:func:`fact_table` from a feed's operational tables, and its statuses.

    The list of statuses is that of the feed's own types: one that is not among the known
    ones has a column of its own, and counts in the totals of the rates.
    """
    lo, hi = period.bounds
    statuses = statuses_of(tables["port_status_types"])
    windows = history.offline_scan(tables, lo, hi)
    log = history.history_scan(tables, until=hi)
    return fact_table(log, location, windows, period, statuses, residual), statuses
