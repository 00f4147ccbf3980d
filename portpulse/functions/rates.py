"""Metric arithmetic shared by the dashboard and the report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from portpulse.schema import (
    METRICS,
    MISSING,
    TOTAL,
    UNAVAILABILITY_PARTS_DASHBOARD,
    UNKNOWN,
    UTILISATION_PARTS,
)


def add_up(parts: Sequence[str], present: Sequence[str]) -> Column:
    """Sum of status columns.

    A status the data does not have counts as 0; a status it has but whose cell
    is null makes the sum null.
    """
    cols = [F.col(p) for p in parts if p in present]
    return reduce(lambda a, b: a + b, cols, F.lit(0).cast("bigint"))


def metric_seconds(
    present: Sequence[str],
    unavailability: Sequence[str] = UNAVAILABILITY_PARTS_DASHBOARD,
) -> dict[str, Column]:
    utilisation = add_up(UTILISATION_PARTS, present)
    return {
        "Utilisation": utilisation,
        "Uptime": add_up(["Available"], present) + utilisation,
        "Unavailability": add_up(unavailability, present),
    }


def observable_seconds(present: Sequence[str]) -> Column:
    return F.col(TOTAL) - add_up([MISSING], present) - add_up([UNKNOWN], present)


def rate(name: str, present: Sequence[str], scale: float = 1.0) -> Column:
    """Share of time: metrics over observable time, statuses over all time.

    Null where the denominator is 0.
    """
    below = observable_seconds(present) if name in METRICS else F.col(TOTAL)
    return F.try_divide(F.col(name) * F.lit(scale), below)


def percent(share: Column, digits: int = 1) -> Column:
    """Proportion -> percent, rounded half to even."""
    return F.bround(share * 100, digits)
