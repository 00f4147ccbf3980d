"""The dashboard's load and filter steps over the fact table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame

from portpulse.operators import metrics, privacy
from portpulse.schema import STATUSES


def load(
    fact: DataFrame,
    start: datetime | str,
    end: datetime | str,
    state: str | None = None,
) -> DataFrame:
    """Local time, date range, and no area that would reveal a single operator."""
    if state is not None:
        fact = fact.where(fact["state"] == state)
    local = metrics.local_between_dates(metrics.dashboard_names(fact), start, end)
    return privacy.hide_single_operator_areas(local)


def filtered_rollup(
    evse: DataFrame,
    keys: Sequence[str],
    interval: str,
    areas: Sequence[str],
    cpos: Sequence[str],
    funding: str = "all",
    statuses: Sequence[str] = STATUSES,
) -> DataFrame:
    chosen = metrics.area_filter(evse, areas, cpos, funding)
    return metrics.rollup(chosen, keys, interval, statuses)
