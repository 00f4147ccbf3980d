"""The charger level, stored once per period for every roll-up.

It is kept as runs of equal half hours that add up to it (``metrics.evse_runs``): roll-ups sum
runs, and only who wants half hours makes them.

A half hour lies in one period only, so a period's share of any roll-up comes from its own
partitions: storing a period again takes its old share out and adds the new one, and no
other period is read. What is hidden for privacy depends on the range that is looked at, so
it is decided on reading, from a small table of the operators of each area and half hour.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portpulse.functions.clock import to_datetime
from portpulse.operators import durations, metrics, privacy
from portpulse.plans.monthly import Period
from portpulse.schema import EVSE_KEYS, STATUSES
from portpulse.sources.readers import of_range
from portpulse.sources.writers import replace_label

_LAYOUT = ("state", "year", "month")
_AREA = ["state", "lga_name", "cpo_name", "government_funded"]


@dataclass(frozen=True)
class LevelStore:
    spark: SparkSession
    path: str
    statuses: Sequence[str] = tuple(STATUSES)

    def replace(self, fact: DataFrame, period: Period) -> None:
        """Store the charger level of one period's fact table in place of the former one.

        ``fact`` has half hours or runs of equal ones (``monthly.fact_runs``).
        """
        begin = to_datetime(period.start)
        label = {"year": begin.year, "month": begin.month}
        # a period begins some hours before its first local day does
        margin = timedelta(days=2)
        if not durations.is_runs(fact):
            fact = durations.runs_of_half_hours(fact)
        local = metrics.local_runs(fact, begin - margin, to_datetime(period.end) + margin)
        level = metrics.evse_runs(local, self.statuses, ["state"])
        seen = (
            durations.by_day(local.select(*_AREA, "_from", "_to"))
            .groupBy(*_AREA, "_day")
            .agg(F.bit_or(durations.day_bits()).alias("_bits"))
            .select(*_AREA, F.inline(durations.runs_of_bits()))
        )
        replace_label(level, f"{self.path}/level", label, _LAYOUT, None)
        replace_label(seen, f"{self.path}/areas", label, _LAYOUT, "state")

    def load_runs(self, start: datetime | str, end: datetime | str, state: str | None = None) -> DataFrame:
        """:meth:`load` as the runs that add up to it, with their state."""

        def read(name: str) -> DataFrame:
            stored = of_range(self.spark.read.parquet(f"{self.path}/{name}"), state, start, end)
            return metrics.runs_between(stored, start, end)

        shared = privacy.shared_areas(read("areas"))
        return privacy.in_shared_areas(read("level"), shared).drop("year", "month")

    def load(self, start: datetime | str, end: datetime | str, state: str | None = None) -> DataFrame:
        """The charger level of a range of local time, without areas that reveal a single operator."""
        runs = self.load_runs(start, end, state)
        keys = [*EVSE_KEYS, "state"]
        return metrics.level_of_runs(runs, keys, "evse_id", metrics.PORT_COUNT, self.statuses).drop("state")
