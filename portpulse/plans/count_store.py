"""Distinct ports and operators of any areas and days, without reading the fact table.

Ports have positions in a dictionary that only grows. Of every area, operator, funding and
local day the ports seen are stored as bitmaps over those positions, in buckets of
32,768: the bitmaps of any union of areas and days, put together by OR, have exactly the
bits of the distinct ports.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portpulse.functions.clock import to_datetime
from portpulse.functions.scale import settle
from portpulse.operators import metrics
from portpulse.operators.privacy import LabelStore
from portpulse.plans.monthly import Period
from portpulse.schema import PORT_KEYS
from portpulse.sources.readers import of_range
from portpulse.sources.writers import replace_label

_LAYOUT = ("state", "year", "month")
_AREA = ["state", "lga_name", "cpo_name", "government_funded"]


@dataclass(frozen=True)
class CountStore:
    spark: SparkSession
    path: str

    def replace(self, fact: DataFrame, period: Period) -> None:
        """Store the bitmaps of one period's fact table in place of the former ones."""
        begin = to_datetime(period.start)
        margin = timedelta(days=2)
        local = metrics.local_between_dates(
            metrics.dashboard_names(fact), begin - margin, to_datetime(period.end) + margin
        )
        port = F.concat_ws("/", *PORT_KEYS)
        day = F.col("interval").cast("date").alias("day")
        seen = settle(local.select(*_AREA, day, port.alias("port")).distinct())
        load = begin.year * 12 + begin.month
        known = seen.select(F.lit("all").alias("part"), "port").distinct()
        positions = LabelStore(self.spark, f"{self.path}/ports", load).numbers(known, ["part"], "port", "position")
        at = F.col("position") - 1
        bits = (
            seen.join(positions, "port")
            .groupBy(*_AREA, "day", F.bitmap_bucket_number(at).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("ports"))
        )
        replace_label(bits, f"{self.path}/bits", {"year": begin.year, "month": begin.month}, _LAYOUT, "state")

    def counts(
        self,
        start: datetime | str,
        end: datetime | str,
        by: Sequence[str] = (),
        where: Column | None = None,
        state: str | None = None,
    ) -> DataFrame:
        """Distinct ports and operators of the local days from ``start`` to ``end``, both
        counted in full, per group ``by`` of the area's columns, of the rows that ``where`` allows."""
        day = F.col("day")
        stored = of_range(self.spark.read.parquet(f"{self.path}/bits"), state, start, to_datetime(end) + timedelta(days=1))
        stored = stored.where(day.between(F.lit(to_datetime(start).date()), F.lit(to_datetime(end).date())))
        if where is not None:
            stored = stored.where(where)
        # bitmaps of a bucket combine map-side; operators are a line per group and operator
        zero = F.lit(0).cast("long")
        ports = stored.groupBy(*by, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("ports")).alias("ports"))
        named = stored.select(*by, F.col("cpo_name").alias("_cpo")).distinct()
        one = F.when(F.col("_cpo").isNotNull(), 1).otherwise(0).cast("long")
        lines = ports.select(*by, "ports", zero.alias("operators")).unionByName(
            named.select(*by, zero.alias("ports"), one.alias("operators"))
        )
        return lines.groupBy(*by).agg(*(F.coalesce(F.sum(c), zero).alias(c) for c in ("ports", "operators")))
