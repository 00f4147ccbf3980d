"""Sinks."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager, nullcontext
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portpulse.functions.clock import to_datetime

#: Rows of one file at most; a partition's number of files follows its volume.
FILE_ROWS = 5_000_000
#: Partitions that a task writes side by side, the states of a fact table.
OPEN_FILES = 12


@contextmanager
def _side_by_side(spark: SparkSession) -> Iterator[None]:
    """Tasks write their partitions side by side; beyond so many they sort their rows after all."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(int(before), OPEN_FILES)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def replace_label(
    df: DataFrame, path: str, label: Mapping[str, int], layout: Sequence[str], spread: str | None
) -> None:
    """Make ``df`` the whole content of one label of a table partitioned by ``layout``.

    ``label`` gives some of the layout's columns one value for all rows. The rows'
    partitions are replaced; what the label held in others is deleted once they are
    written. Partitions of other labels stay. ``spread`` is the column by which tasks
    of equal volume are made; without one the rows, of few partitions, are written by the tasks
    that hold them, neither shuffled nor sorted.
    """
    labelled = df.withColumns({c: F.lit(v) for c, v in label.items()})
    fs = df.sparkSession._jvm.org.apache.hadoop.fs
    pattern = fs.Path("/".join([path.rstrip("/"), *(f"{c}={label.get(c, '*')}" for c in layout)]))
    store = pattern.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())

    def held() -> dict[str, set[str]]:
        """The files of each partition of the label; there are few partitions."""
        folders = [f.getPath() for f in store.globStatus(pattern) or []]
        return {f.toString(): {x.getPath().getName() for x in store.listStatus(f)} for f in folders}

    before = held()
    rows = labelled if spread is None else labelled.hint("rebalance", spread)
    with _side_by_side(df.sparkSession) if spread is None else nullcontext():
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", FILE_ROWS)
            .partitionBy(*layout)
            .parquet(path)
        )
    # every write names its files anew: a partition with its old ones was not written
    for folder, files in held().items():
        if files == before.get(folder):
            store.delete(fs.Path(folder), True)


def write_fact(fact: DataFrame, path: str, period_start: datetime | str) -> None:
    """The rows of one period: one partition per state, under the period's label.

    The label is year and month of the period's local start. The rows' own times cannot
    tell it: a period begins some hours before its month does in UTC. The label is
    replaced as a whole, so a month can be run again (a state that has no rows any
    more leaves nothing) and others stay.
    """
    start = to_datetime(period_start)
    label = {"year": start.year, "month": start.month}
    replace_label(fact, path, label, ("state", "year", "month"), None)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
