"""Live latest status per port."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from portpulse.functions.clock import epoch_minute, ntz
from portpulse.functions.scale import settle
from portpulse.operators.outages import closed_windows, outside_outages
from portpulse.schema import MISSING, PORT_KEYS
from portpulse.sources import sample
from portpulse.streaming.files import split_by_day, stream_events

_PORT = [*PORT_KEYS, "cpo_name"]


def latest_status(log: DataFrame) -> DataFrame:
    """Latest status per port, for a batch or a streaming log.

    The state is one row per port. An event that comes late cannot be the latest, so
    it changes nothing and no watermark is needed.
    """
    moment = F.struct("update_time", "status")
    return log.groupBy(*_PORT).agg(F.max(moment).alias("_last")).select(
        *_PORT, F.col("_last.status").alias("status"), F.col("_last.update_time").alias("update_time")
    )


@dataclass(frozen=True)
class LiveView:
    """The latest status of every port, kept up to date batch by batch, outages included.

    A port's rows are kept for as long as something may still come late (``horizon``), one for
    each minute, and the last row before that counts; so the view follows the ports and not the
    batches, and it is its own streaming state. A window that comes late within the horizon takes back the
    rows it covers; for older rows it may be too late.

    Rows are spread over shards by port. A batch writes the shards that it touches as a new
    generation, which counts once its ``extent`` is written; readers take the newest of each shard, and one
    generation before stays for those that are still reading.
    """

    spark: SparkSession
    path: str
    shards: int = 16
    horizon: timedelta = timedelta(days=1)

    # -- generations -----------------------------------------------------------------

    def _glob(self, pattern: str) -> list[str]:
        found = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{pattern}")
        store = found.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [f.getPath().toString() for f in store.globStatus(found) or []]

    def _drop(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _finished(self) -> list[int]:
        return sorted(int(f.split("/")[-2].split("=")[1]) for f in self._glob("extent/gen=*/_SUCCESS"))

    def _folders(self) -> dict[int, list[tuple[int, str]]]:
        """Finished generations of each shard, in order."""
        done, found = set(self._finished()), {}
        for folder in self._glob("rows/gen=*/shard=*"):
            gen, shard = (int(x.split("=")[1]) for x in folder.split("/")[-2:])
            if gen in done:
                found.setdefault(shard, []).append((gen, folder))
        return {shard: sorted(folders) for shard, folders in found.items()}

    def _rows(self, shards: Sequence[int] | None = None) -> DataFrame:
        paths = [f[-1][1] for shard, f in self._folders().items() if shards is None or shard in shards]
        if not paths:
            return self.spark.createDataFrame([], _ROWS)
        return self.spark.read.schema(_ROWS).parquet(*paths)

    def _windows(self) -> DataFrame:
        done = self._finished()
        if not done:
            return self.spark.createDataFrame([], _WINDOWS)
        return self.spark.read.schema(_WINDOWS).parquet(f"{self.path}/windows/gen={done[-1]}")

    def newest(self) -> datetime | None:
        """The time of the newest row that has come."""
        done = self._finished()
        return self.spark.read.parquet(f"{self.path}/extent/gen={done[-1]}").first()[0] if done else None

    # -- one batch -------------------------------------------------------------------

    def add(self, events: DataFrame, batch: int, windows: DataFrame | None = None) -> None:
        """Take in a batch of log rows and reported windows; one that has been taken in is left out.

        A window replaces what was reported of its operator and begin. Rows with a null key, time or status are left out.
        """
        if batch in self._finished():
            return
        rows = events.select(*_PORT, "status", "update_time").dropna()
        shard = F.pmod(F.xxhash64(*PORT_KEYS), F.lit(self.shards)).cast("int")
        rows = settle(_by_minute(rows).withColumn("shard", shard))
        # at most as many lines as shards
        touched = rows.groupBy("shard").agg(F.max("update_time")).collect()
        newest = max([t[1] for t in touched] + [t for t in [self.newest()] if t is not None], default=None)
        if newest is None and windows is None:
            return
        told = self._merged_windows(windows, newest)
        settled = settle(told.coalesce(1))
        if touched:
            mine = [t[0] for t in touched]
            everything = _by_minute(self._rows(mine).unionByName(rows.drop("shard")))
            kept = self._pruned(everything, settled, newest).withColumn("shard", shard)
            kept.repartition("shard").write.mode("overwrite").partitionBy("shard").parquet(f"{self.path}/rows/gen={batch}")
        settled.write.mode("overwrite").parquet(f"{self.path}/windows/gen={batch}")
        extent = self.spark.createDataFrame([(newest,)], "newest timestamp_ntz")
        extent.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/extent/gen={batch}")
        self._clean()

    def _merged_windows(self, told: DataFrame | None, newest: datetime | None) -> DataFrame:
        """What was reported last of each window; old ones only while they are an operator's newest."""
        known = self._windows().withColumn("_at", F.lit(0))
        if told is not None:
            told = told.select("cpo_name", "offline_timestamp", "online_timestamp").dropna(subset=["cpo_name", "offline_timestamp"])
            known = known.unionByName(told.withColumn("_at", F.lit(1)))
        last = F.max("_at").over(Window.partitionBy("cpo_name", "offline_timestamp"))
        known = known.withColumn("_last", last).where("_at = _last").select("cpo_name", "offline_timestamp", "online_timestamp")
        if newest is None:
            return known
        edge = F.greatest("offline_timestamp", "online_timestamp")
        ahead = F.col("online_timestamp").isNull() | (edge >= ntz(newest - self.horizon))
        top = F.max(edge).over(Window.partitionBy("cpo_name"))
        return known.withColumn("_top", top).where(ahead | (edge == F.col("_top"))).drop("_top")

    def _pruned(self, rows: DataFrame, windows: DataFrame, newest: datetime) -> DataFrame:
        """Rows within the horizon, and each port's last one before that no outage swallows."""
        recent = F.col("update_time") >= ntz(newest - self.horizon)
        older = outside_outages(rows.where(~recent), closed_windows(windows, newest))
        return rows.where(recent).unionByName(_latest(older))

    def _clean(self) -> None:
        for folders in self._folders().values():
            for _, folder in folders[:-2]:
                self._drop(folder)
        done = self._finished()
        left = {int(f.split("gen=")[1].split("/")[0]) for f in self._glob("rows/gen=*/shard=*")}
        for gen in done[:-2]:
            self._drop(f"{self.path}/windows/gen={gen}")
            if gen not in left:
                self._drop(f"{self.path}/rows/gen={gen}")
                self._drop(f"{self.path}/extent/gen={gen}")

    # -- reading ---------------------------------------------------------------------

    def status(self) -> DataFrame:
        """Status of every port as of the newest row: ``Missing`` while its operator is out, and
        after that the status before it, since the end of the outage."""
        newest = self.newest()
        if newest is None:
            return self.spark.createDataFrame([], _ROWS)
        windows = self._windows().where(F.col("offline_timestamp") <= ntz(newest))
        heard = outside_outages(self._rows(), closed_windows(windows, newest + timedelta(minutes=1)))
        latest = _latest(heard)
        edge = lambda moment, kind: F.struct(moment.alias("at"), F.lit(kind).alias("kind"))
        edges = F.array(edge(F.col("online_timestamp"), 1), edge(F.col("offline_timestamp"), 2))
        # one line for each operator
        last = (
            windows.select("cpo_name", F.explode(edges).alias("_e"))
            .where(F.col("_e.at") <= ntz(newest))
            .groupBy("cpo_name")
            .agg(F.max("_e").alias("_e"))
        )
        later = F.struct("update_time", F.lit(0).alias("kind")) < F.struct("_e.at", "_e.kind")
        out = later & (F.col("_e.kind") == 2)
        return latest.join(last, "cpo_name", "left").select(
            *_PORT,
            F.when(out, F.lit(MISSING)).otherwise(F.col("status")).alias("status"),
            F.when(later, F.col("_e.at")).otherwise(F.col("update_time")).alias("update_time"),
        )

    def start(self, events: DataFrame, log_of, windows_of=None) -> StreamingQuery:
        """Follow a stream; ``log_of`` and ``windows_of`` make log rows and windows of a batch of it."""

        def take(rows: DataFrame, batch: int) -> None:
            rows = settle(rows)
            self.add(log_of(rows), batch, windows_of(rows) if windows_of else None)

        return (
            events.writeStream.option("checkpointLocation", f"{self.path}/checkpoint")
            .trigger(availableNow=True)
            .foreachBatch(take)
            .start()
        )


_ROWS = "evse_id string, evse_port_id string, cpo_name string, status string, update_time timestamp_ntz"
_WINDOWS = "cpo_name string, offline_timestamp timestamp_ntz, online_timestamp timestamp_ntz"


def _by_minute(rows: DataFrame) -> DataFrame:
    """The last row of each port and minute: combines map-side, however chatty a port is."""
    moment = F.struct("update_time", "cpo_name", "status")
    return (
        rows.groupBy(*PORT_KEYS, epoch_minute(F.col("update_time")).alias("_minute"))
        .agg(F.max(moment).alias("_m"))
        .select(*PORT_KEYS, "_m.cpo_name", "_m.status", "_m.update_time")
    )


def _latest(rows: DataFrame) -> DataFrame:
    moment = F.struct("update_time", "cpo_name", "status")
    return rows.groupBy(*PORT_KEYS).agg(F.max(moment).alias("_m")).select(*PORT_KEYS, "_m.*")


def availability(latest: DataFrame, location: DataFrame) -> DataFrame:
    """Ports and available ports per operator and area."""
    return (
        latest.drop("cpo_name")
        .join(location.select(*_PORT, "lga_name"), PORT_KEYS)
        .groupBy("cpo_name", "lga_name")
        .agg(
            F.count("*").alias("ports"),
            F.count(F.when(F.col("status") == "Available", 1)).alias("available_ports"),
        )
    )


def live_of_folder(spark: SparkSession, sf_dir: str, path: str, outages: bool) -> LiveView:
    """Run the stream over the sample events once; the view that it leaves.

    The days come in any order, so anything may come late.
    """
    split_by_day(spark, sf_dir, f"{path}/in")
    view = LiveView(spark, path, horizon=timedelta(days=60))
    view.start(
        stream_events(spark, f"{path}/in"),
        lambda rows: sample.status_log(spark, sf_dir, rows),
        (lambda rows: sample.outages(spark, sf_dir, rows)) if outages else None,
    ).awaitTermination()
    return view
