"""Status durations kept up to date as log rows and outage windows arrive, late ones included.

What arrives changes a port from one moment to the port's next logged row that no outage
swallows; windows do so for all ports of their operator. Only those port-days are derived
again, each run of days from the port's state at the end of the day before, and only the
partitions that hold them are rewritten.

Stored below one folder:

* ``log``: the rows, by day and batch;
* ``windows`` and ``ports``: outage windows as reported, and which operators a port has
  been logged with, by batch; ``extent``: first and last day of each batch, one line;
* ``durations``: seconds per port, half hour and status, and ``day_end``: each port's status
  at the end of a day, with the last logged one (an outage ends with it); both by day and shard.

A day's number of shards follows the ports that it begins with. Partitions are replaced
whole and a batch is marked by its number, so running it again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from portpulse.functions.clock import epoch_micro, epoch_second, from_epoch_second, ntz, seconds_of
from portpulse.functions.scale import path_exists, settle
from portpulse.operators import durations
from portpulse.operators.durations import CPO_PORT, code_bits, status_code, whole_minutes
from portpulse.operators.outages import outside_outages
from portpulse.schema import MISSING, PORT_KEYS, STATUSES
from portpulse.sources import sample
from portpulse.sources.writers import replace_label
from portpulse.streaming.files import split_by_day, stream_events

_DAY = 86_400
_KEYS = list(PORT_KEYS)
WINDOW_SCHEMA = "cpo_name string, offline_timestamp timestamp_ntz, online_timestamp timestamp_ntz"
LOG_SCHEMA = "evse_id string, evse_port_id string, cpo_name string, status string, update_time timestamp_ntz"
#: Order of rows at one moment; a state carried in comes before all else.
_CARRIED, _LOGGED, _ONLINE, _OFFLINE = -1, 0, 1, 2


def midnight_of(day: date) -> datetime:
    return datetime(day.year, day.month, day.day)


def _days(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(first, last))


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    path: str
    statuses: Sequence[str] = tuple(STATUSES)
    #: Ports of one shard of a day, about.
    shard_ports: int = 20_000

    # -- files -----------------------------------------------------------------------

    def _has(self, name: str) -> bool:
        return path_exists(self.spark, f"{self.path}/{name}")

    def _read(self, name: str, schema: str) -> DataFrame:
        """A stored table, empty before its first write. Any other trouble is an error."""
        if not self._has(name):
            return self._none(schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def _none(self, schema: str) -> DataFrame:
        """An empty table of which the optimizer knows that it is empty."""
        columns = (c.split() for c in schema.split(","))
        return self.spark.sql("SELECT " + ", ".join(f"CAST(NULL AS {kind}) AS {name}" for name, kind in columns) + " WHERE false")

    def _write(self, df: DataFrame, name: str, *partitions: str) -> None:
        (
            df.repartition(*partitions)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partitions)
            .parquet(f"{self.path}/{name}")
        )

    def _log(self) -> DataFrame:
        return self._read("log", f"{LOG_SCHEMA}, day date, batch bigint")

    def _ports(self) -> DataFrame:
        return self._read("ports", "evse_id string, evse_port_id string, cpo_name string, batch bigint")

    def _day_end(self) -> DataFrame:
        return self._read("day_end", "evse_id string, evse_port_id string, _code bigint, _known bigint, day date, shard int")

    def durations(self) -> DataFrame:
        schema = "evse_id string, evse_port_id string, update_time timestamp_ntz, status string, status_duration bigint"
        return self._read("durations", f"{schema}, day date, shard int")

    def _windows(self, without: int | None = None) -> DataFrame:
        """Current windows: of each operator and begin, what was reported last."""
        told = self._read("windows", f"{WINDOW_SCHEMA}, batch bigint")
        if without is not None:
            told = told.where(F.col("batch") != without)
        newest = F.max("batch").over(Window.partitionBy("cpo_name", "offline_timestamp"))
        told = told.withColumn("_newest", newest).where("batch = _newest")
        return told.select("cpo_name", "offline_timestamp", "online_timestamp")

    def _extent(self, without: int) -> tuple[date, date] | None:
        """First and last day with rows of other batches."""
        told = self._read("extent", "first date, last date, batch bigint").where(F.col("batch") != without)
        first, last = told.agg(F.min("first"), F.max("last")).first()
        return None if first is None else (first, last)

    # -- one batch -------------------------------------------------------------------

    def add(self, events: DataFrame, batch: int, windows: DataFrame | None = None) -> None:
        """Store a batch of log rows and reported windows, and bring the durations up to date.

        A window with an operator and begin that are known replaces what was reported of
        it; one without an end is still open. Rows with a null key or time are left out.
        """
        before = now = self._extent(without=batch)
        if windows is not None:
            told = windows.select("cpo_name", "offline_timestamp", "online_timestamp")
            told = told.dropna(subset=["cpo_name", "offline_timestamp"])
            self._write(told.withColumn("batch", F.lit(batch).cast("long")), "windows", "batch")
        rows = events.select(*CPO_PORT, "status", "update_time").dropna(subset=[*CPO_PORT, "update_time"])
        rows = rows.withColumn("day", F.col("update_time").cast("date"))
        replace_label(rows, f"{self.path}/log", {"batch": batch}, ("day", "batch"), "day")
        mine = self._log().where(F.col("batch") == batch)
        first, last = mine.agg(F.min("day"), F.max("day")).first()
        if first is not None:
            now = (min(first, before[0]), max(last, before[1])) if before else (first, last)
            known = self._ports().where(F.col("batch") != batch)
            pairs = mine.select(*CPO_PORT, "batch").distinct().join(known, CPO_PORT, "left_anti")
            self._write(pairs, "ports", "batch")
            extent = self.spark.range(1).select(F.lit(first).alias("first"), F.lit(last).alias("last"), F.lit(batch).alias("batch"))
            self._write(extent, "extent", "batch")
        if now is not None:
            self._repair(mine.drop("batch"), batch, before, now)

    def _repair(self, rows: DataFrame, batch: int, before: tuple[date, date] | None, now: tuple[date, date]) -> None:
        lo, hi = midnight_of(now[0]), midnight_of(now[1] + timedelta(days=1))
        windows = _in_extent(self._windows(), lo, hi)
        if self._has("windows"):
            windows = settle(windows)
        changes = settle(self._changes(rows, windows, batch, before, lo, hi))
        first = changes.agg(F.min("day")).first()[0]
        if first is None and (before is None or now[1] <= before[1]):
            return
        affected = settle(self._affected(changes, windows, first, before, now))
        runs = settle(self._runs(affected))
        timeline = settle(self._timeline(runs, windows, hi))
        self._replace(affected, timeline, now)

    def _changes(
        self, rows: DataFrame, windows: DataFrame, batch: int, before: tuple[date, date] | None, lo: datetime, hi: datetime
    ) -> DataFrame:
        """Per port, when something changed: ``day`` of its begin, and ``until``, its last moment."""
        logged = rows.groupBy(*_KEYS, "day").agg(F.max("update_time").alias("until"))
        if before is None:
            old = windows.limit(0)
        else:
            old = _in_extent(self._windows(without=batch), midnight_of(before[0]), midnight_of(before[1] + timedelta(days=1)))
        # what is in one of the two states and not in the other, as often as it is
        moved = windows.exceptAll(old).unionByName(old.exceptAll(windows))
        everyone = self._ports()
        of_moved = everyone.drop("batch").distinct().join(moved, "cpo_name")
        # all windows of an operator are new to a port that is new with it
        of_new = everyone.where(F.col("batch") == batch).drop("batch").join(windows, "cpo_name")
        # an end before its begin is an edge all the same
        begin = F.least("offline_timestamp", "online_timestamp")
        end = F.greatest("offline_timestamp", F.least(F.coalesce("online_timestamp", ntz(hi)), ntz(hi)))
        hidden = (
            of_moved.unionByName(of_new)
            .groupBy(*_KEYS, begin.cast("date").alias("day"))
            .agg(F.max(end).alias("until"))
        )
        return logged.unionByName(hidden).groupBy(*_KEYS, "day").agg(F.max("until").alias("until"))

    def _effective(self, windows: DataFrame, first: date, ports: DataFrame) -> DataFrame:
        """Logged rows that count, of some ports, from a day on."""
        log = self._log().where((F.col("day") >= F.lit(first)) & F.col("status").isNotNull())
        log = log.join(ports, _KEYS, "left_semi")
        ends = F.coalesce("online_timestamp", F.lit("9999-12-31").cast("timestamp_ntz"))
        hours = _bounded(windows.withColumn("online_timestamp", ends), log)
        return outside_outages(log, hours)

    def _affected(
        self, changes: DataFrame, windows: DataFrame, first: date | None, before: tuple[date, date] | None, now: tuple[date, date]
    ) -> DataFrame:
        """The port-days to derive again; ``lives`` is false for ports that end up without any row."""
        ends = self._day_end()
        none = self._none("evse_id string, evse_port_id string, day date, lives boolean")
        longer = none
        if before is not None and now[1] > before[1]:
            carried = ends.where(F.col("day") == F.lit(before[1])).select(*_KEYS)
            days = _days(F.lit(before[1] + timedelta(days=1)), F.lit(now[1]))
            longer = carried.select(*_KEYS, days.alias("day"), F.lit(True).alias("lives"))
        if first is None:
            return longer
        touched = changes.groupBy(*_KEYS).agg(F.min("day").alias("_first"))
        # one line per port and day, however many rows it has
        held = settle(
            self._effective(windows, first, touched).groupBy(*_KEYS, "day").agg(F.max("update_time").alias("until"))
        )  # read for its days and for its ports
        marks = held.withColumn("_change", F.lit(0)).unionByName(changes.withColumn("_change", F.lit(1)))
        ahead = (
            Window.partitionBy(*_KEYS)
            .orderBy("until", "_change")
            .rowsBetween(Window.currentRow, Window.unboundedFollowing)
        )
        stop = F.min(F.when(F.col("_change") == 0, F.col("day"))).over(ahead)
        spans = marks.withColumn("_stop", stop).where("_change = 1")
        spans = spans.select(*_KEYS, "day", F.coalesce("_stop", F.lit(now[1])).alias("_to"))
        # a port lives by a row that counts: one of these, or the one it was carried with
        earlier = ends.withColumn("_first", F.date_add("day", 1)).where("_known is not null")
        lives = (
            touched.join(held.select(*_KEYS).distinct().withColumn("_held", F.lit(True)), _KEYS, "left")
            .join(earlier.select(*_KEYS, "_first").withColumn("_carried", F.lit(True)), [*_KEYS, "_first"], "left")
            .select(*_KEYS, (F.col("_held").isNotNull() | F.col("_carried").isNotNull()).alias("lives"))
        )
        lived = (
            none.select(*_KEYS).withColumn("lived", F.lit(True))
            if before is None
            else ends.where(F.col("day") == F.lit(before[1])).select(*_KEYS, F.lit(True).alias("lived"))
        )
        turned = lives.join(lived, _KEYS, "left").withColumn("lived", F.coalesce("lived", F.lit(False)))
        turned = settle(turned)
        # a port that begins or ceases to live does so for the outages before its rows, too
        whole = turned.where("lives <> lived").select(*_KEYS, F.lit(now[0]).alias("day"), F.lit(now[1]).alias("_to"))
        parts = spans.join(turned.where("lives and lived").select(*_KEYS), _KEYS, "left_semi")
        days = whole.unionByName(parts).select(*_KEYS, _days(F.col("day"), F.col("_to")).alias("day"))
        days = days.distinct().join(turned.select(*_KEYS, "lives"), _KEYS)
        longer = longer.join(turned.where("not lives").select(*_KEYS), _KEYS, "left_anti")
        return days.unionByName(longer.join(days.select(*_KEYS, "day"), [*_KEYS, "day"], "left_anti"))

    def _runs(self, affected: DataFrame) -> DataFrame:
        """Neighbouring days of a port: ``_from`` and ``_to``."""
        nth = F.row_number().over(Window.partitionBy(*_KEYS).orderBy("day"))
        days = affected.where("lives").withColumn("_run", F.date_sub("day", nth))
        return days.groupBy(*_KEYS, "_run").agg(F.min("day").alias("_from"), F.max("day").alias("_to")).drop("_run")

    def _timeline(self, runs: DataFrame, windows: DataFrame, hi: datetime) -> DataFrame:
        """Stretches of one status within each run: ``_start``, ``_end``, ``_code``, ``_known``."""
        first = runs.agg(F.min("_from")).first()[0]
        columns = [*_KEYS, "_from", "_to", "_us", "_code", "_known", "_kind"]
        nothing = F.lit(None).cast("long")
        if first is None:
            return runs.select(*_KEYS, *(nothing.alias(c) for c in ("_start", "_end", "_code", "_known"))).limit(0)
        at = lambda day: F.unix_date(day).cast("long") * _DAY
        carried = self._day_end().withColumn("_from", F.date_add("day", 1)).join(runs, [*_KEYS, "_from"])
        carried = carried.withColumn("_us", at(F.col("_from")) * 1_000_000).withColumn("_kind", F.lit(_CARRIED))
        bits = code_bits(self.statuses)
        us = epoch_micro(F.col("update_time"))
        packed = F.shiftleft(us, bits) + status_code(F.col("status"), self.statuses)
        # the last row of a minute is the one that counts; combines map-side
        log = (
            self._effective(windows, first, runs)
            .groupBy(*_KEYS, "day", whole_minutes(us).alias("_minute"))
            .agg(F.max(packed).alias("_last"))
        )
        code = F.col("_last").bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))
        logged = (
            _within(log, runs)
            .select(*_KEYS, "_from", "_to", F.shiftright("_last", bits).alias("_us"), code.alias("_code"))
            .withColumn("_known", F.col("_code"))
            .withColumn("_kind", F.lit(_LOGGED))
        )
        edge = lambda moment, code, kind: F.struct(moment.alias("t"), code.cast("long").alias("code"), F.lit(kind).alias("kind"))
        edges = F.array(
            edge(F.col("online_timestamp"), F.lit(None), _ONLINE),
            edge(F.col("offline_timestamp"), F.lit(list(self.statuses).index(MISSING)), _OFFLINE),
        )
        moments = (
            windows.select("cpo_name", F.explode(edges).alias("_e"))
            .select("cpo_name", "_e.*", F.col("_e.t").cast("date").alias("day"))
            .where(F.col("t") < ntz(hi))
        )
        operators = self._ports().join(runs, _KEYS, "left_semi").select(*CPO_PORT).distinct()
        outages = _within(operators.join(moments, "cpo_name"), runs).select(
            *_KEYS, "_from", "_to", epoch_micro(F.col("t")).alias("_us"), F.col("code").alias("_code"), nothing.alias("_known"),
            F.col("kind").alias("_kind"),
        )
        run = Window.partitionBy(*_KEYS, "_from")
        upto = run.orderBy("_us", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = carried.select(*columns).unionByName(logged.select(*columns)).unionByName(outages.select(*columns))
        known = F.last("_known", ignorenulls=True).over(upto)
        rows = rows.withColumn("_known", known)
        rows = rows.withColumn("_code", F.when(F.col("_kind") == _ONLINE, F.col("_known")).otherwise(F.col("_code")))
        rows = rows.where("_code is not null").withColumn("_start", whole_minutes(F.col("_us")) * 60)
        following = F.lead("_start").over(run.orderBy("_us", "_kind"))
        end = F.coalesce(following, at(F.col("_to")) + _DAY)
        return rows.withColumn("_end", end).select(*_KEYS, "_start", "_end", "_code", "_known").where("_end > _start")

    def _replace(self, affected: DataFrame, timeline: DataFrame, now: tuple[date, date]) -> None:
        """Rewrite the partitions of the affected port-days, other ports' rows as they are."""
        seconds = durations.status_durations(timeline, self.statuses)
        seconds = seconds.withColumn("day", F.col("update_time").cast("date"))
        shards = self._shards(affected)
        shard = F.pmod(F.xxhash64(*_KEYS), F.col("of")).cast("int").alias("shard")
        # days with their shards: as many lines as partitions
        touched = settle(affected.join(shards, "day").select("day", shard, "lives").groupBy("day", "shard").agg(F.min("lives").alias("lives")))
        span = touched.agg(F.min("day"), F.max("day"), F.min("lives")).first()
        for new, stored, name in (
            (seconds, self.durations(), "durations"),
            (day_ends(timeline), self._day_end(), "day_end"),
        ):
            columns = [c for c in stored.columns if c != "shard"]
            others = (
                stored.where(F.col("day").between(span[0], span[1]))
                .join(touched.select("day", "shard"), ["day", "shard"], "left_semi")
                .join(affected, [*_KEYS, "day"], "left_anti")
            )
            whole = settle(others.select(*columns, "shard").unionByName(new.join(shards, "day").select(*columns, shard)))
            self._write(whole, name, "day", "shard")
            if not span[2]:
                self._drop_emptied(touched, whole, name)

    def _shards(self, affected: DataFrame) -> DataFrame:
        """Number of shards (``of``) of each affected day: as stored, or by the ports of a new day."""
        shards = self._read("shards", "of int, day date")
        ports = affected.groupBy("day").agg(F.count(F.lit(1)).alias("n")).join(shards, "day", "left_anti")
        # a line for each new day
        new = [(-(-r.n // self.shard_ports), r.day) for r in ports.collect()]
        if new:
            self._write(self.spark.createDataFrame(new, "of int, day date").coalesce(1), "shards", "day")
        return self._read("shards", "of int, day date")

    def _drop_emptied(self, touched: DataFrame, whole: DataFrame, name: str) -> None:
        """A port that no longer lives may have been the only one of its partition."""
        fs = self.spark._jvm.org.apache.hadoop.fs
        gone = touched.join(whole.select("day", "shard").distinct(), ["day", "shard"], "left_anti")
        for r in gone.collect():
            folder = fs.Path(f"{self.path}/{name}/day={r.day}/shard={r.shard}")
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    # -- streams ---------------------------------------------------------------------

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


def _in_extent(windows: DataFrame, lo: datetime, hi: datetime) -> DataFrame:
    """Windows that begin inside the stored days."""
    begin = F.col("offline_timestamp")
    return windows.where((begin > ntz(lo)) & (begin < ntz(hi)))


def _bounded(windows: DataFrame, log: DataFrame) -> DataFrame:
    """Windows cut behind the last row of the log, so that an open one is no endless series of half hours."""
    last = log.agg(F.max("update_time") + F.expr("INTERVAL '1' HOUR")).scalar()
    return windows.withColumn("online_timestamp", F.least("online_timestamp", F.coalesce(last, "offline_timestamp")))


def _within(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows with the run of their port that holds their ``day``."""
    days = runs.select(*_KEYS, "_from", "_to", _days(F.col("_from"), F.col("_to")).alias("day"))
    return rows.join(days, [*_KEYS, "day"])


def day_ends(timeline: DataFrame) -> DataFrame:
    """The status each port had at the end of each day its timeline covers, and the last logged one."""
    first = F.col("_start") - F.pmod(F.col("_start"), F.lit(_DAY)) + _DAY
    last = F.col("_end") - F.pmod(F.col("_end"), F.lit(_DAY))
    midnights = F.explode(F.sequence(first, last, F.lit(_DAY).cast("bigint")))
    ended = timeline.where(first <= last).select(*_KEYS, "_code", "_known", midnights.alias("_midnight"))
    day = from_epoch_second(F.col("_midnight") - 1).cast("date")
    return ended.select(*_KEYS, "_code", "_known", day.alias("day"))


def durations_of_folder(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """Run the stream over the sample events once; seconds per port, day and status, outages included."""
    split_by_day(spark, sf_dir, f"{path}/in")
    store = Store(spark, path)
    store.start(
        stream_events(spark, f"{path}/in"),
        lambda rows: sample.status_log(spark, sf_dir, rows),
        lambda rows: sample.outages(spark, sf_dir, rows),
    ).awaitTermination()
    return (
        store.durations()
        .groupBy(*PORT_KEYS, F.col("day").cast("timestamp_ntz").alias("day"), "status")
        .agg(F.sum("status_duration").alias("seconds"))
    )
