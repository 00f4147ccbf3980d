"""Seconds each port spent in each status per half hour.

The log is never laid out on a fine time grid. Only the last status of a minute
counts, so the log is first compacted to one row per port and minute; each row
then lasts until the port's next one and is cut at bucket edges. Compacting
combines map-side and bounds a port by the minutes of the period, so a chatty
port cannot overload the task that orders its rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portpulse.functions.clock import (
    bucket_second,
    epoch_micro,
    epoch_second,
    from_epoch_second,
    ntz,
    seconds_of,
    truncate_minute,
)
from portpulse.functions.scale import parts_for, settle
from portpulse.operators.outages import closed_windows, flag_in_outage, repeated
from portpulse.schema import (
    BUCKET_SECONDS,
    MISSING,
    PORT_KEYS,
    STATUSES,
    TOTAL,
    UNKNOWN,
)

CPO_PORT = [*PORT_KEYS, "cpo_name"]
# Order of rows at the same moment: logged, back online, gone missing.
_LOGGED, _ONLINE, _OFFLINE = 0, 1, 2
# Room beside the microseconds of a moment (51 bits until the year 2041) in one integer.
_SPARE_BITS = 12
#: Stretches that one task cuts and sums, about.
STRETCHES = 250_000


def whole_minutes(us: Column) -> Column:
    """Microseconds -> minutes, in integers (a double would lose microseconds)."""
    return F.call_function("div", us, F.lit(60_000_000).cast("bigint"))


def status_code(status: Column, statuses: Sequence[str]) -> Column:
    """Position of a status in the list; one that is not in it counts as ``Unknown``."""
    code = F.array_position(F.lit(list(statuses)), status).cast("bigint")
    return F.when(code == 0, F.lit(list(statuses).index(UNKNOWN))).otherwise(code - 1).cast("bigint")


def code_bits(statuses: Sequence[str]) -> int:
    """Bits of a status code below the microseconds of a packed moment."""
    bits = max(1, (len(statuses) - 1).bit_length())
    if bits > _SPARE_BITS:
        raise ValueError(f"{len(statuses)} statuses do not fit a table of statuses")
    return bits


def compact_log(
    log: DataFrame,
    lo: datetime,
    hi: datetime,
    windows: DataFrame | None,
    statuses: Sequence[str],
) -> DataFrame:
    """One row per port and minute, and one for everything up to ``lo``.

    ``_last`` packs the last row's time and status code into one integer, so the
    aggregate is a plain maximum; rows inside an outage count in ``_inside`` (they
    decide whether the port has a lower bound) but not in ``_last``.
    """
    ts = F.col("update_time")
    rows = log.where((ts <= ntz(hi)) & F.col("status").isNotNull())
    if windows is not None:
        rows = flag_in_outage(rows, windows, "_out")
    else:
        rows = rows.withColumn("_out", F.lit(False))
    rows = rows.select(
        *CPO_PORT,
        epoch_micro(ts).alias("_us"),
        status_code(F.col("status"), statuses).alias("_code"),
        "_out",
    )
    us = F.col("_us")
    lo_us, hi_us = seconds_of(lo) * 1_000_000, seconds_of(hi) * 1_000_000
    before = us <= lo_us
    minute = F.when(before, F.lit(-1).cast("bigint")).otherwise(whole_minutes(us))
    packed = F.when(~F.col("_out"), F.shiftleft(us, code_bits(statuses)) + F.col("_code"))
    return rows.groupBy(*CPO_PORT, minute.alias("_minute")).agg(
        F.max(packed).alias("_last"),
        F.count(F.when((us > lo_us) & (us < hi_us), 1)).alias("_inside"),
    )


def timeline(
    log: DataFrame,
    ports: DataFrame,
    lo: datetime,
    hi: datetime,
    windows: DataFrame | None = None,
    statuses: Sequence[str] = STATUSES,
    carry_idle_ports: bool = False,
    keep_first_seen: bool = False,
    every_edge: bool = True,
) -> DataFrame:
    """Per port, the moments its status changed inside the period, in order.

    Columns: the port keys, ``_us`` (microseconds), ``_code``, ``_start`` and
    ``_end`` (whole seconds, cut to the minute), ``_new`` (first seen inside the
    period). The row carried in from before the period starts at ``lo``.

    ``ports`` lists the ports of interest with their operator; the outage rows are
    made from it, and a port without log rows drops out again.

    A port needs a lower bound: a row carried in and one inside the period, or two
    inside. ``carry_idle_ports`` keeps a port with a carried row only,
    ``keep_first_seen`` one with a single row inside. Without ``every_edge`` the ends of outages
    that change no port's status have no rows, which is all that durations need.
    """
    lo_s, hi_s = seconds_of(lo), seconds_of(hi)
    if windows is not None:
        windows = closed_windows(windows, hi)
    bits = code_bits(statuses)
    compact = compact_log(log, lo, hi, windows, statuses).select(
        *CPO_PORT,
        F.shiftright(F.col("_last"), bits).alias("_us"),
        F.col("_last").bitwiseAND(F.lit((1 << bits) - 1).cast("bigint")).alias("_code"),
        "_inside",
        F.lit(_LOGGED).alias("_kind"),
    )
    rows = compact
    if windows is not None:
        online, offline = F.col("online_timestamp"), F.col("offline_timestamp")
        edges = F.array(
            F.struct(
                epoch_micro(online).alias("us"),
                F.lit(None).cast("bigint").alias("code"),
                F.lit(_ONLINE).alias("kind"),
                F.lit(None).cast("bigint").alias("until"),
            ),
            F.struct(
                epoch_micro(offline).alias("us"),
                F.lit(list(statuses).index(MISSING)).cast("bigint").alias("code"),
                F.lit(_OFFLINE).alias("kind"),
                F.when(online > offline, epoch_micro(online)).alias("until"),
            ),
        )
        # As in the log, only the last edge of a kind in a minute can matter.
        minutes = (
            windows.select("cpo_name", F.explode(edges).alias("_e"))
            .groupBy("cpo_name", "_e.kind", "_e.code", whole_minutes(F.col("_e.us")).alias("_m"))
            .agg(F.max("_e.us").alias("_us"), F.max("_e.until").alias("_until"))
        )
        if not every_edge:
            minutes = _telling_edges(minutes)
        added = (
            ports.select(*CPO_PORT)
            .join(minutes, "cpo_name")
            .select(
                *CPO_PORT,
                "_us",
                F.col("code").alias("_code"),
                F.lit(0).cast("bigint").alias("_inside"),
                F.col("kind").alias("_kind"),
            )
        )
        rows = rows.unionByName(added)

    # All that follows works port by port on this one shuffle. Half-hour rows come out
    # of it many times larger than what went in, so its width is the configured one
    # rather than one adapted to the input.
    width = int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(width, *PORT_KEYS)
    port = Window.partitionBy(*PORT_KEYS)
    ordered = port.orderBy("_us", "_kind")
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    logged = F.col("_kind") == _LOGGED
    carried = F.max(F.when(logged & (F.col("_us") <= lo_s * 1_000_000), 1)).over(port)
    inside = F.sum("_inside").over(port)
    alive = F.max(F.when(logged & F.col("_us").isNotNull(), 1)).over(port)
    bounded = (inside >= (1 if keep_first_seen else 2)) | (
        carried.isNotNull() & (inside >= (0 if carry_idle_ports else 1))
    )
    known = F.last(F.when(F.col("_kind") != _OFFLINE, F.col("_code")), ignorenulls=True).over(upto)
    rows = (
        rows.withColumn("_known", known)
        .withColumn("_keep", bounded & alive.isNotNull())
        .withColumn("_code", F.when(F.col("_kind") == _ONLINE, F.col("_known")).otherwise(F.col("_code")))
        .where(F.col("_keep") & F.col("_us").isNotNull() & F.col("_code").isNotNull())
    )
    first_us = F.min("_us").over(port)
    minute_s = whole_minutes(F.col("_us")) * 60
    lo_minute = lo_s - lo_s % 60
    rows = (
        rows.withColumn("_new", first_us > lo_s * 1_000_000)
        .withColumn(
            "_start",
            F.when(~F.col("_new") & (F.col("_us") == first_us), F.lit(lo_minute).cast("bigint"))
            .otherwise(F.least(minute_s, F.lit(hi_s).cast("bigint"))),
        )
        .withColumn("_end", F.coalesce(F.lead("_start").over(ordered), F.lit(hi_s).cast("bigint")))
    )
    return rows.select(*CPO_PORT, "_us", "_kind", "_code", "_new", "_start", "_end")


def _telling_edges(edges: DataFrame) -> DataFrame:
    """The ends of an operator's outages that can change a port's status.

    Overlapping outages end and begin many times over. Back online twice in a row: the port has its last
    logged status already. Offline twice in a row, while an outage that is open at the first
    lasts beyond the second: no log row lies between, and the port is missing already. An
    operator has as many edges as the period has minutes at most.
    """
    ordered = Window.partitionBy("cpo_name").orderBy("_us", "kind")
    before = F.lag("kind").over(ordered)
    open_until = F.max("_until").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    kind = F.col("kind")
    again = (before == kind) & ((kind == _ONLINE) | (open_until > F.col("_us")))
    return edges.withColumn("_again", F.coalesce(again, F.lit(False))).where(~F.col("_again")).drop("_again")


def amended_events(rows: DataFrame, hi: datetime, statuses: Sequence[str] = STATUSES) -> DataFrame:
    """The timeline as log rows, with each port's last status repeated at the end.

    One row per port and minute: what a later row of the same minute overrides has no
    length and is left out.
    """
    rows = rows.where(F.col("_end") > F.col("_start"))
    port = Window.partitionBy(*PORT_KEYS).orderBy("_us", "_kind")
    hi_s = F.lit(seconds_of(hi)).cast("bigint")
    last = F.lead("_start").over(port).isNull()
    moments = F.when(last, F.array(F.col("_start"), hi_s)).otherwise(F.array("_start"))
    return (
        rows.select(*PORT_KEYS, "cpo_name", "_code", "_new", moments.alias("_m"))
        .select(*PORT_KEYS, "cpo_name", "_code", "_new", F.explode("_m").alias("_t"))
        .select(
            *PORT_KEYS,
            "cpo_name",
            status_of(F.col("_code"), statuses).alias("status"),
            from_epoch_second(F.col("_t")).alias("update_time"),
            F.col("_new").cast("int").alias("new_evse"),
        )
    )


def all_amended_events(events: DataFrame, lo: datetime, hi: datetime) -> DataFrame:
    """The period's rows cut to the minute, rows overridden within a minute included.

    ``events`` are the rows from the carried-in one to ``hi``, with their outage rows.
    The first row of a port that is not new moves to ``lo``; every row at its last
    moment is repeated at ``hi``. A row without status is left out. One with ``_times``
    stands for so many equal ones, which are made last.
    """
    # Read for the first and last moments and for the rows; one line per port joins back.
    rows = settle(events.where(F.col("status").isNotNull()))
    ts = F.col("update_time")
    ends = settle(rows.groupBy(*PORT_KEYS).agg(F.min(ts).alias("_first"), F.max(ts).alias("_last")))
    new = F.col("_first") > ntz(lo)
    begin = F.when(~new & (ts == F.col("_first")), ntz(lo)).otherwise(ts)
    moments = F.when(ts == F.col("_last"), F.array(begin, ntz(hi))).otherwise(F.array(begin))
    more = [c for c in rows.columns if c == "_times"]
    amended = (
        rows.join(ends, list(PORT_KEYS))
        .select(*CPO_PORT, "status", new.cast("int").alias("new_evse"), *more, F.explode(moments).alias("_t"))
        .select(*CPO_PORT, "status", truncate_minute(F.col("_t")).alias("update_time"), "new_evse", *more)
    )
    return repeated(amended) if more else amended


def status_of(code: Column, statuses: Sequence[str]) -> Column:
    return F.element_at(F.lit(list(statuses)), (code + 1).cast("int"))


def status_durations(
    rows: DataFrame, statuses: Sequence[str] = STATUSES, as_runs: bool = False
) -> DataFrame:
    """Observed seconds per port, bucket and status (no fill).

    ``as_runs`` leaves equal buckets one run: ``_from`` and ``_to`` instead of ``update_time``.
    """
    shown = F.array(*[F.struct(F.lit(s).alias("status"), F.col(s).alias("status_duration")) for s in statuses])
    observed = runs(rows, statuses).withColumn("_s", F.filter(shown, lambda r: r["status_duration"] > 0))
    if as_runs:
        return observed.select(*PORT_KEYS, "_from", "_to", F.inline("_s"))
    half_hours = unrolled(observed, [*PORT_KEYS, "update_time", "_s"])
    return half_hours.select(*PORT_KEYS, "update_time", F.inline("_s"))


def _seen(rows: DataFrame) -> Column:
    """Scalar facts about the whole timeline: first bucket and statuses that occur."""
    facts = rows.where(F.col("_end") > F.col("_start")).agg(
        F.struct(
            F.min(bucket_second(F.col("_start"))).alias("start"),
            F.collect_set(F.col("_code")).alias("codes"),
        ).alias("facts")
    )
    return facts.scalar()


def runs(rows: DataFrame, statuses: Sequence[str], grid_start: Column | None = None) -> DataFrame:
    """Stretches as runs of equal buckets: port, ``_first``, ``_from``, ``_to``, a column per status.

    A stretch fills the buckets between its two ends alone, so these stay one row. Only
    the buckets that a stretch begins or ends in are shared and summed; a port's first
    bucket always stands alone. What is held and summed thus follows the stretches, not the
    half hours; :func:`unrolled` makes the half hours, row by row. With ``grid_start`` an
    empty run leads up to a port's first bucket.
    """
    width = F.lit(BUCKET_SECONDS).cast("bigint")
    # the stretches of a stored timeline are few bytes; what they unroll to is not
    rows = rows.repartition(parts_for(rows, STRETCHES), *PORT_KEYS)
    first = F.min("_start").over(Window.partitionBy(*PORT_KEYS))
    stretches = rows.withColumn("_least", first).where(F.col("_end") > F.col("_start"))
    start, end = F.col("_start"), F.col("_end")
    leads = start == F.col("_least")
    head, tail = bucket_second(start), bucket_second(end)
    split = leads | (start != head)

    def run(begin: Column, last: Column, seconds: Column) -> Column:
        return F.struct(begin.alias("begin"), last.alias("last"), seconds.alias("seconds"))

    whole = F.when(split, head + width).otherwise(head)
    kinds = [
        F.when(split, run(head, head, F.least(end, head + width) - start)),
        F.when(whole < tail, run(whole, tail - width, width)),
        F.when((tail < end) & (tail >= whole), run(tail, tail, end - tail)),
    ]
    if grid_start is not None:
        kinds.append(F.when(leads & (grid_start < head), run(grid_start, head - width, F.lit(0).cast("bigint"))))
    cut = stretches.select(
        *PORT_KEYS,
        bucket_second(F.col("_least")).alias("_first"),
        "_code",
        F.explode(F.array(*kinds)).alias("_r"),
    ).where(F.col("_r").isNotNull())
    seconds = F.col("_r.seconds")
    return cut.groupBy(
        *PORT_KEYS, "_first", F.col("_r.begin").alias("_from"), F.col("_r.last").alias("_to")
    ).agg(*[F.sum(F.when(F.col("_code") == i, seconds).otherwise(0)).alias(s) for i, s in enumerate(statuses)])


def unrolled(runs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per half hour (``update_time``) of each run, with ``columns``."""
    begin, last = from_epoch_second(F.col("_from")), from_epoch_second(F.col("_to"))
    buckets = F.sequence(begin, last, F.expr(f"INTERVAL '{BUCKET_SECONDS // 60}' MINUTE"))
    return runs.withColumn("update_time", F.explode(buckets)).select(*columns)


def runs_of_half_hours(fact: DataFrame) -> DataFrame:
    """Each half hour (``update_time``) as a run of its own."""
    second = epoch_second(F.col("update_time"))
    return fact.where(F.col("update_time").isNotNull()).withColumns({"_from": second, "_to": second}).drop("update_time")


def is_runs(fact: DataFrame) -> bool:
    """Does a row stand for a run of equal half hours (``_from`` to ``_to``), not for one?"""
    return {"_from", "_to"} <= set(fact.columns)


def half_hours() -> Column:
    """The number of half hours of a run."""
    return F.expr(f"(_to - _from) div {BUCKET_SECONDS} + 1")


def by_day(runs: DataFrame) -> DataFrame:
    """Runs cut at midnight, with the ``_day`` they lie in.

    ``_day`` is the moment from which the half hours of a run's grid count, which is midnight
    where the grid holds it.
    """
    day = 86_400

    def of(second: str) -> Column:
        return F.expr(f"{second} - pmod({second}, {day}) div {BUCKET_SECONDS} * {BUCKET_SECONDS}")

    days = F.sequence(of("_from"), of("_to"), F.lit(day).cast("bigint"))
    last = F.col("_day") + F.lit(day - BUCKET_SECONDS).cast("bigint")
    return runs.withColumn("_day", F.explode(days)).withColumns(
        {"_from": F.greatest("_from", "_day"), "_to": F.least(F.col("_to"), last)}
    )


#: The place of a second among the half hours of its ``_day``.
SLOT = f"cast((%s - _day) div {BUCKET_SECONDS} AS int)"


def day_bits() -> Column:
    """The half hours of a run that lies in one ``_day``, as bits from the lowest."""
    return F.expr(f"shiftleft(shiftleft(1L, {SLOT % '_to'} - {SLOT % '_from'} + 1) - 1L, {SLOT % '_from'})")


def runs_of_bits() -> Column:
    """The half hours told by the ``_bits`` of a ``_day``, as an array of runs."""
    slots = "sequence(0, 47)"
    begins, ends = "_bits & ~shiftleft(_bits, 1)", "_bits & ~shiftrightunsigned(_bits, 1)"

    def moments(bits: str) -> str:
        set_bits = f"filter({slots}, s -> bit_get({bits}, s) = 1)"
        return f"transform({set_bits}, s -> _day + cast(s * {BUCKET_SECONDS} AS bigint))"

    return F.expr(f"zip_with({moments(begins)}, {moments(ends)}, (b, e) -> named_struct('_from', b, '_to', e))")


def dense_columns(statuses: Sequence[str]) -> list[str]:
    return [*PORT_KEYS, "update_time", *[s for s in statuses if s != UNKNOWN], UNKNOWN, TOTAL]


def dense_runs(
    rows: DataFrame,
    lo: datetime,
    statuses: Sequence[str] = STATUSES,
    residual: str = "reference",
) -> DataFrame:
    """:func:`dense_durations` before it is unrolled: a row per port and run of equal buckets."""
    if residual not in ("reference", "exact"):
        raise ValueError(f"residual must be 'reference' or 'exact', not {residual!r}")
    seen = _seen(rows)
    has_missing = F.array_contains(seen["codes"], F.lit(list(statuses).index(MISSING)).cast("bigint"))
    wide = runs(rows, statuses, seen["start"])
    length = F.lit(BUCKET_SECONDS).cast("bigint")
    bucket, first = F.col("_from"), F.col("_first")

    def total_of(names: Sequence[str]) -> Column:
        total = F.lit(0).cast("bigint")
        for n in names:
            total = total + F.col(n)
        return total

    others = [s for s in statuses if s not in (MISSING, UNKNOWN)]
    # a run lies before the first bucket, is the first bucket or lies behind it
    missing = (
        F.when(~has_missing, F.col(MISSING))
        .when(bucket < first, length)
        .when(
            (bucket == first) & (bucket > seconds_of(lo)),
            length - total_of([*others, UNKNOWN]) + F.col(MISSING),
        )
        .otherwise(F.col(MISSING))
    )
    wide = wide.withColumn(MISSING, missing)
    rest = length - total_of([*others, MISSING])
    unknown = F.col(UNKNOWN) + rest if residual == "reference" else rest
    return wide.select(
        *PORT_KEYS, "_from", "_to", *[F.col(s) for s in statuses if s != UNKNOWN], unknown.alias(UNKNOWN), length.alias(TOTAL)
    )


def dense_durations(
    rows: DataFrame,
    lo: datetime,
    statuses: Sequence[str] = STATUSES,
    residual: str = "reference",
) -> DataFrame:
    """One row per port and bucket, one column of seconds per status, and Total.

    Every bucket of the period has a row for every port. Before a port's first
    bucket all the time is ``Missing``, and so is the rest of that first bucket for
    a port first seen inside the period; both only if ``Missing`` occurs at all.
    Time nothing explains goes to ``Unknown``.

    ``residual="reference"`` adds that time to the Unknown observed, which counts
    observed Unknown twice; ``"exact"`` makes every bucket add up to 1,800.

    Wide rows need neither a status axis in the shuffle nor a window for the
    residual: it is row arithmetic.
    """
    return unrolled(dense_runs(rows, lo, statuses, residual), dense_columns(statuses))


def long_durations(
    dense: DataFrame, statuses: Sequence[str] = STATUSES, only: Column | None = None
) -> DataFrame:
    """Dense table in long form: one row per port, bucket and status, and Total.

    ``only`` names the statuses to keep besides Unknown and Total, as
    :func:`observed_statuses` gives them.
    """
    values = [*statuses, TOTAL]
    ids = [c for c in dense.columns if c not in values]
    long = dense.unpivot(ids, values, "status", "status_duration")
    if only is not None:
        status = F.col("status")
        code = F.array_position(F.lit(list(statuses)), status).cast("bigint") - 1
        long = long.where(status.isin(UNKNOWN, TOTAL) | F.array_contains(only, code))
    return long


def observed_statuses(rows: DataFrame) -> Column:
    """The codes of the statuses that occur in a timeline, as a scalar."""
    return _seen(rows)["codes"]


def fill_residual(
    durations: DataFrame,
    keys: Sequence[str],
    target: str,
    length: int = BUCKET_SECONDS,
    residual: str = "reference",
) -> DataFrame:
    """Long-form residual: give ``target`` the time the other statuses leave.

    One window over the rows of a bucket, of which there are as many as statuses.
    """
    status, seconds = F.col("status"), F.col("status_duration")
    others = F.sum(F.when(~status.isin(TOTAL, target), seconds)).over(Window.partitionBy(*keys))
    rest = F.lit(length) - others
    new = seconds + rest if residual == "reference" else rest
    return durations.withColumn(
        "status_duration", F.when(status == target, new).otherwise(seconds).cast("bigint")
    )
