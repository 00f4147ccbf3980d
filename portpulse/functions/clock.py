"""Time expressions on ``timestamp_ntz`` columns that hold UTC wall-clock time.

None of them reads the session time zone, so a result does not depend on the
cluster's settings.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from portpulse.schema import BUCKET_SECONDS, PERIOD_SHIFT_HOURS, STATE_TIMEZONES

_EPOCH = datetime(1970, 1, 1)


def ntz(value: datetime | str) -> Column:
    """A ``timestamp_ntz`` literal (``F.lit(datetime)`` would be a zoned one)."""
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def to_datetime(value: datetime | str) -> datetime:
    return value if isinstance(value, datetime) else datetime.fromisoformat(value)


def seconds_of(value: datetime | str) -> int:
    """Whole seconds since 1970 of a driver-side period bound."""
    return int((to_datetime(value) - _EPOCH).total_seconds())


def epoch_minute(ts: Column) -> Column:
    days = F.unix_date(ts.cast("date")).cast("bigint")
    return days * 1440 + F.hour(ts) * 60 + F.minute(ts)


def epoch_second(ts: Column) -> Column:
    """Whole seconds since 1970; fractions are cut off."""
    return epoch_minute(ts) * 60 + F.second(ts)


def epoch_micro(ts: Column) -> Column:
    fraction = F.date_part(F.lit("SECOND"), ts)
    return epoch_minute(ts) * 60_000_000 + (fraction * 1_000_000).cast("bigint")


def from_epoch_second(seconds: Column) -> Column:
    return ntz("1970-01-01 00:00:00") + seconds * F.expr("INTERVAL '1' SECOND")


def bucket_second(seconds: Column, width: int = BUCKET_SECONDS) -> Column:
    return seconds - F.pmod(seconds, F.lit(width).cast("bigint"))


def bucket_start(ts: Column, width: int = BUCKET_SECONDS) -> Column:
    return from_epoch_second(bucket_second(epoch_second(ts), width))


def truncate_minute(ts: Column) -> Column:
    return from_epoch_second(epoch_minute(ts) * 60)


def period_bounds(
    start: datetime | str,
    end: datetime | str,
    shift_hours: int = PERIOD_SHIFT_HOURS,
) -> tuple[datetime, datetime]:
    """UTC bounds of a period given as local dates.

    Both bounds move back by one fixed shift and the end day counts in full.
    The shift is one number for every state and season, which is a parameter
    because it is only right for part of the year.
    """
    shift = timedelta(hours=shift_hours)
    return to_datetime(start) - shift, to_datetime(end) + timedelta(days=1) - shift


def previous_month(today: datetime) -> tuple[datetime, datetime]:
    """First day of the previous month and first day of this month."""
    this_month = datetime(today.year, today.month, 1)
    last_of_previous = this_month - timedelta(days=1)
    return datetime(last_of_previous.year, last_of_previous.month, 1), this_month


def local_time(ts: Column, state: Column) -> Column:
    """UTC wall-clock time -> the state's local wall-clock time."""
    converted = ts
    for zone in sorted(set(STATE_TIMEZONES.values())):
        states = [s for s, z in STATE_TIMEZONES.items() if z == zone]
        converted = F.when(
            state.isin(states), F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)
        ).otherwise(converted)
    return converted


def zone_offsets(zone: str, lo: datetime, hi: datetime) -> list[tuple[datetime, timedelta]]:
    """UTC offsets of a zone between two UTC moments: (valid from, offset)."""
    info = ZoneInfo(zone)

    def offset(at: datetime) -> timedelta:
        return at.replace(tzinfo=timezone.utc).astimezone(info).utcoffset() or timedelta(0)

    steps = [(lo, offset(lo))]
    at = lo
    while at < hi:
        following = min(at + timedelta(days=1), hi)
        if offset(following) != offset(at):
            before, after = at, following
            while after - before > timedelta(minutes=1):
                middle = before + (after - before) / 2
                if offset(middle) == offset(at):
                    before = middle
                else:
                    after = middle
            moment = after.replace(second=0, microsecond=0)
            steps.append((moment, offset(following)))
        at = following
    return steps


def local_time_between(
    ts: Column, state: Column, start: datetime | str, end: datetime | str
) -> Column:
    """:func:`local_time` for rows whose local time is between two dates.

    A zone's offset changes at most a few times in such a range, so the conversion is
    a comparison and an addition per row instead of calendar arithmetic. Rows outside
    the range get a time that is outside it too.
    """
    lo, hi = to_datetime(start) - timedelta(days=2), to_datetime(end) + timedelta(days=2)
    converted = ts
    for zone in sorted(set(STATE_TIMEZONES.values())):
        states = [s for s, z in STATE_TIMEZONES.items() if z == zone]
        steps = zone_offsets(zone, lo, hi)
        local = _shifted(ts, steps[0][1])
        for moment, offset in steps[1:]:
            local = F.when(ts >= ntz(moment), _shifted(ts, offset)).otherwise(local)
        converted = F.when(state.isin(states), local).otherwise(converted)
    return converted


def local_second_between(
    second: Column, state: Column, start: datetime | str, end: datetime | str
) -> Column:
    """:func:`local_time_between` in whole seconds since 1970."""
    lo, hi = to_datetime(start) - timedelta(days=2), to_datetime(end) + timedelta(days=2)
    shift = F.lit(0)
    for zone in sorted(set(STATE_TIMEZONES.values())):
        states = [s for s, z in STATE_TIMEZONES.items() if z == zone]
        first, *later = zone_offsets(zone, lo, hi)
        local = F.lit(int(first[1].total_seconds()))
        for moment, offset in later:
            local = F.when(second >= seconds_of(moment), int(offset.total_seconds())).otherwise(local)
        shift = F.when(state.isin(states), local).otherwise(shift)
    return second + shift


def clock_changes(start: datetime | str, end: datetime | str) -> list[tuple[list[str], int]]:
    """Seconds (UTC) at which :func:`local_second_between` changes an offset, with the states."""
    lo, hi = to_datetime(start) - timedelta(days=2), to_datetime(end) + timedelta(days=2)
    changes = []
    for zone in sorted(set(STATE_TIMEZONES.values())):
        states = [s for s, z in STATE_TIMEZONES.items() if z == zone]
        changes += [(states, seconds_of(moment)) for moment, _ in zone_offsets(zone, lo, hi)[1:]]
    return changes


def _shifted(ts: Column, offset: timedelta) -> Column:
    return ts + F.expr(f"INTERVAL '{int(offset.total_seconds() // 60)}' MINUTE")


def week_of_month(ts: Column) -> Column:
    return F.floor((F.dayofmonth(ts) - 1) / 7).cast("int") + 1


def midnight(date: Column) -> Column:
    return date.cast("date").cast("timestamp_ntz")
