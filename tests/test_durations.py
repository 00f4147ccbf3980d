"""Status durations against small known cases and a brute-force 30-second grid."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from portpulse.functions.clock import period_bounds, previous_month
from portpulse.operators import durations
from portpulse.plans.monthly import statuses_of
from portpulse.schema import REPORTED_STATUSES

LO, HI = datetime(2024, 1, 1), datetime(2024, 1, 1, 6)
PORT = ("E", "P", "A")


def day(text):
    return f"2024-01-01 {text}"


def timeline(log, windows=None, **options):
    ports = log.select("evse_id", "evse_port_id", "cpo_name").distinct()
    return durations.timeline(log, ports, LO, HI, windows, **options)


def observed(log, windows=None, **options):
    rows = durations.status_durations(timeline(log, windows, **options)).collect()
    return {(r.evse_port_id, r.update_time, r.status): r.status_duration for r in rows}


def dense(log, windows=None, **options):
    rows = durations.dense_durations(timeline(log, windows), LO, **options).collect()
    return {(r.evse_port_id, r.update_time): r.asDict() for r in rows}


def total(result, status):
    return sum(v for (_, _, s), v in result.items() if s == status)


def test_last_event_of_a_minute_wins(make_log):
    log = make_log(
        [
            (*PORT, "Available", "2023-12-31 23:00:00"),
            (*PORT, "Charging", day("01:00:10")),
            (*PORT, "Reserved", day("01:00:40.5")),
            (*PORT, "Finishing", day("01:00:40.25")),
        ]
    )
    result = observed(log)
    assert total(result, "Available") == 3600
    assert total(result, "Reserved") == 5 * 3600
    assert total(result, "Charging") == total(result, "Finishing") == 0


def test_edges_of_buckets_and_period(make_log):
    log = make_log(
        [
            (*PORT, "Available", "2024-01-01 00:00:00"),
            (*PORT, "Charging", day("00:30:00")),
            (*PORT, "Finishing", day("01:00:59")),
            (*PORT, "Reserved", day("06:00:00")),
            (*PORT, "Reserved", day("07:00:00")),
        ]
    )
    result = observed(log)
    assert result[("P", LO, "Available")] == 1800
    assert result[("P", LO + timedelta(minutes=30), "Charging")] == 1800
    assert total(result, "Charging") == 1800
    assert total(result, "Finishing") == 5 * 3600
    assert total(result, "Reserved") == 0
    assert all(v > 0 for v in result.values())


def test_which_ports_are_kept(make_log):
    log = make_log(
        [
            ("E", "single", "A", "Charging", day("01:00:00")),
            ("E", "idle", "A", "Charging", "2023-12-30 01:00:00"),
            ("E", "two", "A", "Charging", day("01:00:00")),
            ("E", "two", "A", "Charging", day("02:00:00")),
        ]
    )
    ports = {k[0] for k in observed(log)}
    assert ports == {"two"}
    assert {k[0] for k in observed(log, carry_idle_ports=True)} == {"two", "idle"}
    assert {k[0] for k in observed(log, keep_first_seen=True)} == {"two", "single"}


def test_new_port_without_missing_counts_as_unknown(make_log):
    log = make_log(
        [
            ("E", "old", "A", "Available", "2023-12-31 01:00:00"),
            ("E", "old", "A", "Available", day("03:00:00")),
            ("E", "new", "A", "Charging", day("02:10:00")),
            ("E", "new", "A", "Charging", day("05:00:00")),
        ]
    )
    result = dense(log)
    assert len(result) == 24
    assert result[("new", LO)]["Unknown"] == 1800
    assert result[("new", LO + timedelta(hours=2))]["Unknown"] == 600
    assert result[("new", LO + timedelta(hours=2))]["Charging"] == 1200


def test_new_port_with_missing_elsewhere(make_log, make_windows):
    log = make_log(
        [
            ("E", "old", "B", "Available", "2023-12-31 01:00:00"),
            ("E", "old", "B", "Available", day("03:00:00")),
            ("E", "new", "A", "Charging", day("02:10:00")),
            ("E", "new", "A", "Charging", day("05:00:00")),
        ]
    )
    windows = make_windows([("B", day("04:00:00"), day("04:20:00"))])
    result = dense(log, windows)
    assert result[("new", LO)]["Missing"] == 1800
    first = result[("new", LO + timedelta(hours=2))]
    assert (first["Missing"], first["Charging"], first["Unknown"]) == (600, 1200, 0)
    assert result[("old", LO + timedelta(hours=4))]["Missing"] == 1200
    assert result[("old", LO + timedelta(hours=4))]["Available"] == 600


def test_observed_unknown_is_counted_on_top_unless_exact(make_log):
    log = make_log(
        [
            (*PORT, "Unknown", "2023-12-31 01:00:00"),
            (*PORT, "Available", day("00:10:00")),
        ]
    )
    assert dense(log)[("P", LO)]["Unknown"] == 1200
    exact = dense(log, residual="exact")
    assert exact[("P", LO)]["Unknown"] == 600
    assert all(
        sum(r[s] for s in durations.STATUSES) == 1800 == r["Total"] for r in exact.values()
    )


def test_undeclared_status_counts_as_unknown(spark, make_log):
    log = make_log([(*PORT, "Sleeping", day("00:10:00")), (*PORT, "Available", day("00:20:00"))])
    assert {status for _, _, status in observed(log)} == {"Unknown", "Available"}
    types = spark.createDataFrame([(1, "Sleeping"), (2, "Blocked"), (3, None)], "id long, name string")
    assert statuses_of(types) == [*durations.STATUSES, "Sleeping"]
    many = [*durations.STATUSES, *(f"s{i}" for i in range(60)), "Sleeping"]
    rows = durations.timeline(log, log, LO, HI, None, many)
    assert "Sleeping" in {r.status for r in durations.status_durations(rows, many).collect()}
    statuses = [*durations.STATUSES, "Sleeping"]
    ports = log.select("evse_id", "evse_port_id", "cpo_name").distinct()
    rows = durations.timeline(log, ports, LO, HI, None, statuses)
    named = durations.status_durations(rows, statuses).where("status = 'Sleeping'")
    assert named.groupBy().sum("status_duration").first()[0] == 600


def test_amended_events(make_log):
    log = make_log(
        [
            (*PORT, "Available", "2023-12-31 01:00:00"),
            (*PORT, "Charging", day("00:10:30")),
        ]
    )
    rows = durations.amended_events(timeline(log), HI).orderBy("update_time").collect()
    assert [(r.status, r.update_time, r.new_evse) for r in rows] == [
        ("Available", LO, 0),
        ("Charging", datetime(2024, 1, 1, 0, 10), 0),
        ("Charging", HI, 0),
    ]


def test_all_amended_events_has_rows_overridden_in_their_minute(make_log):
    log = make_log(
        [
            (*PORT, "Available", "2023-12-31 01:00:00"),
            (*PORT, "Charging", day("00:10:10")),
            (*PORT, "Finishing", day("00:10:40")),
        ]
    )
    rows = durations.all_amended_events(log, LO, HI).collect()
    minute = datetime(2024, 1, 1, 0, 10)
    assert sorted((r.update_time, r.status, r.new_evse) for r in rows) == [
        (LO, "Available", 0),
        (minute, "Charging", 0),
        (minute, "Finishing", 0),
        (HI, "Finishing", 0),
    ]


def by_grid(rows, windows):
    """Per port: rows outside outages, synthetic rows, then every 30 seconds."""
    ports = defaultdict(list)
    for e, p, c, s, t in rows:
        ports[(e, p, c)].append((t, s))
    sums = defaultdict(int)
    for key, log in ports.items():
        log = sorted(r for r in log if r[0] <= HI)
        before = [r for r in log if r[0] <= LO]
        inside = [r for r in log if LO < r[0] < HI]
        if not inside or (not before and len(inside) < 2):
            continue
        log = (before[-1:] if before else []) + [r for r in log if r[0] > LO]
        mine = [(a, b) for c, a, b in windows if c == key[2]]
        log = [r for r in log if not any(a < r[0] < b for a, b in mine)]
        if not log:
            continue
        events = [(t, 0, s) for t, s in log]
        for a, b in mine:
            known = [s for t, s in log if t <= b]
            if known:
                events.append((b, 1, known[-1]))
            events.append((a, 2, "Missing"))
        events.sort(key=lambda r: r[:2])
        new = events[0][0] > LO
        if not new:
            events[0] = (LO, *events[0][1:])
        moments = {}
        for t, _, s in events:
            moments[t.replace(second=0, microsecond=0)] = s
        tick, state = min(moments), None
        while tick < HI:
            state = moments.get(tick, state)
            bucket = tick.replace(second=0) - timedelta(minutes=tick.minute % 30)
            sums[(key[1], bucket, state)] += 30
            tick += timedelta(seconds=30)
    return dict(sums)


@pytest.mark.parametrize("seed", range(4))
def test_random_logs_match_the_grid(make_log, make_windows, seed):
    rng = random.Random(seed)
    rows = []
    for port in range(8):
        start = LO - timedelta(hours=3) if port % 3 else LO + timedelta(minutes=20)
        for _ in range(rng.randint(1, 40)):
            t = start + timedelta(seconds=rng.randint(0, 9 * 3600), microseconds=rng.randint(0, 9))
            rows.append((f"E{port // 2}", f"P{port}", "AB"[port % 2], rng.choice(REPORTED_STATUSES), t))
    windows = [("A", LO + timedelta(minutes=70, seconds=20), LO + timedelta(minutes=130, seconds=45))]
    windows.append(("B", LO + timedelta(minutes=200), LO + timedelta(hours=8)))
    log = make_log([(*r[:4], r[4].isoformat(sep=" ")) for r in rows])
    frame = make_windows([(c, a.isoformat(), b.isoformat()) for c, a, b in windows])
    assert observed(log, frame) == by_grid(rows, windows)


def test_period_bounds():
    lo, hi = period_bounds("2025-05-01", "2025-05-31")
    assert (lo, hi) == (datetime(2025, 4, 30, 13), datetime(2025, 5, 31, 13))
    assert previous_month(datetime(2025, 1, 15)) == (datetime(2024, 12, 1), datetime(2025, 1, 1))


def test_chatty_port_is_compacted_before_it_is_ordered(spark, make_log):
    """A port with most of the log enters the ordered windows with one row per minute."""
    busy = spark.range(200_000).selectExpr(
        "'E' as evse_id",
        "'busy' as evse_port_id",
        "'A' as cpo_name",
        "if(id % 2 = 0, 'Charging', 'Available') as status",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 0.1) as update_time",
    )
    quiet = make_log([("E", "quiet", "A", "Reserved", "2023-12-31 10:00:00"), ("E", "quiet", "A", "Reserved", day("01:00:00"))])
    log = busy.unionByName(quiet)
    compact = durations.compact_log(log, LO, HI, None, durations.STATUSES)
    assert compact.where("evse_port_id = 'busy'").count() == 200_000 // 600 + 2
    result = observed(log)
    assert total(result, "Reserved") == 6 * 3600
    assert total(result, "Charging") + total(result, "Available") == 6 * 3600


def test_what_is_summed_follows_the_stretches(make_log):
    """A long stretch is one row until the half hours are made, and these are as before."""
    log = make_log(
        [
            (*PORT, "Available", "2023-12-31 23:00:00"),
            (*PORT, "Charging", day("00:40:00")),
            (*PORT, "Available", day("05:10:00")),
        ]
    )
    rows = timeline(log)
    runs = durations.dense_runs(rows, LO).collect()
    shown = sorted((r["_from"] % 86400 // 60, r["_to"] % 86400 // 60, r.Available, r.Charging) for r in runs)
    assert shown == [(0, 0, 1800, 0), (30, 30, 600, 1200), (60, 270, 0, 1800), (300, 300, 1200, 600), (330, 330, 1800, 0)]
    result = dense(log)
    assert len(result) == 12 and total(observed(log), "Charging") == 16200
    assert all(r["Available"] + r["Charging"] == r["Total"] == 1800 for r in result.values())


def test_status_durations_as_runs(make_log):
    log = make_log([(*PORT, "Available", "2023-12-31 23:00:00"), (*PORT, "Charging", day("01:10:10")), (*PORT, "Reserved", day("04:00:40"))])
    rows = timeline(log)
    runs = durations.status_durations(rows, as_runs=True)
    assert runs.count() == 6  # one line per run and status, one half hour has two
    half_hours = durations.unrolled(runs, [*durations.PORT_KEYS, "update_time", "status", "status_duration"])
    assert sorted(half_hours.collect()) == sorted(durations.status_durations(rows).collect())


def test_durations_need_no_edges_of_outages_that_overlap(make_log, make_windows):
    """Nested, touching, repeated and inverted windows, whose ends partly change no status."""
    rng = random.Random(11)

    def moment():
        return str(LO + timedelta(seconds=rng.randrange(6 * 3600)))

    log = [("E", f"P{p}", rng.choice("AB"), rng.choice(REPORTED_STATUSES), "2023-12-31 23:00:00") for p in range(6)]
    cpo = {p: c for _, p, c, _, _ in log}
    log += [("E", p, cpo[p], rng.choice(REPORTED_STATUSES), moment()) for p in sorted(cpo) for _ in range(25)]
    windows = [(c, *rng.sample([moment(), moment()], 2)) for c in "AB" for _ in range(6)]
    windows += [("A", day("02:00:00"), day(f"0{h}:{m:02}:00")) for h in (2, 3) for m in range(5, 60, 5)]
    windows += [("A", log[8][4], day("05:30:00")), ("B", day("05:00:00"), None), ("B", day("05:10:20"), log[-1][4])]
    log, windows = make_log(log), make_windows(windows)
    every, telling = (timeline(log, windows, every_edge=e) for e in (True, False))
    assert telling.count() < every.count() / 1.2
    got = [sorted(map(str, durations.dense_durations(rows, LO).collect())) for rows in (every, telling)]
    assert got[0] == got[1]
    assert len(got[0]) == 12 * 6
