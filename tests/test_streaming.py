"""Both streams equal the batch result, whatever order the events come in."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest

from portpulse.operators import durations
from portpulse.streaming import incremental, live

ROWS = [
    ("E1", "P1", "A", "Available", "2024-01-01 10:00:00"),
    ("E1", "P2", "A", "Charging", "2024-01-01 23:50:00"),
    ("E1", "P1", "A", "Charging", "2024-01-02 08:00:00"),
    ("E2", "P3", "B", "Reserved", "2024-01-03 12:15:00"),
    ("E1", "P1", "A", "Finishing", "2024-01-04 00:00:00"),
]
LATE = [("E1", "P2", "A", "Available", "2024-01-02 12:00:00")]


def whole(log, lo, hi, windows=None):
    """The batch result of everything at once."""
    ports = log.select("evse_id", "evse_port_id", "cpo_name").distinct()
    rows = durations.timeline(
        log, ports, datetime(2024, 1, lo), datetime(2024, 1, hi), windows, carry_idle_ports=True, keep_first_seen=True
    )
    return as_set(durations.status_durations(rows))


def as_set(df):
    return {
        (r.evse_port_id, r.update_time, r.status, r.status_duration)
        for r in df.select("evse_port_id", "update_time", "status", "status_duration").collect()
    }


def files(folder):
    """Data files of a stored table with their contents' stamp."""
    found = Path(folder).rglob("*.parquet")
    return {(str(f.relative_to(folder)), f.stat().st_mtime_ns) for f in found}


def partitions(found):
    return {name.rsplit("/", 1)[0] for name, _ in found}


def test_incremental_durations(spark, make_log, tmp_path):
    store = incremental.Store(spark, str(tmp_path))
    store.add(make_log(ROWS[:2]), 0)
    store.add(make_log(ROWS[2:4]), 1)
    assert as_set(store.durations()) == whole(make_log(ROWS[:4]), 1, 4)
    store.add(make_log(ROWS[4:]), 2)
    store.add(make_log(LATE), 3)
    everything = whole(make_log(ROWS + LATE), 1, 5)
    assert as_set(store.durations()) == everything
    # A batch that is run again changes nothing, and an empty one is harmless.
    store.add(make_log(LATE), 3)
    store.add(make_log(LATE).where("false"), 4)
    assert as_set(store.durations()) == everything


STEPS = [
    # (rows, reported windows)
    (ROWS[:2], []),
    # still open, and one before a port that comes later
    (ROWS[2:4], [("A", "2024-01-02 07:00:00", None), ("B", "2024-01-02 01:00:00", "2024-01-02 02:00:00")]),
    # closed now; a late row that no outage swallows, and one that is swallowed
    (LATE + [("E2", "P3", "B", "Charging", "2024-01-02 01:30:00")], [("A", "2024-01-02 07:00:00", "2024-01-02 09:10:20")]),
    # no rows: a window that arrives after its rows swallows all that P3 has but the late one
    ([], [("B", "2024-01-03 12:00:00", "2024-01-03 13:00:00")]),
    # the log grows at both ends, into a known window's day and before the first one
    (ROWS[4:] + [("E1", "P2", "A", "Reserved", "2023-12-31 05:00:00")], [("A", "2024-01-01 11:00:00", "2024-01-01 12:00:00")]),
    # P3 gets a row that counts
    ([("E2", "P3", "B", "Finishing", "2024-01-02 02:00:00")], []),
]


def test_incremental_durations_with_outages(spark, make_log, make_windows, tmp_path):
    """After each batch, the stored durations are those of the batch job over all so far."""
    store = incremental.Store(spark, str(tmp_path), shard_ports=2)
    rows, told = [], {}
    for number, (new, windows) in enumerate(STEPS):
        store.add(make_log(new), number, make_windows(windows))
        rows, told = rows + new, told | {w[:2]: w for w in windows}
        days = [datetime.fromisoformat(r[4]).date() for r in rows]
        lo, hi = min(days).toordinal(), max(days).toordinal()
        first = datetime(2024, 1, 1).toordinal() - 1
        shift = lambda day: day - first
        begin = datetime.fromordinal(lo)
        current = make_windows([w for w in told.values() if w[1] > str(begin)])
        assert shift(hi) < 31
        ports = make_log(rows).select("evse_id", "evse_port_id", "cpo_name").distinct()
        want = durations.timeline(
            make_log(rows), ports, begin, datetime.fromordinal(hi + 1), current, carry_idle_ports=True, keep_first_seen=True
        )
        assert as_set(store.durations()) == as_set(durations.status_durations(want)), number
    before = as_set(store.durations())
    store.add(make_log(STEPS[5][0]), 5, make_windows([]))
    assert as_set(store.durations()) == before


def test_only_touched_days_are_rewritten(spark, make_log, make_windows, tmp_path):
    store = incremental.Store(spark, str(tmp_path), shard_ports=2)
    rows = [(f"E{p}", f"P{p}", "A", "Available", f"2024-01-{d:02} 0{p}:00:00") for p in range(9) for d in range(1, 11)]
    store.add(make_log(rows), 0)
    assert len(partitions(files(tmp_path / "durations"))) >= 10 * 3  # shards follow the ports
    before = {name: files(tmp_path / name) for name in ("durations", "day_end")}
    late = [("E3", "P3", "A", "Charging", "2024-01-02 12:00:00")]
    store.add(make_log([*late, ("E5", "P5", "A", "Charging", "2024-01-10 20:00:00")]), 1)
    for name, old in before.items():
        now = files(tmp_path / name)
        # from the late row to the port's next one, and the other port's last day
        changed = partitions(old - now)
        assert changed == partitions(now - old)
        assert {p.split("/")[0] for p in changed} == {"day=2024-01-02", "day=2024-01-03", "day=2024-01-10"}
        assert len(changed) == 3
    kept = {name: files(tmp_path / name) for name in before}
    store.add(make_log([]), 2, make_windows([("A", "2024-01-04 03:30:00", "2024-01-04 05:00:00")]))
    for name, old in kept.items():
        days = {p.split("/")[0] for p in partitions(old - files(tmp_path / name))}
        assert days == {"day=2024-01-04", "day=2024-01-05"}


def test_trouble_with_a_stored_table_is_an_error(spark, make_log, tmp_path):
    store = incremental.Store(spark, str(tmp_path))
    store.add(make_log(ROWS[:2]), 0)
    for f in (tmp_path / "day_end").rglob("*.parquet"):
        f.write_bytes(b"not parquet")
        (f.parent / f".{f.name}.crc").unlink()
    with pytest.raises(Exception, match="(?i)parquet"):
        store.add(make_log(ROWS[2:4]), 1)


def test_latest_status_stream(spark, make_log, tmp_path):
    source = str(tmp_path / "in")
    stream = spark.readStream.schema(make_log(ROWS).schema).parquet(source + "/*")
    view = live.LiveView(spark, str(tmp_path / "out"), shards=2)
    for name, rows in (("a", ROWS), ("b", LATE)):
        make_log(rows).write.parquet(f"{source}/{name}")
        view.start(stream, lambda df: df).awaitTermination()
    got = {r.evse_port_id: r.status for r in view.status().collect()}
    assert got == {"P1": "Finishing", "P2": "Available", "P3": "Reserved"}
    places = spark.createDataFrame(
        [("E1", "P1", "A", "x"), ("E1", "P2", "A", "x"), ("E2", "P3", "B", "y")],
        "evse_id string, evse_port_id string, cpo_name string, lga_name string",
    )
    counts = live.availability(view.status(), places).orderBy("cpo_name").collect()
    assert [(r.lga_name, r.ports, r.available_ports) for r in counts] == [("x", 2, 1), ("y", 1, 0)]


def test_live_view_follows_ports_and_not_batches(spark, make_log, tmp_path):
    view = live.LiveView(spark, str(tmp_path), shards=2, horizon=timedelta(hours=1))

    def batch(n):
        rows = [(f"E{p}", f"P{p}", "A", "Available" if n % 2 else "Charging", f"2024-01-0{1 + n} {p:02}:00:00") for p in range(20)]
        return make_log(rows)

    sizes = []
    for n in range(6):
        view.add(batch(n), n)
        rows = [f for f in files(tmp_path / "rows") if "gen=" in f[0]]
        sizes.append(sum((tmp_path / "rows" / name).stat().st_size for name, _ in rows))
        assert view._rows().count() <= 22  # each port's last row, and those of the last hour
    assert max(sizes[1:]) < 1.3 * min(sizes[1:])
    before = files(tmp_path)
    view.add(batch(5), 5)
    assert files(tmp_path) == before
    # a generation without its extent is not read
    make_log([("E1", "P1", "A", "Blocked", "2025-01-01 00:00:00")]).write.parquet(str(tmp_path / "rows/gen=9/shard=0"))
    assert {r.status for r in view.status().collect()} == {"Available"}


def test_live_status_under_outages(spark, make_log, make_windows, tmp_path):
    view = live.LiveView(spark, str(tmp_path), shards=2, horizon=timedelta(hours=12))

    def status():
        return {r.evse_port_id: (r.status, str(r.update_time)) for r in view.status().collect()}

    assert status() == {}
    view.add(
        make_log(
            [
                ("E1", "P1", "A", "Available", "2024-01-01 08:00:00"),
                ("E1", "P2", "A", "Available", "2024-01-01 09:00:00"),
                ("E1", "P2", "A", "Charging", "2024-01-01 10:30:00"),
                ("E2", "P3", "B", "Reserved", "2024-01-01 12:00:00"),
                ("E2", "P4", None, "Reserved", "2024-01-01 12:00:00"),
            ]
        ),
        0,
    )
    assert status()["P2"] == ("Charging", "2024-01-01 10:30:00") and "P4" not in status()
    # the window comes after the row that it swallows, and is still open
    view.add(make_log([]), 1, make_windows([("A", "2024-01-01 10:00:00", None), ("B", "2024-01-02 00:00:00", None)]))
    assert status() == {
        "P1": ("Missing", "2024-01-01 10:00:00"),
        "P2": ("Missing", "2024-01-01 10:00:00"),
        "P3": ("Reserved", "2024-01-01 12:00:00"),
    }
    # closed now: what was known before it comes back with its end
    view.add(make_log([("E1", "P1", "A", "Blocked", "2024-01-01 13:00:00")]), 2, make_windows([("A", "2024-01-01 10:00:00", "2024-01-01 11:00:00")]))
    assert status()["P1"] == ("Blocked", "2024-01-01 13:00:00")
    assert status()["P2"] == ("Available", "2024-01-01 11:00:00")
    view.add(make_log([("E2", "P3", "B", "Charging", "2024-01-03 12:00:00")]), 3)
    assert status()["P3"] == ("Missing", "2024-01-02 00:00:00")
