"""Tables that are kept up to date period by period or load by load."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from portpulse.operators import durations, metrics, report, sessions
from portpulse.operators.privacy import LabelStore
from portpulse.plans import catalog
from portpulse.plans.count_store import CountStore
from portpulse.plans.level_store import LevelStore
from portpulse.plans.monthly import Period
from portpulse.schema import STATUSES, TOTAL
from portpulse.sources import writers

MAY, JUNE = Period("2024-05-01", "2024-05-31"), Period("2024-06-01", "2024-06-30")


@pytest.fixture
def make_fact(spark):
    def make(rows):
        """Fact rows of (state, area, operator, charger, port, UTC time, seconds charging)."""
        fixed = [
            (s, a, c, f"{e} street", "Town", 2000, e, p, datetime.fromisoformat(t), v, 1.0, 2.0, 22.0, "not_funded")
            for s, a, c, e, p, t, v in rows
        ]
        df = spark.createDataFrame(
            fixed,
            "state string, lga_name string, cpo_name string, address string, suburb string, postcode int, evse_id string, "
            "evse_port_id string, update_time timestamp_ntz, v long, latitude double, longitude double, power double, "
            "government_funded string",
        )
        zero = F.lit(0).cast("long")
        columns = {s: zero for s in STATUSES} | {"Charging": F.col("v"), "Available": 1800 - F.col("v"), TOTAL: zero + 1800}
        return df.withColumns(columns).drop("v")

    return make


MAY_ROWS = [
    ("NSW", "X", "A", "E1", "P1", "2024-05-03 00:00:00", 600),
    ("NSW", "X", "A", "E1", "P2", "2024-05-03 00:00:00", 0),
    ("NSW", "X", "B", "E2", "P3", "2024-05-04 00:00:00", 60),
    ("VIC", "Y", "B", "E3", "P4", "2024-05-04 00:00:00", 900),  # alone in its area
]
JUNE_ROWS = [
    ("NSW", "X", "A", "E1", "P1", "2024-05-31 14:00:00", 300),  # local June
    ("VIC", "Y", "A", "E4", "P5", "2024-06-20 00:00:00", 30),
]


def test_a_period_stored_again_takes_its_old_share_out(spark, make_fact, tmp_path):
    store = LevelStore(spark, str(tmp_path))

    def level(start, end, state=None):
        rows = store.load(start, end, state).collect()
        return {(r.evse_id, str(r.interval)[:10], r.Charging, r.evse_port_count) for r in rows}

    store.replace(make_fact(MAY_ROWS), MAY)
    x_may = {("E1", "2024-05-03", 600, 2), ("E2", "2024-05-04", 60, 1)}
    assert level("2024-05-01", "2024-06-30") == x_may  # Y would reveal B
    store.replace(make_fact(JUNE_ROWS), JUNE)
    y_both = {("E3", "2024-05-04", 900, 1), ("E4", "2024-06-20", 30, 1)}
    june = {("E1", "2024-06-01", 300, 1)}
    assert level("2024-05-01", "2024-06-30") == x_may | june | y_both
    assert level("2024-05-01", "2024-05-31") == x_may
    files = {f: f.stat().st_mtime_ns for f in tmp_path.rglob("*month=5*/*.parquet")}
    store.replace(make_fact(JUNE_ROWS[:1]), JUNE)
    assert level("2024-05-01", "2024-06-30") == x_may | june  # VIC left nothing, and Y is hidden again
    assert files and files == {f: f.stat().st_mtime_ns for f in tmp_path.rglob("*month=5*/*.parquet")}


def test_distinct_counts_of_any_days_and_areas(spark, make_fact, tmp_path):
    store = CountStore(spark, str(tmp_path))
    moved = [("VIC", "Z", "A", "E1", "P1", "2024-06-21 00:00:00", 1)]  # a port in another area
    store.replace(make_fact(MAY_ROWS), MAY)
    for _ in range(2):
        store.replace(make_fact(JUNE_ROWS + moved), JUNE)

    def counts(*args, **kwargs):
        return sorted(tuple(r) for r in store.counts(*args, **kwargs).collect())

    assert counts("2024-05-01", "2024-06-30") == [(5, 2)]
    assert counts("2024-06-01", "2024-06-30") == [(2, 1)]
    assert counts("2024-05-04", "2024-05-04") == [(2, 1)]
    assert counts("2024-05-01", "2024-06-30", by=["lga_name"]) == [("X", 3, 2), ("Y", 2, 2), ("Z", 1, 1)]
    assert counts("2024-05-01", "2024-06-30", where=F.col("lga_name").isin("X", "Z")) == [(3, 2)]
    assert counts("2024-05-01", "2024-06-30", state="VIC") == [(3, 2)]
    store.replace(make_fact(JUNE_ROWS[:1]), JUNE)
    assert counts("2024-05-01", "2024-06-30") == [(4, 2)]


def test_labels_stay_when_ports_are_added(spark, tmp_path):
    def numbers(load, ports):
        rows = spark.createDataFrame(ports, "cpo_name string, evse_id string")
        found = LabelStore(spark, str(tmp_path), load).numbers(rows, ["cpo_name"], "evse_id", "_no")
        return {(r.cpo_name, r.evse_id): r._no for r in found.collect()}

    first = numbers(0, [("A", "m"), ("A", "x"), ("A", "m"), ("B", "k")])
    assert first == {("A", "m"): 1, ("A", "x"): 2, ("B", "k"): 1}
    second = numbers(1, [("A", "a"), ("A", "m"), ("B", "z"), ("B", "b"), ("C", "c")])
    assert second == first | {("A", "a"): 3, ("B", "b"): 2, ("B", "z"): 3, ("C", "c"): 1}
    assert numbers(1, [("A", "a"), ("A", "m")]) == first | {("A", "a"): 3}  # the load again, with less
    assert numbers(2, []) == first | {("A", "a"): 3}


def charging(rows):
    """Half hours of one port as charging rows."""
    return [("A", "place", "E1", p, 22.0, "Grant", datetime.fromisoformat(t), v) for p, t, v in rows]


CHARGING = (
    "cpo_name string, location string, evse_id string, evse_port_id string, power double, "
    "government_funded string, interval timestamp_ntz, value long"
)
HOURS = [
    ("P1", "2024-05-31 23:00:00", 100),
    ("P1", "2024-05-31 23:30:00", 200),
    ("P1", "2024-06-01 00:00:00", 300),  # goes on across the border
    ("P1", "2024-06-01 01:00:00", 400),
    ("P2", "2024-05-31 23:30:00", 10),
    ("P2", "2024-06-01 00:30:00", 20),  # a new one
]


def test_sessions_across_a_period_border(spark, make_fact, tmp_path):
    fact = make_fact([("NSW", "X", "A", "E1", p, t, v) for p, t, v in HOURS])
    fact = metrics.dashboard_names(fact).withColumn("government_funded", F.lit("Grant"))
    border = F.col("interval") < F.lit("2024-06-01").cast("timestamp_ntz")
    path = str(tmp_path)
    for part, start in ((border, "2024-05-01"), (~border, "2024-06-01"), (~border, "2024-06-01")):
        sessions.store_period(fact.where(part), path, start)
    got = sessions.stored_sessions(spark, path, "2024-05-01", "2024-06-30")
    want = sessions.charging_sessions(fact)
    columns = sorted(want.columns)
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))
    assert sorted(r.charge_duration for r in got.collect()) == [10, 20, 400, 600]


def test_streamed_sessions_are_given_out_once_they_are_over(spark, tmp_path):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        source, out = str(tmp_path / "in"), str(tmp_path / "out")
        batches = [HOURS[:2] + HOURS[4:5], HOURS[2:4] + HOURS[5:], [("P9", "2024-06-05 00:00:00", 1)]]
        rows = spark.readStream.schema(CHARGING).parquet(source + "/*")

        def run():
            writer = sessions.streamed_sessions(rows, "2 hours").writeStream.outputMode("append").format("parquet")
            writer.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(out).awaitTermination()
            found = spark.read.parquet(out).collect()
            return sorted((r.evse_port_id, r.session_start_interval, r.charge_duration) for r in found)

        for k, b in enumerate(batches):
            spark.createDataFrame(charging(b), CHARGING).write.parquet(f"{source}/{k}")
            got = run()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    start = datetime(2024, 5, 31, 23)
    hour = timedelta(hours=1)
    assert got == [("P1", start, 600), ("P1", start + 2 * hour, 400), ("P2", start + hour / 2, 10), ("P2", start + 1.5 * hour, 20)]


def test_what_is_stored_and_summed_stays_runs(spark, monkeypatch):
    """The fact table, the charger level and the residual of the catalogue hold no row per half hour."""
    seen = {}

    def noted(owner, name, of):
        called = getattr(owner, name)

        def note(*args, **kwargs):
            seen.setdefault(name, []).append(durations.is_runs(args[of]))
            return called(*args, **kwargs)

        monkeypatch.setattr(owner, name, note)

    noted(writers, "write_fact", 0)
    noted(LevelStore, "replace", 1)
    noted(metrics, "rollup", 0)
    noted(durations, "fill_residual", 0)
    noted(report, "snapshot", 0)
    for name in ("fact_two_periods", "rollup_after_rerun", "residual_unknown_total", "area_distribution"):
        catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert set(seen) == {"write_fact", "replace", "rollup", "fill_residual", "snapshot"}
    assert all(all(found) for found in seen.values())


def test_level_store_takes_runs_and_half_hours(spark, make_fact, tmp_path):
    halves = make_fact(MAY_ROWS)
    stores = [LevelStore(spark, str(tmp_path / name)) for name in ("halves", "runs")]
    stores[0].replace(halves, MAY)
    stores[1].replace(durations.runs_of_half_hours(halves), MAY)
    got = [sorted(map(str, s.load("2024-05-01", "2024-05-31").collect())) for s in stores]
    assert got[0] == got[1] and len(got[0]) == 2
    runs = stores[0].load_runs("2024-05-01", "2024-05-31")
    assert durations.is_runs(runs) and runs.agg(F.sum("evse_port_count")).first()[0] == 3
