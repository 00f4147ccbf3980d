from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from portpulse.functions.scale import numbered_within
from portpulse.operators import report, sessions
from portpulse.schema import STATUSES, TOTAL

FACT = (
    "cpo_name string, address string, suburb string, postcode int, evse_id string, evse_port_id string, "
    "power double, government_funded string, interval timestamp_ntz, Charging bigint"
)


def row(time, seconds, port="P", cpo="A", power=30.0, funded="Grant 1", address="x"):
    return (cpo, address, "S", 2000, "E", port, power, funded, datetime.fromisoformat(f"2024-05-01 {time}"), seconds)


def test_gap_of_half_an_hour_continues_a_session(spark):
    df = spark.createDataFrame(
        [
            row("00:00:00", 1800), row("00:30:00", 900), row("01:30:00", 600), row("02:00:00", 0),
            row("02:00:00", 60, port="Q"), row("03:00:00", 60, power=None),
            row("00:00:00", 60, funded="not_funded"),
        ],
        FACT,
    )
    rows = sessions.charging_sessions(df).orderBy("evse_port_id", "session").collect()
    assert [(r.evse_port_id, r.session, r.session_start_interval.hour, r.charge_duration) for r in rows] == [
        ("P", 0, 0, 2700), ("P", 1, 1, 600), ("Q", 0, 2, 60),
    ]


def test_labels_energy_and_minutes(spark):
    df = spark.createDataFrame(
        [row("00:00:00", 300), row("00:00:00", 100, port="Q", cpo="B"), row("00:00:00", 60, cpo="C", address="y"),
         row("00:00:00", 60, cpo="C", address="x")],
        FACT,
    )
    table = sessions.session_table(sessions.charging_sessions(df), {"A": False, "C": True})
    got = {(r.cpo_name, r.location): r for r in table.collect()}
    first = got[("A", "x, S, 2000")]
    # 30 kW for 300 s is 2.5 kWh, which rounds to the even 2.
    assert (first.max_usage_kwh, first.charge_duration_min) == (2.0, 5.0)
    assert (first.charge_station, first.connector, first.date) == ("station 1", "Port 1", "2024-05-01")
    assert got[("B", "x, S, 2000")].charge_station is None
    assert {k for k in got if k[0].startswith("CPO")} == {("CPO 1", "Location 1"), ("CPO 1", "Location 2")}


def test_numbering_equals_dense_rank_on_a_hot_group(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        F.lpad(((F.col("id") * 7919) % 1500).cast("string"), 5, "0").alias("k"),
    )
    got = numbered_within(df, ["g"], "k", "n")
    want = df.distinct().withColumn("n", F.dense_rank().over(Window.partitionBy("g").orderBy("k")).cast("bigint"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def sites(spark, rows):
    fields = ", ".join(f"`{s}` bigint" for s in [*STATUSES, TOTAL])
    return spark.createDataFrame(
        [(c, a, datetime(2024, 5, d), n, *[v.get(s, 0) for s in STATUSES], t) for c, a, d, n, v, t in rows],
        f"cpo_name string, lga_name string, interval timestamp_ntz, evse_port_site_count bigint, {fields}",
    )


def test_snapshot_has_an_overall_row(spark):
    df = sites(
        spark,
        [
            ("A", "x", 1, 2, {"Charging": 50, "Missing": 50}, 100),
            ("A", "x", 2, 3, {"Charging": 100}, 100),
            ("B", "x", 2, 1, {"Unavailable": 100}, 100),
            ("B", "y", 1, 9, {"Missing": 100}, 100),
            ("C", "y", 2, 4, {"Missing": 100}, 100),
        ],
    )
    rows = {(r.lga_name, r.cpo_name): r for r in report.snapshot(df, ["lga_name", "cpo_name"]).collect()}
    assert set(rows) == {("x", "A"), ("x", "B"), ("x", "Overall"), ("y", "C"), ("y", "Overall")}
    a = rows[("x", "A")]
    assert (a.value, a.evse_port_site_count) == (3, 5)
    assert a.Utilisation_prop == 1.0 and a.Charging_prop == 0.75 and a.Missing_prop == 0.25
    overall = rows[("x", "Overall")]
    assert overall.value == 4 and overall.Unavailability_prop == pytest.approx(100 / 250)
    assert rows[("y", "C")].Utilisation_prop is None
    assert rows[("y", "Overall")].value == 4


def test_extremes_break_ties_by_name_and_skip_null(spark):
    df = spark.createDataFrame(
        [("B", 2, 0.5), ("A", 1, 0.5), ("C", 3, 0.1), ("D", 3, None), ("E", 3, 0.1)],
        "cpo_name string, value bigint, share_prop double",
    )
    rows = report.extremes(df, ["share_prop"]).collect()
    assert [(r.which, r.share, r.cpo_name) for r in rows] == [("max", 0.5, "A"), ("min", 0.1, "C")]


def test_distribution_needs_five_areas(spark):
    df = spark.createDataFrame(
        [("A", f"l{i}", i / 10) for i in range(5)] + [("B", "l0", 0.2), ("Overall", "l0", 0.9)],
        "cpo_name string, lga_name string, Utilisation_prop double",
    )
    rows = {r.cpo_name: r for r in report.area_distribution(df, "Utilisation_prop").collect()}
    assert set(rows) == {"A", "B"}
    assert rows["A"].shown_as_box and not rows["B"].shown_as_box
    assert (rows["A"].q1, rows["A"].median, rows["A"].q3) == (10.0, 20.0, 30.0)
