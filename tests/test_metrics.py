import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from portpulse.functions.clock import local_time, local_time_between
from portpulse.operators import metrics, privacy, report, stats
from portpulse.plans import monthly
from portpulse.schema import EVSE_KEYS, STATUSES, TOTAL


def evse(spark, rows):
    """Rows of (cpo, interval, port count, {status: seconds}, total)."""
    fields = ", ".join(f"`{s}` bigint" for s in [*STATUSES, TOTAL])
    return spark.createDataFrame(
        [
            (c, datetime.fromisoformat(t), n, *[v.get(s, 0) for s in STATUSES], total)
            for c, t, n, v, total in rows
        ],
        f"cpo_name string, interval timestamp_ntz, evse_port_count bigint, {fields}",
    )


def test_local_time_over_daylight_saving(spark):
    times = [datetime(2024, 4, 6, 14) + timedelta(minutes=30 * i) for i in range(8)]
    times += [datetime(2024, 10, 5, 14) + timedelta(minutes=30 * i) for i in range(8)]
    states = ["NSW", "QLD", "SA", "XX"]
    df = spark.createDataFrame([(t, s) for t in times for s in states], "t timestamp_ntz, s string")
    slow = local_time(F.col("t"), F.col("s"))
    fast = local_time_between(F.col("t"), F.col("s"), "2024-04-01", "2024-10-31")
    rows = df.select("t", "s", slow.alias("slow"), fast.alias("fast")).collect()
    assert all(r.slow == r.fast for r in rows)
    got = {(r.t, r.s): r.slow for r in rows}
    assert got[(datetime(2024, 4, 6, 15, 30), "NSW")] == datetime(2024, 4, 7, 2, 30)
    assert got[(datetime(2024, 4, 6, 16, 0), "NSW")] == datetime(2024, 4, 7, 2, 0)
    assert got[(datetime(2024, 10, 5, 16, 0), "NSW")] == datetime(2024, 10, 6, 3, 0)
    assert got[(datetime(2024, 4, 6, 15, 30), "QLD")] == datetime(2024, 4, 7, 1, 30)
    assert got[(datetime(2024, 4, 6, 15, 30), "XX")] == datetime(2024, 4, 6, 15, 30)


def test_weeks_start_on_the_groups_first_day(spark):
    df = evse(
        spark,
        [
            ("A", "2024-05-01 05:00:00", 1, {"Charging": 900}, 1800),
            ("A", "2024-05-22 05:00:00", 1, {"Charging": 1800}, 1800),
            ("B", "2024-05-03 05:00:00", 1, {"Available": 1800}, 1800),
        ],
    )
    rows = metrics.rollup(df, ["cpo_name"], "10080min").orderBy("cpo_name", "interval").collect()
    assert [(r.cpo_name, r.interval.day, r.Charging) for r in rows] == [
        ("A", 1, 50.0),
        ("A", 8, None),
        ("A", 15, None),
        ("A", 22, 100.0),
        ("B", 3, 0.0),
    ]


@pytest.mark.parametrize(
    "interval, labels",
    [
        ("ME", [(2024, 12, 31), (2025, 1, 31), (2025, 2, 28)]),
        ("Q", [(2024, 12, 31), (2025, 3, 31)]),
        ("Y", [(2024, 12, 31), (2025, 12, 31)]),
    ],
)
def test_long_bins_carry_their_last_day(spark, interval, labels):
    df = evse(
        spark,
        [
            ("A", "2024-12-30 23:30:00", 1, {"Charging": 1800}, 1800),
            ("A", "2025-02-01 00:00:00", 1, {"Charging": 1800}, 1800),
        ],
    )
    rows = metrics.rollup(df, ["cpo_name"], interval).orderBy("interval").collect()
    assert [(r.interval.year, r.interval.month, r.interval.day) for r in rows] == labels
    span = metrics.months_spanned(df).first()
    assert (span.months, span.long_bins) == (2, False)


def test_rates_leave_out_unobserved_time_and_port_count_splits(spark):
    df = evse(
        spark,
        [
            ("A", "2024-05-01 00:00:00", 1, {"Charging": 600, "Missing": 600, "Unknown": 0}, 1800),
            ("A", "2024-05-01 00:30:00", 1, {"Missing": 1800}, 1800),
            ("A", "2024-05-01 01:00:00", 2, {"Available": 3600}, 3600),
        ],
    )
    rows = metrics.rollup(df, ["cpo_name"], "30min").orderBy("interval").collect()
    assert [r.evse_port_count for r in rows] == [1, 1, 2]
    assert rows[0].Utilisation == 50.0 and rows[0].Missing == pytest.approx(100 / 3)
    assert rows[1].Utilisation is None and rows[1].Missing == 100.0
    assert rows[2].Uptime == 100.0


def test_absent_cell_makes_the_metric_null(spark):
    df = evse(spark, [("A", "2024-05-01 00:00:00", 1, {"Charging": 900}, 1800)])
    df = df.withColumn("Reserved", F.lit(None).cast("bigint"))
    row = metrics.rollup(df, ["cpo_name"], "30min").first()
    assert row.Utilisation == 0.0 and row.Charging == 50.0
    present = [s for s in STATUSES if s != "Reserved"]
    row = metrics.rollup(df.drop("Reserved"), ["cpo_name"], "30min", present).first()
    assert row.Utilisation == 50.0


def test_date_range_is_inclusive(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 5, d, h),) for d in (1, 2, 3) for h in (0, 1)], "interval timestamp_ntz"
    )
    kept = metrics.between_dates(df, "2024-05-02", "2024-05-03").collect()
    assert sorted((r.interval.day, r.interval.hour) for r in kept) == [(2, 0), (2, 1), (3, 0)]


def test_statistics_weigh_missing_by_gap(spark):
    def rates(rows):
        return spark.createDataFrame(
            [(c, datetime.fromisoformat(t), 4, u, u, 100.0 - u, m) for c, t, u, m in rows],
            "cpo_name string, interval timestamp_ntz, evse_port_count bigint, Uptime double, "
            "Utilisation double, Unavailability double, Missing double",
        )

    df = rates(
        [
            ("A", "2024-05-01 00:00:00", 80.0, 10.0),
            ("A", "2024-05-01 01:00:00", 60.0, 20.0),
            ("A", "2024-05-01 03:00:00", 70.0, 50.0),
            ("B", "2024-02-29 00:00:00", 90.0, 7.0),
        ]
    )
    rows = {r.cpo_name: r for r in stats.cpo_statistics(df, "2024-05-01", "2024-05-08").collect()}
    assert rows["A"].average_uptime == 70.0 and rows["A"].minimum_uptime == 60.0
    assert rows["A"].total_observed_time == 180.0 and rows["A"].period_duration == 7
    assert rows["A"].missing_duration == pytest.approx((6 + 12 + 60) / 180 * 100)
    assert rows["B"].total_observed_time == 29 * 1440.0 and rows["B"].missing_duration == 7.0


def test_labels_count_null_rows_in_the_error(spark):
    df = spark.createDataFrame([("A", 1.0), ("A", 3.0), ("A", None), ("B", 2.0)], "g string, v double")
    rows = {r.g: r for r in stats.mean_se_labels(df, ["g"], ["v"]).collect()}
    assert rows["A"].v_label == "2.0 ± 0.82"
    assert rows["B"].v_label == "2.0 ± nan"


def test_areas_of_one_operator_are_hidden(spark):
    rows = [
        ("x", "A", "not_funded"), ("x", "B", "not_funded"),
        ("y", "A", "not_funded"), ("y", "B", "Grant 1"),
        ("z", "A", "not_funded"), (None, "A", "not_funded"), (None, "B", "not_funded"),
    ]
    df = spark.createDataFrame(rows, "lga_name string, cpo_name string, government_funded string")
    kept = privacy.hide_single_operator_areas(df)
    assert sorted((r.lga_name, r.cpo_name) for r in kept.collect()) == [("x", "A"), ("x", "B"), ("y", "B")]
    population = spark.createDataFrame([("x",), ("y",), ("z",), ("w",)], "lga_name string")
    row = privacy.coverage(df.na.drop(), kept, population).first()
    assert (row.reporting_areas, row.hidden_areas, row.reporting_ratio) == (2, 1, 2.0)
    assert row.coverage_ratio == 0.75
    assert privacy.coverage(kept, kept, population).first().reporting_ratio is None


def test_port_count_and_null_keys(spark):
    fields = ", ".join(f"`{s}` bigint" for s in [*STATUSES, TOTAL])
    values = [0] * (len(STATUSES)) + [1800]
    rows = [
        ("E1", p, datetime(2024, 5, 1), "A", a, "S", 2000, "L", 1.0, 2.0, 7.0, "not_funded", *values)
        for p, a in (("P1", "x"), ("P2", "x"), ("P2", "x"), ("P3", None))
    ]
    df = spark.createDataFrame(
        rows,
        "evse_id string, evse_port_id string, interval timestamp_ntz, cpo_name string, address string, "
        "suburb string, postcode int, lga_name string, latitude double, longitude double, power double, "
        f"government_funded string, {fields}",
    )
    row = metrics.evse_level(df).collect()
    assert len(row) == 1 and row[0].evse_port_count == 2 and row[0].Total == 3 * 1800


def test_tasks_that_count_ports_follow_the_rows(spark, monkeypatch):
    """Their number comes from the rows, not from the few bytes that these are."""
    keys = "'E' AS evse_id, concat('P', id % 3) AS evse_port_id, 'A' AS cpo_name, 'x' AS address, 's' AS suburb, 2000 AS postcode"
    rest = "'l' AS lga_name, 0.0D AS latitude, 0.0D AS longitude, 7.0D AS power, 'not_funded' AS government_funded, 'NSW' AS state"
    at = "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 30 * cast(id div 3 AS int)) AS interval"
    seconds = ", ".join(f"cast(100 AS bigint) AS `{s}`" for s in [*STATUSES, TOTAL])
    fact = spark.sql(f"SELECT {keys}, {rest}, {at}, {seconds} FROM range(300)")
    monkeypatch.setattr(metrics, "PORT_ROWS", 10)
    level = metrics.evse_level(fact)
    assert re.search(r"hashpartitioning\(.*, 30\)", level._jdf.queryExecution().executedPlan().toString())
    rows = level.collect()
    assert len(rows) == 100
    assert all(r[metrics.PORT_COUNT] == 3 and r.Charging == 300 for r in rows)


@pytest.fixture
def some_runs(spark):
    """Runs of ports that are listed twice, overlap, lack a key or a name, some over a change of the clocks."""
    rng, rows = random.Random(5), []
    begin = int((datetime(2024, 4, 4) - datetime(1970, 1, 1)).total_seconds())
    for i in range(240):
        port, site = rng.randrange(6), rng.randrange(2)
        first = rng.randrange(200)
        last = first + rng.choice([0, 0, 1, 5, 60, 150])
        rows.append(
            (
                rng.choice(["NSW", "QLD", "ZZ"]), "A", rng.choice(["x", "x", "x", None]), "S", 2000, rng.choice(["L", "M"]), 1.0, -0.0, 7.0,
                rng.choice(["not_funded", "grant"]), f"E{site}", rng.choice([f"P{port}"] * 4 + [None]),
                begin + first * 1800, begin + last * 1800, *[rng.randrange(1800) for _ in STATUSES], 1800,
            )
        )
    fields = ", ".join(f"`{s}` bigint" for s in [*STATUSES, TOTAL])
    return spark.createDataFrame(
        rows,
        "state string, cpo_name string, address string, suburb string, postcode int, lga_name string, latitude double, "
        f"longitude double, power double, government_funded string, evse_id string, evse_port_id string, _from bigint, _to bigint, {fields}",
    )


def lines(df):
    return df.columns, sorted(map(str, df.collect()))


def test_levels_of_runs_are_those_of_their_half_hours(some_runs, monkeypatch):
    monkeypatch.setattr(metrics, "PORT_ROWS", 3000)
    fact = metrics.dashboard_names(monthly.half_hourly(some_runs))
    assert lines(metrics.site_level(some_runs)) == lines(metrics.site_level(fact))
    assert lines(metrics.evse_level(some_runs)) == lines(metrics.evse_level(fact))
    assert report.latest_interval(some_runs) is not None
    latest = [df.limit(1).select(report.latest_interval(df).alias("t")).first().t for df in (some_runs, fact)]
    assert latest[0] == latest[1]
    # only runs are shuffled: one exchange, by site and day
    plan = metrics.site_level(some_runs)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan.split("Initial Plan")[0])) == 1


@pytest.mark.parametrize("bounds", [("2024-04-01", "2024-04-30"), ("2024-04-06 03:10:00", "2024-04-07 02:30:00"), ("2024-04-07", "2024-04-07")])
def test_local_runs_have_the_half_hours_of_local_time(some_runs, bounds):
    fact = metrics.dashboard_names(monthly.half_hourly(some_runs))
    local = metrics.local_between_dates(fact, *bounds)
    runs = metrics.local_runs(some_runs, *bounds)
    assert lines(metrics.dashboard_names(monthly.half_hourly(runs)).select(*local.columns)) == lines(local)
    assert lines(metrics.evse_level(runs, more_keys=["state"])) == lines(metrics.evse_level(local, more_keys=["state"]))


@pytest.mark.parametrize("interval", ["30min", "1440min", "10080min", "ME"])
def test_rollup_of_runs_is_that_of_their_half_hours(some_runs, interval):
    """Ports that come and go, absent cells and overlapping runs make days that have no one port count."""
    absent = F.when(F.pmod(F.hash("evse_port_id", "_from"), F.lit(5)) != 0, F.col("Charging"))
    for fact in (some_runs, some_runs.withColumn("Charging", absent)):
        runs, level = metrics.evse_runs(fact), metrics.evse_level(fact)
        for keys in (["cpo_name"], metrics.SITE_ROLLUP, []):
            assert lines(metrics.rollup(runs, keys, interval)) == lines(metrics.rollup(level, keys, interval))


def test_days_of_one_port_count_are_rolled_up_without_half_hours(some_runs):
    """A dense table: every port has all half hours."""
    day = 86_400 - 1800
    begin = int((datetime(2024, 4, 4) - datetime(1970, 1, 1)).total_seconds())
    dense = some_runs.where("evse_port_id IS NOT NULL").limit(20).withColumns({"_from": F.lit(begin).cast("bigint"), "_to": F.lit(begin + 3 * day).cast("bigint")})
    runs, level = metrics.evse_runs(dense), metrics.evse_level(dense)
    rolled = metrics.rollup(runs, ["cpo_name"], "1440min")
    assert lines(rolled) == lines(metrics.rollup(level, ["cpo_name"], "1440min"))
    # the days are stored, nothing is left to unroll
    assert "unionall" not in rolled._jdf.queryExecution().optimizedPlan().toString().lower().replace(" ", "")
    assert "left_semi" not in rolled._jdf.queryExecution().optimizedPlan().toString().lower().replace("leftsemi", "left_semi")


def test_snapshot_of_runs_is_that_of_their_half_hours(some_runs):
    runs, sites = metrics.site_runs(some_runs), metrics.site_level(some_runs)
    for groups in (["lga_name", "cpo_name"], ["cpo_name"], ["cpo_name", "lga_name", "government_funded"]):
        assert lines(report.snapshot(runs, groups)) == lines(report.snapshot(sites, groups))
    # seconds are summed where they are read: only ports are dealt, and groups
    plan = report.snapshot(runs, ["cpo_name"], F.lit("2024-04-05").cast("timestamp_ntz"))._jdf.queryExecution().executedPlan().toString()
    assert "_at" not in plan


def test_level_of_runs(some_runs):
    keys = [*EVSE_KEYS, "state"]
    got = metrics.level_of_runs(metrics.evse_runs(some_runs, more_keys=["state"]), keys, "evse_id", metrics.PORT_COUNT)
    assert lines(got) == lines(metrics.evse_level(some_runs, more_keys=["state"]).select(*got.columns))
