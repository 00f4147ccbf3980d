import json
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portpulse import schema
from portpulse.functions import scale
from portpulse.functions.scale import own_folder, release, settle, shared_folder
from portpulse.operators import history
from portpulse.sources import readers, writers
from portpulse.sources.log_store import LogStore


def test_csv_with_declared_schema(spark, tmp_path):
    path = tmp_path / "centroids.csv"
    path.write_text("lga_code,lat,lon,lga_name\n1,-35.5,149.5,Town\n2,,,\"Far, away\"\n")
    rows = readers.read_csv(spark, str(path), schema.AREA_CENTROIDS).orderBy("lga_code").collect()
    assert rows[0].lat == -35.5 and rows[1].lga_name == "Far, away" and rows[1].lat is None


def test_missing_and_malformed_files_are_errors(spark, tmp_path):
    with pytest.raises(PySparkException):
        readers.read_csv(spark, str(tmp_path / "none.csv"), schema.REQUIRED_STATES).collect()
    bad = tmp_path / "bad.csv"
    bad.write_text("lga_code,lat,lon,lga_name\nx,y,z,Town\n")
    with pytest.raises(Exception, match="FAILFAST|FAILED_READ_FILE"):
        readers.read_csv(spark, str(bad), schema.AREA_CENTROIDS).collect()


def test_conform_names_what_is_missing(spark):
    df = spark.createDataFrame([("a",)], "evse_id string")
    with pytest.raises(ValueError, match="update_time"):
        schema.conform(df, schema.STATUS_LOG, "log")


def test_boundaries(spark, tmp_path):
    features = [
        {"type": "Feature", "properties": {"LGA_name": n, "code": i}, "geometry": {"type": "Point", "coordinates": [i, i]}}
        for i, n in enumerate(["a", "b", None])
    ]
    (tmp_path / "one.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(f) for f in features))
    properties = T.StructType([T.StructField("LGA_name", T.StringType()), T.StructField("code", T.IntegerType())])
    for read, name in ((readers.read_boundaries, "one.json"), (readers.read_boundary_lines, "lines.json")):
        rows = read(spark, str(tmp_path / name), "LGA_name", properties).orderBy("code").collect()
        assert [(r.LGA_name, r.code) for r in rows] == [("a", 0), ("b", 1)]
        assert json.loads(rows[1].geometry)["coordinates"] == [1, 1]


def test_a_period_replaces_itself_only_and_reads_are_pruned(spark, tmp_path):
    path = str(tmp_path / "fact")

    def fact(rows):
        return spark.createDataFrame(
            [(s, "E", datetime.fromisoformat(t), v) for s, t, v in rows],
            "state string, evse_id string, update_time timestamp_ntz, status_duration bigint",
        )

    # Periods begin 11 hours before their month does in UTC.
    april = [("NSW", "2024-04-30 12:30:00", 1), ("WA", "2024-04-01 00:00:00", 2)]
    may = [("NSW", "2024-04-30 13:00:00", 3), ("NSW", "2024-05-31 12:30:00", 4)]
    june = [("NSW", "2024-05-31 13:00:00", 5), ("WA", "2024-05-31 15:30:00", 6)]
    for start, rows in (("2024-04-01", april), ("2024-05-01", may), ("2024-06-01", june)):
        writers.write_fact(fact(rows), path, start)

    def values(state, start, end):
        got = readers.read_fact(spark, path, state, start, end).collect()
        return sorted(r.status_duration for r in got)

    assert values("NSW", "2024-04-01", "2024-06-30") == [1, 3, 4, 5]
    assert values(None, "2024-04-01", "2024-06-30") == [1, 2, 3, 4, 5, 6]
    # Local May: from its first hours (in April by UTC) to its last (in June's period).
    assert values("NSW", "2024-05-01", "2024-05-15") == [3, 4]
    assert values("WA", "2024-05-02", "2024-05-31 23:30:00") == [6]
    writers.write_fact(fact([("NSW", "2024-05-10 00:00:00", 40)]), path, "2024-05-01")
    assert values("NSW", "2024-04-01", "2024-06-30") == [1, 5, 40]
    got = readers.read_fact(spark, path, "NSW", "2024-05-01", "2024-05-20")
    assert got.collect()[0].month == 5
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(state" in plan


def test_a_state_that_is_gone_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "fact")

    def write(states, start):
        rows = [(s, i) for i, s in enumerate(states)]
        writers.write_fact(spark.createDataFrame(rows, "state string, v int"), path, start)
        return {(r.state, r.year, r.month) for r in spark.read.parquet(path).collect()}

    write(["NSW", "VIC", None, "A/B=C d"], "2024-05-01")
    both = write(["VIC"], "2024-06-01")
    assert both == {(s, 2024, 5) for s in ("NSW", "VIC", None, "A/B=C d")} | {("VIC", 2024, 6)}
    assert write(["NSW", "A/B=C d"], "2024-05-01") == {("NSW", 2024, 5), ("A/B=C d", 2024, 5), ("VIC", 2024, 6)}
    assert write([], "2024-05-01") == {("VIC", 2024, 6)}


def test_log_store_reads_one_snapshot_and_its_own_days(spark, make_log, tmp_path):
    store = LogStore(spark, str(tmp_path))
    lo, hi = datetime(2024, 3, 1, 13), datetime(2024, 3, 31, 13)
    rows = [
        ("E1", "P1", "A", "Available", "2024-01-05 10:00:00"),  # long before
        ("E1", "P1", "A", "Charging", "2024-03-04 10:00:00"),
        ("E1", "P2", "A", "Charging", "2024-02-20 10:00:00"),
        ("E1", "P2", "A", None, "2024-03-01 12:59:59.5"),  # the last row, and one before it with a status
        ("E1", "P2", "A", "Reserved", "2024-03-01 13:00:00"),
        ("E1", "P2", "A", "Finishing", "2024-03-01 13:00:00"),  # two rows at one moment
        ("E1", "P2", "A", "Available", "2024-03-05 00:00:00"),
        ("E2", "P3", "B", "Available", "2024-03-09 00:00:00"),  # first seen inside
        ("E2", "P3", "B", "Charging", "2024-03-10 00:00:00"),
        ("E2", "P4", "B", "Charging", "2024-04-10 00:00:00"),
    ]
    store.add(make_log(rows), 0)
    assert store.between(lo, hi).count() == 9  # no snapshot yet
    for at in ("2024-02-01 13:00:00", lo):
        store.snapshot(at)
    late = [("E1", "P1", "A", "Blocked", "2024-02-10 10:00:00"), ("E2", "P4", "B", "Unknown", "2024-01-20 00:00:00")]

    def agree(log, at=lo):
        got = sorted(map(tuple, history.history_window(store.between(at, hi), at, hi).collect()), key=str)
        assert got == sorted(map(tuple, history.history_window(make_log(log), at, hi).collect()), key=str)
        return got

    assert len(agree(rows)) == 7
    store.add(make_log(late), 1)  # before both snapshots
    assert ("E1", "P1", "A", "Blocked", datetime(2024, 2, 10, 10)) in agree(rows + late)
    store.add(make_log(late), 1)
    agree(rows + late)
    agree(rows + late, datetime(2024, 3, 3))  # from a snapshot before it and some days
    store.add(make_log(late[1:]), 1)  # the load again, without a row that is in snapshots
    assert ("E1", "P1", "A", "Available", datetime(2024, 1, 5, 10)) in agree(rows + late[1:])
    plan = store.between(lo, hi)._jdf.queryExecution().executedPlan().toString()
    assert "(day" in plan and ">= 2024-03-01)" in plan and "<= 2024-03-31)" in plan
    read = store.between(lo, hi).select(F.input_file_name().alias("f")).distinct().collect()
    assert not any("day=2024-01" in r.f or "day=2024-02" in r.f or "day=2024-04" in r.f for r in read)


def test_settled_tables_live_in_the_shared_folder(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), None)], "t timestamp_ntz, s string")
    again = settle(df)
    assert again.schema == df.schema and again.collect() == df.collect()
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert all(f.startswith(f"file://{shared_folder(spark)}") for f in again.inputFiles())


def test_an_unset_folder_is_an_error_and_settled_tables_can_be_released(
    spark, tmp_path, monkeypatch
):
    for master in ("local-cluster[3,2,1000]", "spark://host:7077", "yarn", "k8s://host"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            own_folder(master)
    monkeypatch.setattr(scale, "shared_folder", lambda _: str(tmp_path))
    settle(spark.range(3)), settle(spark.range(5))
    assert len(list(tmp_path.rglob("_SUCCESS"))) == 2
    release(spark)
    assert list(tmp_path.iterdir()) == []


def test_a_fact_is_written_by_the_tasks_that_hold_it(spark, tmp_path):
    """Neither shuffled nor sorted: as many files of a state as there are tasks."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    rows = spark.range(60, numPartitions=3).selectExpr("id", "if(id % 2 = 0, 'NSW', 'VIC') AS state")
    for some in (rows, rows.where("state = 'VIC'")):
        writers.write_fact(some, str(tmp_path / "fact"), "2024-01-02")
        stored = spark.read.parquet(str(tmp_path / "fact"))
        assert stored.select("id", "state").exceptAll(some).count() == 0
        assert stored.count() == some.count()
        assert len(list((tmp_path / "fact" / "state=VIC").rglob("*.parquet"))) == 3
    assert not (tmp_path / "fact" / "state=NSW" / "year=2024" / "month=1").exists()
    assert spark.conf.get(name) == before
