import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    """A session in a zone that is not UTC: no result may depend on it."""
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


@pytest.fixture(scope="session")
def make_log(spark):
    def make(rows):
        """Rows of (evse, port, cpo, status, time text)."""
        return spark.createDataFrame(
            [(e, p, c, s, at(t)) for e, p, c, s, t in rows],
            "evse_id string, evse_port_id string, cpo_name string, status string, "
            "update_time timestamp_ntz",
        )

    return make


@pytest.fixture(scope="session")
def make_windows(spark):
    def make(rows):
        return spark.createDataFrame(
            [(c, at(a), at(b) if b else None) for c, a, b in rows],
            "cpo_name string, offline_timestamp timestamp_ntz, online_timestamp timestamp_ntz",
        )

    return make
