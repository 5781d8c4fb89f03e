from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("bikeflow-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is None, str(type(v)), v) for v in t])

    return collect


@pytest.fixture
def status_rows(spark):
    """A status frame from ``(status_id, station_key, second, bikes)`` tuples."""

    def make(data, docks=None):
        frame = spark.createDataFrame(data, "status_id bigint, station_key bigint, second bigint, num_bikes_available int")
        return frame.selectExpr(
            "status_id", "station_key", "timestamp_seconds(1704067200 + second) as polled_at",
            "num_bikes_available", "30 - num_bikes_available as num_docks_available",
            "cast(num_bikes_available / 3 as int) as num_ebikes_available",
        )

    return make


@pytest.fixture
def station_rows(spark):
    """A station frame from ``(station_key, lon, lat[, capacity])`` tuples."""

    def make(data):
        full = [(r[0], f"S{r[0]}", f"Station {r[0]}", r[1], r[2], r[3] if len(r) > 3 else 10) for r in data]
        return spark.createDataFrame(
            full, "station_key bigint, station_id string, name string, lon double, lat double, capacity int"
        )

    return make
