"""Tables laid out by place: the same rows, fewer files."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from bikeflow.operators import proximity
from bikeflow.plans.tiles import CURVE_BITS, curve, curve_of_cell
from bikeflow.sources import places


@pytest.fixture(scope="module")
def world(spark):
    r = random.Random(6)
    rows = [(i, r.uniform(-180, 180), r.uniform(-90, 90)) for i in range(150)]
    rows += [(2000 + i, -74 + r.gauss(0, 0.06), 40.7 + r.gauss(0, 0.06)) for i in range(900)]
    rows += [(4000 + i, (179.9 + r.random() * 0.2 + 180) % 360 - 180, r.uniform(-1, 1)) for i in range(60)] + [(5000, None, 1.0), (5001, 3.0, None)]
    df = spark.createDataFrame(rows, "station_key bigint, lon double, lat double")
    return df.withColumn("name", F.lit("n")).withColumn("capacity", F.lit(1))


@pytest.fixture(scope="module")
def placed(world, tmp_path_factory):
    path = tmp_path_factory.mktemp("places") / "placed"
    places.write_by_place(world, str(path))
    return path


def test_cells_are_prefixes_of_places(spark, world):
    place = curve(F.col("lon"), F.col("lat"), -180.0, -90.0, 360.0)
    top = (1 << CURVE_BITS) - 1
    for lon, lat, code in world.dropna().select("lon", "lat", place).limit(300).collect():
        i, j = int((lon + 180) / 360 * top), int((lat + 90) / 360 * top)
        for bits in (1, 5, 13, CURVE_BITS):
            assert code >> 2 * (CURVE_BITS - bits) == curve_of_cell(i >> (CURVE_BITS - bits), j >> (CURVE_BITS - bits), bits)


@pytest.mark.parametrize(
    ("lon", "lat", "metres"),
    [(-74.0, 40.7, 5000), (-74.0, 40.7, 200), (180.0, 0.0, 9000), (-179.95, 0.5, 30000), (10.0, 89.9, 80000), (0.0, 0.0, 3e6), (5.0, 5.0, 2.1e7)],
)
def test_radius_over_placed_rows_equals_the_scan(spark, world, placed, rows, lon, lat, metres):
    # The plain filter does not cross the date line, so distances decide here.
    want = rows(world.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull()).filter(
        proximity.distance_m(F.lit(lon), F.lit(lat), F.col("lon"), F.col("lat")) <= metres), "station_key")
    got = places.near(spark, str(placed), lon, lat, metres)
    kept = rows(got.filter(proximity.distance_m(F.lit(lon), F.lit(lat), F.col("lon"), F.col("lat")) <= metres), "station_key")
    assert kept == want and "_place" not in got.columns


def test_a_small_radius_opens_few_files(spark, placed):
    files = len(list(placed.glob("_folder=*/*.parquet")))
    near = places.near(spark, str(placed), -74.0, 40.7, 2000)
    opened = near.select(F.col("_metadata.file_path")).distinct().count()
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_folder" in plan.split("PartitionFilters: [")[1][:200] and "_place" in plan.split("PushedFilters: [")[1][:400]
    assert files > 150 and 1 <= opened <= 6
    assert len(places.curve_ranges(-74.0, 40.7, 0.02, 0.02)) <= places.CELLS


def test_facts_by_place_and_an_empty_table(spark, world, placed, rows, tmp_path):
    facts = world.select("station_key", (F.col("station_key") % 7).cast("int").alias("num_bikes_available")).union(
        spark.createDataFrame([(99999, 3)], "station_key bigint, num_bikes_available int"))
    st, ft, none = str(placed), str(tmp_path / "f"), str(tmp_path / "e")
    places.write_facts_by_place(facts, world, ft)
    assert spark.read.parquet(ft).count() == facts.count()
    want = rows(proximity.radius_agg(facts, world, -74.0, 40.7, 8000))
    assert rows(places.radius_agg(spark, ft, st, -74.0, 40.7, 8000)) == want and want[0][0] > 5
    places.write_by_place(world.limit(0), none)
    assert places.near(spark, none, 0.0, 0.0, 5.0, schema="station_key bigint, lon double, lat double").count() == 0
