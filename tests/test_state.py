"""Latest rows, aggregates, dimension upkeep, feeds and quality checks."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from bikeflow.functions import clock, numbers
from bikeflow.functions.numbers import ratio
from bikeflow.operators import aggregates, dimension, latest, quality
from bikeflow.sources import archive, feeds, geojson


def test_latest_breaks_ties_and_keeps_nulls(spark, rows):
    df = spark.createDataFrame(
        [(1, 10, 1, "a"), (1, 10, 2, None), (2, 5, 3, "c")], "k int, t int, id int, v string"
    )
    assert rows(latest.latest_per(df, "k", "t", "id", ["v"])) == [(1, None), (2, "c")]


def test_station_without_status_shows_zero(status_rows, station_rows, rows):
    live = latest.station_map(status_rows([(1, 1, 0, 4)]), station_rows([(1, 1.0, 2.0), (2, 3.0, 4.0)]))
    assert rows(live, "station_key", "bikes") == [(1, 4), (2, 0)]


def test_empty_now_orders_null_capacity_last(status_rows, station_rows):
    st = station_rows([(1, -73.98761, 40.7, None), (2, -73.9, 40.75004, 5), (3, -73.0, 40.0, 9)])
    got = latest.empty_now(status_rows([(1, 1, 0, 0), (2, 2, 0, 0), (3, 3, 0, 0), (4, 3, 60, 2)]), st).collect()
    assert [r["name"] for r in got] == ["Station 2", "Station 1"]
    assert [r["point"] for r in got] == ["POINT(-73.9 40.75)", "POINT(-73.9876 40.7)"]


def test_same_named_stations_merge_and_ties_go_by_name(status_rows, spark):
    status = status_rows([(i, 1 + i % 3, i, 7) for i in range(30)])
    st = spark.createDataFrame([(1, "x"), (2, "x"), (3, "a")], "station_key bigint, name string")
    got = aggregates.busiest(status, st)
    assert [(r["name"], r["observations"]) for r in got.collect()] == [("a", 10), ("x", 20)]
    assert aggregates.busiest(status, st, n=1).first()["name"] == "a"


def test_ratio_rounds_half_away_and_survives_zero(spark):
    df = spark.createDataFrame([(1, 8), (-1, 8), (5, 0), (1, 3)], "a int, b int")
    got = [r[0] for r in df.select(numbers.ratio(F.col("a"), F.col("b"), 2)).collect()]
    assert got == [0.13, -0.13, None, 0.33]


def test_dry_bands(status_rows):
    data = []
    for key, dry in [(1, 0), (2, 1), (3, 5), (4, 20), (5, 60), (6, 100)]:
        data += [(key * 1000 + i, key, i, 0 if i < dry else 3) for i in range(100)]
    data += [(9, 9, 0, 0)]
    got = {r["bucket"]: r["stations"] for r in aggregates.dry_distribution(status_rows(data)).collect()}
    assert got == {"never": 1, "under 5%": 1, "5–20%": 1, "20–50%": 1, "50–99%": 1, "always": 1}


def test_spine_has_all_hours(status_rows):
    got = {r["hour"]: r["bikes"] for r in aggregates.fleet_hour_spine(status_rows([(1, 1, 0, 3), (2, 1, 5, 4)])).collect()}
    assert len(got) == 24 and got["00"] == 3.5 and got["23"] == 0.0


def test_ebike_share_of_nothing_is_null(status_rows):
    assert aggregates.ebike_share(status_rows([(1, 1, 0, 0)])).first()["pct_electric"] is None


def test_local_time_on_clock_change_days(spark):
    zone = "America/New_York"
    ts = ["2024-03-10 01:30:00", "2024-03-10 02:30:00", "2024-03-10 03:30:00", "2024-11-03 00:30:00",
          "2024-11-03 01:30:00", "2024-11-03 02:30:00"]
    df = spark.createDataFrame([(t,) for t in ts], "t string").select(F.col("t").cast("timestamp").alias("t"))
    got = [str(r[0]) for r in df.select(clock.local_to_utc(F.col("t"), zone).cast("timestamp_ntz")).collect()]
    assert got == ["2024-03-10 06:30:00", "2024-03-10 07:30:00", "2024-03-10 07:30:00", "2024-11-03 04:30:00",
                   "2024-11-03 06:30:00", "2024-11-03 07:30:00"]


def test_monday_is_one(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 7),)], "d date")
    assert [r[0] for r in days.select(clock.iso_weekday(F.col("d"))).collect()] == [1, 7]


def _docs(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "json string")


def test_absent_feed_fields_become_zero_or_empty(spark):
    doc = {"last_updated": 1704067200, "data": {"stations": [{"station_id": "a-1"}, {"num_bikes_available": 3}]}}
    got = feeds.parse_status(_docs(spark, json.dumps(doc))).collect()
    assert [(r["station_id"], r["num_bikes_available"], r["is_renting"]) for r in got] == [("a-1", 0, 0), ("", 3, 0)]
    assert str(got[0]["last_reported"].astimezone(dt.timezone.utc)).startswith("1970-01-01")
    st = feeds.parse_stations(_docs(spark, json.dumps({"data": {"stations": [{"station_id": "b"}]}}))).first()
    assert (st["name"], st["lat"], st["capacity"]) == ("", 0.0, 0)


def test_discovery_document_shapes(spark, rows):
    listed = [{"name": "station_status", "url": "u1"}]
    docs = _docs(
        spark,
        json.dumps({"data": {"en": {"feeds": listed}, "fr": {"feeds": [{"name": "station_status", "url": "u2"}]}}}),
        json.dumps({"data": {"feeds": [{"name": "station_status", "url": "u3"}, {"name": "other", "url": "u4"}]}}),
    )
    assert rows(feeds.feed_catalog(docs, "station_status"), "url") == [("u1",), ("u3",)]
    assert feeds.feed_catalog(docs).count() == 4


def test_newest_station_list_replaces_the_old(spark, rows, tmp_path):
    old = json.dumps({"last_updated": 1, "data": {"stations": [{"station_id": "gone"}, {"station_id": "a", "name": "x"}]}})
    new = json.dumps({"last_updated": 2, "data": {"stations": [{"station_id": "a", "name": "y"}]}})
    path = str(tmp_path / "stations")
    assert rows(archive.replace_stations(_docs(spark, old), path), "station_id") == [("a",), ("gone",)]
    assert rows(archive.replace_stations(_docs(spark, old, new), path), "station_id", "name") == [("a", "y")]


@pytest.fixture
def dim(spark):
    return spark.createDataFrame(
        [(1, "a", "A", "sa", 40.0, -73.0, 10, "r"), (2, "b", "B", "sb", 41.0, -74.0, None, "r")],
        "station_key bigint, station_id string, name string, short_name string, lat double, lon double, "
        "capacity int, region_id string",
    )


def test_upsert_changes_only_what_differs(spark, dim, rows):
    incoming = spark.createDataFrame(
        [("a", "A2", "zz", 40.0, -73.0, 10, "q"), ("b", "B", "zz", 41.0, -74.0, None, "q"),
         ("c", "C", "sc", 40.5, -73.5, 3, "q"), ("d", "D", "sd", 0.0, -73.5, 3, "q")],
        "station_id string, name string, short_name string, lat double, lon double, capacity int, region_id string",
    )
    got = dimension.upsert_stations(dim, incoming)
    assert rows(got, "station_key", "station_id", "name", "short_name", "_change") == [
        (1, "a", "A2", "sa", "update"), (2, "b", "B", "sb", "same"), (3, "c", "C", "sc", "insert"),
    ]
    # A second run changes nothing.
    again = dimension.upsert_stations(got.drop("_change"), incoming)
    assert {r["_change"] for r in again.collect()} == {"same"}
    # A moved point moves; a list that misses a station leaves it alone.
    moved = dimension.upsert_stations(dim, incoming.limit(1).withColumn("lon", F.lit(-73.1)))
    assert rows(moved, "station_id", "lon", "_change") == [("a", -73.1, "update"), ("b", -74.0, "same")]


def test_keys_are_kept_and_start_at_one(spark, dim, rows):
    incoming = spark.createDataFrame([("c",), ("a",), ("c",), ("b2",)], "station_id string")
    assert rows(dimension.assign_keys(dim, incoming)) == [("a", 1), ("b", 2), ("b2", 3), ("c", 4)]
    assert rows(dimension.assign_keys(dim.limit(0), incoming)) == [("a", 1), ("b2", 2), ("c", 3)]


def _landing(spark, data):
    full = [(s, i, s, b, 0, 0, 0, 0, 1, 1, 0) for s, i, b in data]
    df = spark.createDataFrame(
        full, "p long, station_id string, r long, num_bikes_available int, num_ebikes_available int, "
        "num_docks_available int, num_bikes_disabled int, num_docks_disabled int, is_installed int, "
        "is_renting int, is_returning int",
    )
    return df.selectExpr("timestamp_seconds(p) as polled_at", "station_id", "timestamp_seconds(r) as last_reported", *df.columns[3:])


def test_incremental_load_from_empty_and_from_a_mark(spark, dim):
    landing = _landing(spark, [(100, "a", 1), (200, "a", 2), (200, "new", 3)])
    none = landing.limit(0)
    first = dimension.incremental_load(none, landing, dim)
    assert first.count() == 2 and dict(first.dtypes)["is_returning"] == "boolean"
    assert [r["is_renting"] for r in first.collect()] == [True, True]
    rest = dimension.incremental_load(first.filter("polled_at <= timestamp_seconds(100)"), landing, dim)
    assert [r["num_bikes_available"] for r in rest.collect()] == [2]
    assert [r["station_id"] for r in dimension.unmatched_landing(none, landing, dim).collect()] == ["new"]


def test_cdc_latest_version_wins_and_deletes_hold(spark, rows):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    changes = spark.createDataFrame(
        [(1, "a2", 2, "U"), (1, "a1", 1, "U"), (2, "b", 5, "D"), (4, "d", 1, "I"), (3, None, 1, "U")],
        "k int, v string, ver long, op string",
    )
    assert rows(dimension.apply_cdc(base, changes, "k")) == [(1, "a2"), (3, None), (4, "d")]


def test_retention_keeps_the_edge(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2023-12-31 23:59:59",)], "t string").selectExpr("cast(t as timestamp) t")
    assert dimension.retain(df, "t", 30, "2024-01-31 00:00:00").count() == 1


def test_collapse_landing(spark):
    landing = _landing(spark, [(100, "a", 1), (100, "a", 1), (100, "b", 1), (160, "a", 1)])
    assert dimension.collapse_landing(landing).count() == 3
    row = dimension.landing_summary(landing).first()
    assert (row["status_rows"], row["snapshots"], row["stations"]) == (4, 2, 2)


def test_trip_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "started_at,ended_at,start_station_id,end_station_id,start_lat,start_lng,end_lat,end_lng,member_casual\n"
        "2024-01-01 10:00:00.123,2024-01-01 10:10:00,S1,,40.1,-73.9,,,member\n"
    )
    row = archive.read_trip_csv(spark, str(tmp_path)).first()
    assert (row["end_station_id"], row["end_lat"], row["start_lng"], row["member_casual"]) == (None, None, -73.9, "member")


def test_feature_collections(spark, station_rows):
    geometry = geojson.point_geometry(F.col("lon"), F.col("lat"))

    def collect(df, *by):
        out = geojson.to_feature_collection(df, geometry, ["name", "capacity"], ["station_key"], by).orderBy(*by or ["features"])
        return [json.loads(r["json"]) for r in out.collect()]

    st = station_rows([(k, 1.0 * k, 2.0, None if k == 2 else 5) for k in range(1, 6)])
    one = collect(st)
    assert len(one) == 1 and [f["properties"]["name"] for f in one[0]["features"]] == [f"Station {k}" for k in range(1, 6)]
    assert one[0]["features"][1] == {
        "type": "Feature", "geometry": {"type": "Point", "coordinates": [2.0, 2.0]},
        "properties": {"name": "Station 2", "capacity": None},
    }
    many = collect(st.withColumn("part", F.col("station_key") % 2), "part")
    assert [[f["properties"]["name"][-1] for f in d["features"]] for d in many] == [["2", "4"], ["1", "3", "5"]]
    assert collect(st.limit(0)) == [{"type": "FeatureCollection", "features": []}]
    lines = [json.loads(r["json"]) for r in geojson.to_features(st, geometry, ["name", "capacity"]).collect()]
    assert lines == one[0]["features"]


def test_a_collection_is_one_document_at_any_size(spark):
    rows = spark.range(10_001).selectExpr("id", "cast(id as double) as lon", "0D as lat")
    made = geojson.to_feature_collection(rows, geojson.point_geometry(F.col("lon"), F.col("lat")), ["id"], ["id"])
    document, = made.collect()
    assert document["features"] == 10_001
    assert [f["properties"]["id"] for f in json.loads(document["json"])["features"]] == list(range(10_001))


def test_a_written_collection_is_one_document_in_parts(spark, tmp_path):
    point = geojson.point_geometry(F.col("lon"), F.col("lat"))
    rows = spark.range(5000).selectExpr("id", "cast(4999 - id as int) as k", "'a\\n,]}' as name", "cast(id as double) as lon", "0D as lat")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    for n, df in ((10_000, rows.union(rows).repartition(3)), (0, rows.limit(0))):  # with equal features
        geojson.write_feature_collection(df, point, ["id", "name"], ["k"], str(tmp_path / str(n)))
        parts = [p.read_text() for p in sorted((tmp_path / str(n)).glob("part-*"))]
        got = json.loads("".join(parts))
        assert got["type"] == "FeatureCollection"
        assert [f["properties"]["id"] for f in got["features"]] == [4999 - i // 2 for i in range(n)]
        back = geojson.read_feature_collection(spark, str(tmp_path / str(n)))
        assert sorted(json.loads(r["json"])["properties"]["id"] for r in back.collect()) == sorted(4999 - i // 2 for i in range(n))
        assert n == 0 or len(parts) > 1
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_checks_go_on_after_a_failure(spark):
    good = spark.range(1).selectExpr("true as ok", "'fine' as detail")
    broken = spark.range(1).selectExpr("raise_error('boom') = 1 as ok", "'x' as detail")
    report = quality.run_checks(
        spark,
        [
            quality.Check("missing column", lambda: spark.range(1).select("nope"), "hint 1"),
            quality.Check("fails in the job", lambda: broken, "hint 2"),
            quality.Check("good", lambda: good, "hint 3"),
            quality.Check("empty", lambda: good.limit(0), "hint 4"),
        ],
    ).collect()
    assert [r["ok"] for r in report] == [False, False, True, False]
    assert report[2]["hint"] == "" and report[0]["hint"] == "hint 1" and report[3]["detail"] == "no result"


def test_quality_reports(spark, status_rows, station_rows, rows):
    status = status_rows([(1, 1, 0, 5), (2, 1, 0, 5), (3, 2, 60, 1), (4, 1, 241, 1)])
    assert rows(quality.duplicates(status, ["station_key", "polled_at"]), "copies") == [(2,)]
    assert rows(quality.orphans(status, station_rows([(1, 1.0, 1.0)]))) == [(2, 1)]
    assert rows(quality.poll_gaps(status, 180), "gap_seconds") == [(181.0,)]
    assert quality.freshness(status, "2024-01-01 00:09:00").first()["ok"] is True
    assert quality.freshness(status, "2024-01-01 00:09:01").first()["ok"] is False
    assert quality.freshness(status.limit(0), "2024-01-01 00:09:01").first()["ok"] is False


def test_reconcile_rows_counts_copies(spark, rows):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(1, None), (3, "y")], "k int, v string")
    assert rows(quality.reconcile_rows(a, b), "k", "side", "copies") == [(1, "only_a", 1), (2, "only_a", 1), (3, "only_b", 1)]
    assert quality.reconcile_rows(a, a).count() == 0


def test_equal_versions_do_not_depend_on_the_order_of_rows(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "station_key bigint, name string")
    changes = [(1, "z", 5, "U"), (1, "a", 5, "D"), (2, "x", 3, "U"), (2, "y", 3, "U")]
    for some in (changes, changes[::-1]):
        frame = spark.createDataFrame(some, "station_key bigint, name string, ver bigint, op string")
        assert [tuple(r) for r in dimension.apply_cdc(base, frame).collect()] == [(2, "y")]


ARCHIVE = "started_at,ride_id,ended_at,end_lat,start_station_id,end_station_id,start_lat,start_lng,end_lng,member_casual"


def test_trip_archive_is_read_by_name(spark, tmp_path, rows):
    line = "2024-01-01 08:00:00,r1,2024-01-01 08:05:30.250,40.5,S1,S2,40.7,-74.0,-73.9,member"
    for i in (1, 2):
        (tmp_path / f"{i}.csv").write_text(f"{ARCHIVE}\n{line}\n,r2,never,,,,,x,,casual\n")
    trips = archive.read_trip_csv(spark, str(tmp_path))
    whole = trips.filter("member_casual = 'member'")
    assert rows(whole, "start_station_id", "start_lat", "end_lat", "end_lng") == [("S1", 40.7, 40.5, -73.9)] * 2
    assert trips.count() == 4 and trips.filter("ended_at is null and start_lng is null").count() == 2


def test_trip_archive_without_a_column_raises(spark, tmp_path):
    (tmp_path / "1.csv").write_text(ARCHIVE.replace(",member_casual", "") + "\n")
    with pytest.raises(ValueError, match="member_casual"):
        archive.read_trip_csv(spark, str(tmp_path))


def test_ratio_of_large_sums(spark):
    big = spark.range(1).select(ratio(F.lit(6 * 10**13), F.lit(86400), 0, scale=86400).alias("r"))
    assert big.first()["r"] == 6e13


def test_all_facts_are_profiled(spark):
    from bikeflow.catalog import QUERIES
    from bikeflow.sources import views

    folder = "/root/testdata/sf0.001"
    n = views.status(spark, folder).count()
    assert QUERIES["fact_profile_whole"](spark, folder).first()["rows"] == n
    assert QUERIES["freshness_whole"](spark, folder).first()["rows"] == n
