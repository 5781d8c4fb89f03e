"""Streaming jobs over several micro-batches equal their batch twins."""

from __future__ import annotations

import datetime as dt
import json
import random

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from bikeflow.operators import events
from bikeflow.sources import feeds
from bikeflow.streaming import departures, landing, repair

START = 1704067200


def document(second, stations):
    listed = [
        {"station_id": i, "last_reported": START + second, "num_bikes_available": b, "is_renting": 1} for i, b in stations
    ]
    return json.dumps({"last_updated": START + second, "data": {"stations": listed}}, indent=1)


@pytest.fixture
def folder(tmp_path):
    """Feed files that land one after another."""
    path = tmp_path / "feed"
    path.mkdir()

    def land(name, text):
        (path / f"{name}.json").write_text(text)

    land.path = str(path)
    return land


def run(query):
    query.awaitTermination()


def test_append_across_restarts_collapses_repeats(spark, folder, tmp_path, rows):
    sink, state = str(tmp_path / "landing"), str(tmp_path / "state")
    folder("1", document(0, [("a", 5), ("b", 3)]))
    run(landing.stream_append_status(landing.read_documents(spark, folder.path), sink, state))
    folder("2", document(0, [("a", 5), ("b", 3)]))      # the publisher has not moved on
    folder("3", document(60, [("a", 4), ("b", 3)]))
    folder("0", document(-90000, [("a", 9)]))           # a day late, still kept
    run(landing.stream_append_status(landing.read_documents(spark, folder.path), sink, state))
    assert spark.read.parquet(sink).count() == 7
    got = rows(landing.read_landing(spark, sink), "station_id", "num_bikes_available")
    assert got == [("a", 4), ("a", 5), ("a", 9), ("b", 3), ("b", 3)]


def test_dedup_in_the_stream(spark, folder, tmp_path):
    sink, state = str(tmp_path / "landing"), str(tmp_path / "state")
    for i in range(3):
        folder(str(i), document(0, [("a", 5)]))
        run(landing.stream_append_status(landing.read_documents(spark, folder.path), sink, state, dedup_within="1 hour"))
    assert spark.read.parquet(sink).count() == 1


def test_sync_loads_the_dimension_first_and_only_newer_facts(spark, folder, tmp_path, rows):
    target = landing.SyncTarget(spark, str(tmp_path / "sync"))
    listing = {"names": {"a": "A", "b": "B"}}

    def stations():
        listed = [{"station_id": i, "name": n, "lat": 40.0, "lon": -73.0} for i, n in listing["names"].items()]
        text = json.dumps({"data": {"stations": listed}})
        return feeds.parse_stations(spark.createDataFrame([(text,)], "json string"))

    def go():
        docs = landing.read_documents(spark, folder.path)
        run(landing.stream_sync(docs, stations, target, str(tmp_path / "state"), landing.ONCE))

    folder("1", document(0, [("a", 5), ("b", 3), ("x", 1)]))
    go()
    assert rows(target.stations(), "station_key", "station_id", "name") == [(1, "a", "A"), (2, "b", "B")]
    assert rows(target.unmatched(), "station_id") == [("x",)]
    listing["names"] = {"a": "A2", "b": "B", "x": "X"}
    folder("2", document(0, [("a", 7)]))                # at the mark: not loaded again
    folder("3", document(60, [("a", 4), ("x", 2)]))
    go()
    assert rows(target.stations(), "station_key", "station_id", "name") == [(1, "a", "A2"), (2, "b", "B"), (3, "x", "X")]
    # The row of x that waited is loaded now that x is known; of two rows of a poll the greatest stays.
    want = [(1, 4), (1, 7), (2, 3), (3, 1), (3, 2)]
    assert rows(target.facts(), "station_key", "num_bikes_available") == want
    assert target.unmatched().count() == 0
    # Unchanged stations are not written again: two in the first run, two in the second.
    assert spark.read.parquet(f"{target.path}/stations/runs").count() == 4

    # A batch repeated after a failure replaces its own output.
    batch = feeds.parse_status(spark.createDataFrame([(document(60, [("a", 4), ("x", 2)]),)], "json string"))
    batch = batch.unionByName(feeds.parse_status(spark.createDataFrame([(document(0, [("a", 7)]),)], "json string")))
    landing.sync_micro_batch(target, stations)(batch, 1)
    assert rows(target.facts(), "station_key", "num_bikes_available") == want
    assert target.stations().count() == 3


@pytest.fixture
def status_files(spark, status_rows, tmp_path):
    path = str(tmp_path / "status")

    def land(data):
        status_rows(data).coalesce(1).write.mode("append").parquet(path)

    def stream():
        return spark.readStream.schema(status_rows([(1, 1, 1, 1)]).schema).option("maxFilesPerTrigger", 1).parquet(path)

    land.stream, land.path = stream, path
    return land


def test_poll_totals_update_over_batches(spark, status_files, tmp_path, rows):
    sink, state = str(tmp_path / "totals"), str(tmp_path / "state")
    for data in ([(1, 1, 0, 5), (2, 2, 0, 6)], [(3, 3, 0, 1), (4, 1, 60, 5)], [(5, 2, 60, 7)]):
        status_files(data)
        run(landing.stream_poll_totals(status_files.stream(), sink, state))
    got = rows(landing.read_poll_totals(spark, sink), "stations", "bikes")
    assert got == [(2, 12), (3, 12)]


def test_departures_across_batches_equal_the_batch_result(spark, status_files, tmp_path, rows):
    data = [(i, 1 + i % 3, i * 20, (i * i * 7) % 23) for i in range(120)]
    sink, state = str(tmp_path / "left"), str(tmp_path / "state")
    for i in range(0, 120, 30):
        status_files(data[i : i + 30])
        run(departures.stream_departures(status_files.stream(), sink, state, lateness_s=60))
    batch = events.departures(spark.read.parquet(status_files.path))
    assert rows(departures.read_departures(spark, sink), "status_id", "n") == rows(batch, "status_id", "n")
    assert departures.read_departures(spark, sink).count() > 20


def test_a_late_row_repairs_the_deltas_beside_it(spark, status_files, tmp_path, rows):
    wide, none = (str(tmp_path / "wide"), str(tmp_path / "s1")), (str(tmp_path / "none"), str(tmp_path / "s2"))
    for data in ([(1, 1, 0, 9), (2, 1, 120, 6)], [(3, 1, 60, 1)], [(4, 1, 180, 5)]):
        status_files(data)
        run(departures.stream_departures(status_files.stream(), *wide, lateness_s=300))
        run(departures.stream_departures(status_files.stream(), *none, lateness_s=0))
    # The row for 60 s takes the departure at 120 s back: 9, 1, 6, 5.
    assert rows(departures.read_departures(spark, wide[0]), "status_id", "n") == [(3, 8), (4, 1)]
    assert departures.read_late(spark, wide[1]).count() == 0
    # Without lateness only the newest row is held; 180 s still compares with 120 s.
    assert rows(departures.read_departures(spark, none[0]), "status_id", "n") == [(2, 3), (4, 1)]
    assert rows(departures.read_late(spark, none[1]), "status_id", "level", "batch") == [(3, 1, 1)]


def test_rows_in_any_order_give_the_batch_result():
    r = random.Random(5)
    for trial in range(60):
        data = [(r.randrange(40), i, r.choice([None, *range(12)])) for i in range(60)]
        data += r.sample(data, 5)                       # repeated rows count once
        want = {}
        ordered = sorted(set(data), key=lambda x: x[:2])
        for (_, _, before), (ts, tie, level) in zip(ordered, ordered[1:]):
            if before is not None and level is not None and level < before:
                want[ts, tie] = min(before - level, 8)
        r.shuffle(data)
        held, cut, total = np.zeros(0, repair.ROWS), False, {}
        for lo in range(0, len(data), 7):
            part = np.array([(t, i, v or 0, v is not None) for t, i, v in data[lo : lo + 7]], repair.ROWS)
            held, cut, changes, late = repair.merge(held, cut, part, 10**6, 8)
            assert not len(late)
            for ts, tie, n, sign in changes.tolist():
                total[ts, tie, n] = total.get((ts, tie, n), 0) + sign
        assert {k[:2]: k[2] for k, v in total.items() if v} == want and set(total.values()) <= {0, 1}


def test_stations_of_a_bucket_are_repaired_together_as_each_alone():
    r = random.Random(6)
    for lateness in (0, 5, 10**6):
        held, alone = np.zeros(0, repair.KEYED), {}
        for _ in range(12):
            part = [(r.random() < 0.1, r.randrange(-3, 4), r.randrange(40), r.randrange(5), r.randrange(9), r.random() < 0.9, False) for _ in range(r.randrange(25))]
            new = np.array([(a, 0 if a else b, *rest) for a, b, *rest in part], repair.KEYED)
            held, changes, late = repair.merge_stations(held, new, lateness, 8)
            want, behind = set(), 0
            for a, b in {(x["nokey"], x["key"]) for x in new}:
                mine = new[(new["nokey"] == a) & (new["key"] == b)]
                rows, cut = alone.get((a, b), (np.zeros(0, repair.ROWS), False))
                own = np.array([(x["ts"], x["tie"], x["level"], x["known"]) for x in mine], repair.ROWS)
                rows, cut, moved, old = repair.merge(rows, cut, own, lateness, 8)
                alone[a, b] = rows, cut
                want |= {(int(a), int(b), *m) for m in moved.tolist()}
                behind += len(old)
            assert {tuple(c) for c in changes.tolist()} == want and len(late) == behind
        for (a, b), (rows, cut) in alone.items():
            mine = held[(held["nokey"] == a) & (held["key"] == b)]
            assert [tuple(x)[2:6] for x in mine.tolist()] == rows.tolist() and set(mine["cut"]) == {cut}


def test_stations_share_calls_of_the_state(spark, status_files, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(departures, "BUCKETS", 2)
    status_files([(i * 10 + j, None if i == 7 else i, j, 9 - j) for i in range(30) for j in range(3)])
    sink, state = str(tmp_path / "d"), str(tmp_path / "state")
    run(departures.stream_departures(status_files.stream(), sink, state, lateness_s=60))
    got = rows(departures.read_departures(spark, sink), "station_key", "status_id", "n")
    assert got == sorted(((None if i == 7 else i, i * 10 + j, 1) for i in range(30) for j in (1, 2)), key=lambda t: (t[0] is None, t))


def test_held_rows_are_bounded_by_the_lateness():
    held, cut = np.zeros(0, repair.ROWS), False
    for i in range(100):
        part = np.array([(i * 60, i, i % 9, True)], repair.ROWS)
        held, cut, _, _ = repair.merge(held, cut, part, 300, 8)
    assert len(held) == 6 and cut and held["ts"][0] == 94 * 60  # the newest row of 300 ago, and all since
    empty = repair.merge(held[:0], False, held[:0], 300, 8)
    assert [len(x) for x in (empty[0], empty[2], empty[3])] == [0, 0, 0]


def test_facts_lie_by_day_and_empty_batches_are_no_error(spark, folder, tmp_path, rows):
    listed = json.dumps({"data": {"stations": [{"station_id": "a", "name": "a", "lat": 40.0, "lon": -73.0}]}})
    target = landing.SyncTarget(spark, str(tmp_path / "sync"))
    stations = lambda: feeds.parse_stations(spark.createDataFrame([(listed,)], "json string"))
    for i, (second, station) in enumerate([(0, "x"), (86400, "a"), (0, "a"), (86400, "a")]):
        folder(str(i), document(second, [(station, 5 + i)]))
        docs = landing.read_documents(spark, folder.path)
        run(landing.stream_sync(docs, stations, target, str(tmp_path / "state"), landing.ONCE))
    assert rows(target.facts(), "num_bikes_available") == [(7,), (8,)]
    day = dt.date(2024, 1, 1)
    one = target.facts(day, day)
    assert one.count() == 1 and all("_day=2024-01-01" in f for f in one.inputFiles())
    with pytest.raises(AnalysisException):
        landing.SyncTarget(spark, str(tmp_path / "nowhere")).stations(3)


def test_a_silent_station_is_not_forgotten(spark, status_files, tmp_path, rows):
    sink, state = str(tmp_path / "left"), str(tmp_path / "state")
    day = 86400
    for data in ([(1, 1, 0, 9), (2, 2, 0, 9)], [(3, 2, 5 * day, 8)], [(4, 2, 6 * day, 8)], [(5, 1, 6 * day, 1), (6, 2, 6 * day + 60, 7)]):
        status_files(data)
        run(departures.stream_departures(status_files.stream(), sink, state, lateness_s=60))
    assert rows(departures.read_departures(spark, sink), "status_id", "n") == [(3, 1), (5, 8), (6, 1)]


@pytest.mark.parametrize("files", [1, 3, 1000])
def test_sync_is_complete_in_any_order_and_number_of_batches(spark, folder, tmp_path, rows, files):
    seconds = [300, 0, 240, 60, 420, 120, 360, 180]
    for i, s in enumerate(seconds):
        folder(str(i), document(s, [("a", s // 60), ("b", 1)]))
    listed = json.dumps({"data": {"stations": [{"station_id": i, "name": i, "lat": 40.0, "lon": -73.0} for i in "ab"]}})
    target = landing.SyncTarget(spark, str(tmp_path / "sync"))
    docs = landing.read_documents(spark, folder.path, files_per_trigger=files)
    stations = lambda: feeds.parse_stations(spark.createDataFrame([(listed,)], "json string"))
    run(landing.stream_sync(docs, stations, target, str(tmp_path / "state"), landing.ONCE))
    want = sorted([(1, s // 60) for s in seconds] + [(2, 1)] * 8)
    assert rows(target.facts(), "station_key", "num_bikes_available") == want


@pytest.mark.parametrize("files", [1, 3, 8])
def test_sync_of_conflicting_copies_equals_the_collapse_of_all(spark, folder, tmp_path, rows, files):
    polls = [(120, 4, 2), (0, 9, 1), (120, 7, 1), (60, 3, 3), (0, 8, 5), (120, 7, 2), (60, 3, 9), (0, 9, 0)]
    for i, (second, a, b) in enumerate(polls):
        folder(str(i), document(second, [("a", a), ("b", b), ("new", i)]))
    listed = ["a", "b"]

    def stations():
        listed.append("new") if len(listed) == 2 and files < 8 else None  # known from the first or a later batch on
        text = json.dumps({"data": {"stations": [{"station_id": i, "name": i, "lat": 40.0, "lon": -73.0} for i in listed]}})
        return feeds.parse_stations(spark.createDataFrame([(text,)], "json string"))

    target = landing.SyncTarget(spark, str(tmp_path / "sync"), fan=3)
    docs = landing.read_documents(spark, folder.path, files_per_trigger=files)
    run(landing.stream_sync(docs, stations, target, str(tmp_path / "state"), landing.ONCE))
    if files == 8:
        assert rows(target.unmatched(), "num_bikes_available") == [(5,), (6,), (7,)]
        listed.append("new")
        folder("9", document(0, [("a", 1)]))
        run(landing.stream_sync(landing.read_documents(spark, folder.path), stations, target, str(tmp_path / "state"), landing.ONCE))
    got = rows(target.facts().join(target.stations(), "station_key"), "station_id", "last_reported", "num_bikes_available")
    whole = landing.collapse_landing(feeds.parse_status(spark.read.text(folder.path, wholetext=True).toDF("json")))
    assert got == rows(whole, "station_id", "last_reported", "num_bikes_available") and len(got) == 9
    assert target.unmatched().count() == 0


def test_sync_starts_no_task_for_every_shuffle_partition(spark, tmp_path, rows):
    listed = json.dumps({"data": {"stations": [{"station_id": i, "name": i, "lat": 40.0, "lon": -73.0} for i in "ab"]}})
    stations = lambda: feeds.parse_stations(spark.createDataFrame([(listed,)], "json string"))
    docs = spark.createDataFrame([(document(60 * i, [("a", i), ("b", 1), ("x", 2)]),) for i in range(4)], "json string")
    target = landing.SyncTarget(spark, str(tmp_path / "sync"))
    before, tracker = spark.conf.get("spark.sql.shuffle.partitions"), spark.sparkContext.statusTracker()
    spark.conf.set("spark.sql.shuffle.partitions", "97")
    spark.sparkContext.setJobGroup("one-sync-batch", "")
    try:
        landing.sync_micro_batch(target, stations)(feeds.parse_status(docs), 0)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("one-sync-batch") for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(s.numTasks for s in stages if s) < 97
    assert rows(target.facts(), "station_key", "num_bikes_available") == [(1, 0), (1, 1), (1, 2), (1, 3)] + [(2, 1)] * 4
    assert target.unmatched().count() == 4
