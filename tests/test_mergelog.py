"""The log of runs: one winner per key in any order, few runs, reads and removals by folder."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from bikeflow.streaming.mergelog import MergeLog

SCHEMA = "k bigint, at timestamp, a int, b string"
DAY0 = dt.datetime(2024, 3, 1)


def log_at(spark, path, **options):
    return MergeLog(spark, str(path), SCHEMA, ("k", "at"), "at", **options)


def frame(spark, rows):
    typed = spark.createDataFrame([(k, s, a, b) for k, s, a, b in rows], "k bigint, s bigint, a int, b string")
    return typed.selectExpr("k", "timestamp_seconds(unix_seconds(timestamp'2024-03-01 00:00:00Z') + s) as at", "a", "b")


def seen(df):
    rows = df.selectExpr("k", "unix_seconds(at) - unix_seconds(timestamp'2024-03-01 00:00:00Z') as s", "a", "b").collect()
    return sorted(((r.k, r.s, r.a, r.b) for r in rows), key=str)


def winners(rows):
    best = {}
    for k, s, a, b in rows:
        mine = ((a is not None, a), (b is not None, b))
        if (k, s) not in best or mine > best[k, s][0]:
            best[k, s] = (mine, (k, s, a, b))
    return sorted((v for _, v in best.values()), key=str)


def test_any_order_gives_the_same_winner_and_few_runs(spark, tmp_path):
    r = random.Random(1)
    rows = [
        (r.randrange(4), None if i % 29 == 0 else 21600 * r.randrange(40), r.choice([None, 1, 2, 3]), r.choice([None, "x", "y"]))
        for i in range(240)
    ]
    for order in (1, 2):
        random.Random(order).shuffle(rows)
        log = log_at(spark, tmp_path / str(order), fan=3)
        for batch in range(24):
            part = rows[batch * 10 : batch * 10 + 10]
            done = log.append(frame(spark, part), batch)
            assert max(sum(x.level == level for x in done.live) for level in range(4)) < 3
        assert seen(log.read()) == winners(rows)
        # 24 batches are 220 in base three: two runs of 9 batches, two of 3; what was merged is gone but for the last.
        assert sorted(x.level for x in done.live) == [1, 1, 2, 2]
        on_disk = {p.name for p in (tmp_path / str(order) / "runs").iterdir() if any(p.iterdir())}
        assert on_disk == {f"run={x.name}" for x in done.live} | set(done.gone)


def test_a_repeated_batch_replaces_itself_even_after_a_merge(spark, tmp_path):
    log = log_at(spark, tmp_path, fan=2)
    assert log.read().count() == 0 and log.newest() is None
    for batch, rows in enumerate([[(1, 0, 1, "a")], [(1, 0, 2, "a")], [], [(2, 60, 1, None)]]):
        first = log.append(frame(spark, rows), batch)
        assert log.append(frame(spark, rows), batch) == first
    assert seen(log.read()) == [(1, 0, 2, "a"), (2, 60, 1, None)]
    with pytest.raises(RuntimeError):
        log_at(spark, tmp_path).manifest(2)  # both slots are newer: that batch cannot be repeated any more


def test_ranked_columns_decide_first(spark, tmp_path):
    log = MergeLog(spark, str(tmp_path), SCHEMA, ("k",), "at", ("b",))
    log.append(frame(spark, [(1, 0, 9, "p"), (2, 0, 1, "p")]), 0)
    log.append(frame(spark, [(1, 3600, 1, "q")]), 1)
    log.append(frame(spark, [(1, 0, 10, "p")]), 2)
    assert seen(log.read()) == [(1, 3600, 1, "q"), (2, 0, 1, "p")]


def test_newest_and_days_are_known_without_reading(spark, tmp_path):
    log = log_at(spark, tmp_path)
    log.append(frame(spark, [(1, 0, 1, ""), (1, 86400, 1, ""), (1, None, 1, "")]), 0)
    log.append(frame(spark, [(2, 86400 + 5, 1, ""), (2, 3 * 86400, 1, "")]), 1)
    moment = spark.createDataFrame([(log.newest(),)], "t timestamp").selectExpr("date_format(t, 'yyyy-MM-dd HH:mm:ss')").first()[0]
    assert moment == "2024-03-04 00:00:00"
    day = DAY0.date()
    second = log.read(day + dt.timedelta(1), day + dt.timedelta(1))
    assert seen(second) == [(1, 86400, 1, ""), (2, 86405, 1, "")]
    assert {f.split("_day=")[1][:10] for f in second.inputFiles()} == {"2024-03-02"}
    assert seen(log.read(day + dt.timedelta(2))) == [(2, 3 * 86400, 1, "")]
    assert log.read(day + dt.timedelta(9)).count() == 0


def test_retention_removes_whole_days_by_folder(spark, tmp_path):
    log = log_at(spark, tmp_path)
    rows = [(k, 21600 * s, s, "v") for k in range(2) for s in range(20)]
    log.append(frame(spark, rows[::2]), 0)
    log.append(frame(spark, [*rows[1::2], (7, None, 1, "v")]), 1)
    before = {str(p) for p in tmp_path.glob("runs/*/*/*.parquet")}
    cutoff = DAY0 + dt.timedelta(days=2, hours=9)
    first = log.drop_before(cutoff, 2)
    assert log.drop_before(cutoff, 2) == first
    left = sorted([x for x in rows if x[1] >= 2 * 86400 + 9 * 3600] + [(7, None, 1, "v")], key=str)
    assert seen(log.read()) == left
    log.append(frame(spark, []), 3)  # the folders go now
    after = {str(p) for p in tmp_path.glob("runs/*/*/*.parquet")}
    assert not [f for f in after if "_day=2024-03-01" in f or "_day=2024-03-02" in f]
    untouched = {f for f in before if "_day=2024-03-04" in f or "_day=2024-03-05" in f or "HIVE" in f}
    assert untouched and untouched <= after and seen(log.read()) == left
