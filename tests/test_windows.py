"""Segmented windows equal plain ones, whatever the skew."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bikeflow.operators import allocation, events, quality
from bikeflow.operators.dimension import number_after
from bikeflow.plans.segments import add_segments, row_numbers, running_sum, with_previous


@pytest.fixture
def skewed(status_rows):
    """One station holds more than a third of the rows; some snapshots share their time."""
    rng = random.Random(3)
    data = []
    for i in range(1200):
        key = 1 if i % 5 < 2 else rng.randrange(2, 40)
        data.append((i, key, rng.randrange(0, 90000), rng.randrange(0, 20)))
    return status_rows(data)


def test_hot_key_is_cut_and_cold_keys_are_not(skewed):
    cut, was_cut = add_segments(skewed, ["station_key"], ["polled_at", "status_id"], max_rows=100)
    assert was_cut
    segments = {r[0]: r[1] for r in cut.groupBy("station_key").agg(F.count_distinct("_seg")).collect()}
    assert segments[1] >= 4
    assert all(n == 0 for k, n in segments.items() if k != 1)
    assert cut.groupBy("station_key", "_seg").count().agg(F.max("count")).first()[0] < 200
    assert cut.count() == skewed.count()


@pytest.mark.parametrize("max_rows", [3, 50, 400])
def test_previous_row_across_segments(skewed, rows, max_rows):
    order = ["polled_at", "status_id"]
    w = Window.partitionBy("station_key").orderBy(*order)
    plain = skewed.withColumn("prev", F.lag("num_bikes_available").over(w)).select("status_id", "prev")
    cut = with_previous(skewed, ["station_key"], order, {"prev": "num_bikes_available"}, max_rows)
    assert rows(cut, "status_id", "prev") == rows(plain)


def test_previous_value_null_is_not_a_missing_row(spark, rows):
    df = spark.createDataFrame([(1, i, None if i % 2 else i) for i in range(40)], "k int, t int, v int")
    got = with_previous(df, ["k"], ["t"], {"p": "v", "pt": "t"}, max_rows=5)
    assert rows(got, "t", "p", "pt") == sorted(
        [(i, None if i == 0 or (i - 1) % 2 else i - 1, None if i == 0 else i - 1) for i in range(40)]
    )


@pytest.mark.parametrize("keys", [[], ["station_key"]])
def test_running_sum_across_segments(skewed, rows, keys):
    w = (
        Window.partitionBy(*(keys or [F.lit(0)])).orderBy("polled_at", "status_id")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    plain = skewed.withColumn("s", F.sum("num_bikes_available").over(w)).select("status_id", "s")
    cut = running_sum(skewed, keys, ["polled_at", "status_id"], "num_bikes_available", "s", max_rows=60)
    assert rows(cut, "status_id", "s") == rows(plain)


def test_row_numbers_are_dense(skewed, rows):
    got = row_numbers(skewed, ["status_id"], "n", max_rows=37)
    assert rows(got, "status_id", "n") == [(i, i + 1) for i in range(1200)]


def test_key_numbers_continue_after_start(spark, rows):
    new = spark.createDataFrame([("b",), ("a",), ("c",)], "station_id string")
    got = number_after(new, ["station_id"], "k", F.lit(40).cast("bigint"), max_rows=1)
    assert rows(got, "station_id", "k") == [("a", 41), ("b", 42), ("c", 43)]


@pytest.mark.parametrize(
    "run",
    [
        lambda s, m: events.snapshot_deltas(s, max_rows=m),
        lambda s, m: events.hourly_flows(s, max_gap=5000, max_rows=m),
        lambda s, m: events.flow_balance(s, max_rows=m),
        lambda s, m: events.departures(s, "2024-01-01 10:00:00", 3600, max_rows=m),
        lambda s, m: quality.poll_gaps(s, 100, max_rows=m),
    ],
)
def test_operators_do_not_depend_on_segments(skewed, rows, run):
    assert rows(run(skewed, 25)) == rows(run(skewed, None))


def test_capacity_cdf_across_segments(station_rows, rows):
    st = station_rows([(k, 1.0 + k, 2.0, None if k % 7 == 0 else k) for k in range(1, 300)])
    cut = allocation.capacity_cdf(st, max_rows=20)
    assert rows(cut) == rows(allocation.capacity_cdf(st))
    edges = rows(cut, "w_lo", "w_hi")
    assert edges[0][0] == 0.0 and edges[-1][1] == 1.0
    assert all(a[1] == b[0] for a, b in zip(edges, edges[1:]))
