from __future__ import annotations

from pyspark.sql import functions as F

from bikeflow.operators import events


def test_first_row_has_no_delta(status_rows, rows):
    got = events.snapshot_deltas(status_rows([(1, 7, 0, 5), (2, 7, 60, 3), (3, 8, 60, 9)]))
    assert rows(got, "status_id", "delta", "gap_seconds") == [(1, None, None), (2, -2, 60.0), (3, None, None)]


def test_gap_of_exactly_the_limit_and_delta_of_exactly_five(status_rows):
    data = [(1, 7, 0, 10), (2, 7, 179, 5), (3, 7, 359, 0), (4, 7, 400, 4)]
    flow = events.hourly_flows(status_rows(data)).first()
    # 179 s counts, 180 s does not; |delta| = 5 is a likely truck move.
    assert (flow["bikes_departed"], flow["bikes_arrived"], flow["likely_rebalance_events"]) == (5, 4, 1)


def test_departures_minus_arrivals_is_first_minus_last_level(status_rows):
    data = [(i, 3, i * 60, (i * 7) % 11) for i in range(100)]
    row = events.flow_balance(status_rows(data)).first()
    assert row["gross_out"] - row["gross_in"] == data[0][3] - data[-1][3]


def test_lookback_only_supplies_the_previous_level(status_rows, rows):
    data = [(1, 7, 0, 9), (2, 7, 60, 7), (3, 7, 120, 4), (4, 7, 600, 1)]
    since = "2024-01-01 00:01:00"
    got = events.departures(status_rows(data), since, lookback_s=30)
    # The mark itself (60 s) is loaded already; its row gives the level for 120 s.
    assert rows(got, "status_id", "n") == [(3, 3), (4, 3)]
    # Without a row inside the look-back the first delta is unknown.
    assert rows(events.departures(status_rows(data), "2024-01-01 00:05:00", 60), "status_id") == []


def test_repeating_a_run_from_the_newest_poll_yields_nothing(status_rows):
    data = [(1, 7, 0, 9), (2, 7, 60, 1)]
    status = status_rows(data)
    assert events.departures(status, status.select(F.max("polled_at")).scalar()).count() == 0


def test_clamp_and_repeat(status_rows, rows):
    left = events.departures(status_rows([(1, 7, 0, 20), (2, 7, 60, 1), (3, 7, 120, 0)]))
    assert rows(left, "status_id", "n") == [(2, 8), (3, 1)]
    assert rows(events.explode_count(left), "status_id", "unit") == [(2, u) for u in range(1, 9)] + [(3, 1)]


def test_explode_drops_counts_below_one(spark):
    df = spark.createDataFrame([(0,), (-2,), (None,), (2,)], "n int")
    assert events.explode_count(df).count() == 2


def test_thin_is_repeatable_and_near_its_share(spark, rows):
    df = spark.range(20000).withColumnRenamed("id", "k")
    kept = events.thin(df, ["k"], 0.55)
    assert rows(kept) == rows(events.thin(df.repartition(7), ["k"], 0.55))
    assert abs(kept.count() / 20000 - 0.55) < 0.02
    assert events.thin(df, ["k"], 1.0).count() == 20000
    assert events.thin(df, ["k"], 0.0).count() == 0


def test_level_order_breaks_ties_by_time(status_rows, rows):
    got = events.delta_by_level(status_rows([(1, 7, 0, 5), (2, 7, 60, 5), (3, 7, 120, 2)]))
    assert [tuple(r) for r in got.select("num_bikes_available", "delta").collect()] == [(2, None), (5, 3), (5, 0)]
