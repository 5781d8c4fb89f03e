"""Weighted choice, and measured profiles of trips by time, bike and rider."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bikeflow.functions.clock import instant, iso_weekday, local_to_utc, utc_to_local
from bikeflow.functions.numbers import half_up, ratio
from bikeflow.operators.events import departures
from bikeflow.operators.proximity import knn_join
from bikeflow.plans.segments import running_sum
from bikeflow.plans.skew import hot_keys

SLICE_ROWS = 1_000_000    # rows of one key that a join group takes before its slices are made finer


def decay_pool(
    stations: DataFrame, k: int = 60, decay_m: float = 1500.0, max_rows: int | None = None
) -> DataFrame:
    """Destination buckets ``[w_lo, w_hi)`` per start station, weighted ``exp(-metres / decay_m)``.

    The buckets of a start cover [0, 1) without gaps: each begins where the one
    before ends, and the last ends at exactly 1.
    """
    near = knn_join(stations, k, max_rows=max_rows).select(
        F.col("station_key").alias("start_station_key"),
        F.col("neighbour_key").alias("end_station_key"),
        "meters",
        F.exp(-F.col("meters") / F.lit(decay_m)).alias("w"),
    )
    start = Window.partitionBy("start_station_key")
    ordered = start.orderBy("end_station_key")
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = F.sum("w").over(upto) / F.sum("w").over(start)
    last = F.lead("end_station_key").over(ordered).isNull()
    shares = near.withColumn("w_hi", F.when(last, 1.0).otherwise(share))
    return shares.withColumn("w_lo", F.coalesce(F.lag("w_hi").over(ordered), F.lit(0.0))).select(
        "start_station_key", "end_station_key", "meters", "w_lo", "w_hi"
    ).filter(F.col("w_hi").isNotNull())


def capacity_cdf(stations: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Stations as buckets of [0, 1) by capacity (null counts 1), in key order."""
    placed = stations.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull()).select(
        "station_key", F.coalesce("capacity", F.lit(1)).cast("bigint").alias("cap")
    )
    total = placed.select(F.nullif(F.sum("cap"), F.lit(0).cast("bigint"))).scalar()
    run = running_sum(placed, [], ["station_key"], "cap", "run", max_rows)
    return run.select(
        "station_key",
        ((F.col("run") - F.col("cap")) / total).alias("w_lo"),
        (F.col("run") / total).alias("w_hi"),
    ).filter(F.col("w_hi").isNotNull())


def bucket_join(
    df: DataFrame,
    draw: str,
    buckets: DataFrame,
    key: tuple[str, str] | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Rows of ``df`` with the bucket whose ``[w_lo, w_hi)`` holds their ``draw``.

    ``key`` names the matching key columns (left, right). The unit interval is cut
    into slices and the slice joins along with the key, so a row meets a few buckets
    instead of all. Without a key there is a slice for every four buckets; with one,
    a key gets a slice for every ``SLICE_ROWS`` of its rows, so that a hot key spreads
    over as many join groups as its rows ask for. The table of hot keys is broadcast:
    it has at most one row per ``SLICE_ROWS`` rows.
    """
    wide = buckets.filter(F.col("w_hi") > F.col("w_lo"))
    whole = F.lit(1).cast("bigint")
    rows = df
    if slices is not None:
        rows, wide = (x.withColumn("_slices", F.lit(slices).cast("bigint")) for x in (rows, wide))
    elif key is None:
        fine = F.greatest(F.ceil(buckets.select(F.count(F.lit(1)) / 4).scalar()), whole)
        rows, wide = rows.withColumn("_slices", fine), wide.withColumn("_slices", fine)
    else:
        hot = hot_keys(df, [key[0]], SLICE_ROWS).select(F.col(key[0]).alias("_hot"), "_groups")

        def sliced(x: DataFrame, name: str) -> DataFrame:
            met = x.join(F.broadcast(hot), F.col(name) == F.col("_hot"), "left")
            return met.select(*x.columns, F.coalesce("_groups", whole).alias("_slices"))

        rows, wide = sliced(rows, key[0]), sliced(wide, key[1])

    def slice_of(u: str) -> Column:
        return F.least(F.floor(F.col(u) * F.col("_slices")), F.col("_slices") - 1)

    cut = wide.withColumn("_slice", F.explode(F.sequence(slice_of("w_lo"), slice_of("w_hi")))).drop("_slices")
    rows = rows.withColumn("_slice", slice_of(draw)).drop("_slices")
    on = F.col("l._slice") == F.col("r._slice")
    if key:
        on = on & (F.col(f"l.{key[0]}") == F.col(f"r.{key[1]}"))
    inside = (F.col(f"l.{draw}") >= F.col("r.w_lo")) & (F.col(f"l.{draw}") < F.col("r.w_hi"))
    taken = [c for c in buckets.columns if c not in df.columns]
    return rows.alias("l").join(cut.alias("r"), on & inside).select(
        *[F.col(f"l.{c}") for c in df.columns], *[F.col(f"r.{c}") for c in taken]
    )


def expected_od(left: DataFrame, pool: DataFrame) -> DataFrame:
    """Expected trips per pair: departures of the start times the bucket width."""
    out = left.groupBy(F.col("station_key").alias("start_station_key")).agg(F.sum("n").alias("n"))
    return pool.join(out, "start_station_key").select(
        "start_station_key", "end_station_key", "n",
        (F.col("n") * (F.col("w_hi") - F.col("w_lo"))).alias("expected"),
    )


def trip_attributes(trips: DataFrame) -> DataFrame:
    """Rides by bike and rider type as measured: count, total and mean time, metres per second."""
    seconds, metres = F.sum("duration_s"), F.sum("meters")
    return trips.groupBy("rideable_type", "member_casual").agg(
        F.count(F.lit(1)).alias("trips"),
        seconds.cast("bigint").alias("seconds"),
        half_up(F.avg("duration_s")).alias("avg_seconds"),
        half_up(metres.cast("double") / F.nullif(seconds, F.lit(0).cast("bigint")), 3).alias("metres_per_second"),
    )


def observed_trips(
    status: DataFrame,
    trips: DataFrame,
    since: Column | dt.datetime | str | None = None,
    lookback_s: float = 120,
    max_rows: int | None = None,
) -> DataFrame:
    """Bikes that dock levels saw leave a station, beside the trips recorded from there, after ``since``.

    Both sides shrink to one row per station before they meet.
    """
    gone = departures(status, since, lookback_s, max_rows=max_rows).groupBy("station_key").agg(
        F.sum("n").alias("departures")
    )
    started = trips if since is None else trips.filter(F.col("started_at") > instant(since))
    counted = started.groupBy(F.col("start_station_key").alias("station_key")).agg(
        F.count(F.lit(1)).alias("trips")
    )
    none = F.lit(0).cast("bigint")
    both = gone.join(counted, "station_key", "full").select(
        "station_key", F.coalesce("departures", none).alias("departures"), F.coalesce("trips", none).alias("trips")
    )
    return both.withColumn("trips_per_departure", ratio(F.col("trips"), F.col("departures"), 3))


def _local_hours(trips: DataFrame, tz: str) -> DataFrame:
    """Trips per local ``day`` and hour ``h``: everything below is computed from these few rows."""
    local = utc_to_local(F.col("started_at"), tz)
    placed = trips.filter(F.col("started_at").isNotNull())
    return placed.groupBy(F.to_date(local).alias("day"), F.hour(local).alias("h")).agg(
        F.count(F.lit(1)).alias("n")
    ).withColumn("weekend", iso_weekday(F.col("day")) >= 6)


def _shares(hours: DataFrame) -> DataFrame:
    grid = hours.select("weekend").distinct().withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(23))))
    counted = hours.groupBy("weekend", "h").agg(F.sum("n").alias("n"))
    dense = grid.join(counted, ["weekend", "h"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
    return dense.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("weekend")))


def hour_profile(trips: DataFrame, tz: str = "America/New_York") -> DataFrame:
    """Measured share of each local hour in the trips of working days and of weekends."""
    return _shares(_local_hours(trips, tz)).select("weekend", "h", F.col("n").alias("trips"), "share")


def apportion(trips: DataFrame, tz: str = "America/New_York") -> DataFrame:
    """Expected and counted trips per local hour of each day with trips, and the UTC hour start.

    Expected is the mean day times the measured factors of the day of the year and of
    working days or weekends, times the measured share of the hour.
    """
    hours = _local_hours(trips, tz)
    days = hours.groupBy("day", "weekend").agg(F.sum("n").alias("of_day")).withColumn("doy", F.dayofyear("day"))
    mean = days.select(F.avg("of_day")).scalar()
    season = days.groupBy("doy").agg((F.avg("of_day") / mean).alias("season"))
    week = days.groupBy("weekend").agg((F.avg("of_day") / mean).alias("week"))
    shares = _shares(hours).select("weekend", "h", "share")
    local = F.timestamp_seconds(F.unix_date("day").cast("bigint") * 86400 + F.col("h") * 3600)
    grid = days.join(season, "doy").join(week, "weekend").join(shares, "weekend")
    return grid.join(hours.select("day", "h", "n"), ["day", "h"], "left").select(
        "day", "h",
        (mean * F.col("season") * F.col("week") * F.col("share")).alias("expected"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("trips"),
        local_to_utc(local, tz).alias("starts_at"),
    )
