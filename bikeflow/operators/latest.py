"""Latest state, newest snapshot and profiles of the two tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bikeflow.functions.clock import instant, seconds_between
from bikeflow.functions.geo import point_wkt, snap
from bikeflow.functions.numbers import half_up

TEXT_TIME = "yyyy-MM-dd HH:mm:ss"


def latest_per(
    df: DataFrame, key: str | Sequence[str], ts: str, tiebreak: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Newest row per key.

    ``max_by`` combines on the map side, so a hot key sends one row per task
    through the shuffle instead of all its rows through one sort.
    """
    keys = [key] if isinstance(key, str) else list(key)
    wanted = columns if columns is not None else [c for c in df.columns if c not in keys]
    row = F.max_by(F.struct(*wanted), F.struct(ts, tiebreak)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*")


def _live(status: DataFrame) -> DataFrame:
    counts = ["num_bikes_available", "num_ebikes_available", "num_docks_available"]
    return latest_per(status, "station_key", "polled_at", "status_id", counts)


def newest_snapshot(status: DataFrame) -> DataFrame:
    """Totals of the rows that carry the newest ``polled_at``."""
    newest = status.select(F.max("polled_at")).scalar()
    return status.filter(F.col("polled_at") == newest).agg(
        F.count(F.lit(1)).alias("stations"),
        F.sum("num_bikes_available").alias("bikes"),
        F.sum("num_ebikes_available").alias("ebikes"),
        F.sum("num_docks_available").alias("docks"),
    )


def dim_profile(stations: DataFrame) -> DataFrame:
    """Counts, coordinate ranges as text and total capacity of the dimension."""

    def span(c: str) -> Column:
        return F.concat(
            F.format_string("%.3f", F.min(c)), F.lit(" .. "), F.format_string("%.3f", F.max(c))
        )

    placed = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    return stations.agg(
        F.count(F.lit(1)).alias("stations"),
        F.count_if(placed).alias("with_geometry"),
        span("lat").alias("lat_range"),
        span("lon").alias("lon_range"),
        F.sum("capacity").alias("total_docks"),
    )


def fact_profile(status: DataFrame, as_of: Column | dt.datetime | str) -> DataFrame:
    """Size, coverage, first and last poll as text, and seconds behind ``as_of``."""
    return status.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("station_key").alias("stations_seen"),
        F.count_distinct("polled_at").alias("polls"),
        F.min("polled_at").alias("first"),
        F.max("polled_at").alias("last"),
    ).select(
        "rows", "stations_seen", "polls",
        F.date_format("first", TEXT_TIME).alias("first_poll"),
        F.date_format("last", TEXT_TIME).alias("last_poll"),
        F.rint(seconds_between(instant(as_of), F.col("last"))).cast("int").alias("seconds_behind"),
    )


def recent_polls(status: DataFrame, n: int = 10) -> DataFrame:
    """The last ``n`` polls with their station, bike and dock totals."""
    return (
        status.groupBy("polled_at")
        .agg(
            F.count(F.lit(1)).alias("stations"),
            F.sum("num_bikes_available").alias("bikes_out_there"),
            F.sum("num_docks_available").alias("free_docks"),
        )
        .orderBy(F.col("polled_at").desc_nulls_last())
        .limit(n)
        .withColumn("poll", F.date_format("polled_at", "HH:mm:ss"))
        .select("poll", "stations", "bikes_out_there", "free_docks")
    )


def empty_now(status: DataFrame, stations: DataFrame, n: int = 10, grid: float = 0.0001) -> DataFrame:
    """Stations whose newest row has no bikes, largest capacity first."""
    empty = _live(status).filter(F.col("num_bikes_available") == 0)
    return (
        empty.join(stations.select("station_key", "name", "capacity", "lon", "lat"), "station_key")
        .orderBy(F.col("capacity").desc_nulls_last(), "station_key")
        .limit(n)
        .select(
            "name",
            F.col("num_bikes_available").alias("bikes"),
            F.col("num_docks_available").alias("docks"),
            point_wkt(snap(F.col("lon"), grid), snap(F.col("lat"), grid)).alias("point"),
        )
    )


def station_map(status: DataFrame, stations: DataFrame) -> DataFrame:
    """Every station with its live counts, 0 when it never reported."""
    kept = stations.select("station_key", "name", "capacity", "lon", "lat")
    return kept.join(_live(status), "station_key", "left").select(
        "station_key", "name", "capacity", "lon", "lat",
        F.coalesce("num_bikes_available", F.lit(0)).alias("bikes"),
        F.coalesce("num_ebikes_available", F.lit(0)).alias("ebikes"),
        F.coalesce("num_docks_available", F.lit(0)).alias("docks"),
    )


def trip_summary(trips: DataFrame) -> DataFrame:
    """Trips by source: count, first and last to the minute, average length."""
    minute = "yyyy-MM-dd HH:mm"
    return trips.groupBy("source").agg(
        F.count(F.lit(1)).alias("trips"),
        F.date_format(F.min("started_at"), minute).alias("first"),
        F.date_format(F.max("started_at"), minute).alias("last"),
        half_up(F.avg("duration_s")).alias("avg_seconds"),
        half_up(F.avg("meters")).alias("avg_meters"),
    )
