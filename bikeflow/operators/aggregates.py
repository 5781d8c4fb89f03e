"""Fleet and trip aggregates.

Wherever a query joins facts to the dimension only to name a group, the facts
are first reduced per key. The shuffle and the join then carry one row per
station (or pair) and map task, so neither the fact size nor a hot station
reaches the join; grouping by name afterwards merges same-named stations.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bikeflow.functions.clock import instant, iso_weekday, span, time_bucket, utc_to_local
from bikeflow.functions.numbers import half_up, mean, ratio

BIKES, EBIKES, DOCKS = "num_bikes_available", "num_ebikes_available", "num_docks_available"
AsOf = Column | dt.datetime | str


def _rows() -> Column:
    return F.count(F.lit(1))


def _hour() -> Column:
    return F.hour("polled_at").alias("hour_utc")


def _hour_start() -> Column:
    return F.date_trunc("hour", "polled_at").alias("hour_utc")


def system_pulse(status: DataFrame) -> DataFrame:
    """Distinct polls and average levels by hour of day (UTC)."""
    return status.groupBy(_hour()).agg(
        F.count_distinct("polled_at").alias("polls"),
        mean(F.col(BIKES), 1).alias("avg_bikes_at_dock"),
        mean(F.col(DOCKS), 1).alias("avg_free_docks"),
    )


def fleet_by_hour(status: DataFrame) -> DataFrame:
    """Observations and average levels by hour of day (UTC)."""
    return status.groupBy(_hour()).agg(
        _rows().alias("observations"),
        mean(F.col(BIKES), 1).alias("avg_bikes"),
        mean(F.col(DOCKS), 1).alias("avg_free_docks"),
    )


def _by_name(status: DataFrame, stations: DataFrame) -> DataFrame:
    """Mergeable station sums, brought to station names."""
    per_key = status.groupBy("station_key").agg(
        _rows().alias("observations"),
        F.sum(BIKES).alias("bike_sum"),
        F.count(BIKES).alias("bike_count"),
        F.max(BIKES).alias("peak"),
        F.min(BIKES).alias("trough"),
        F.count_if(F.col(BIKES) == 0).alias("no_bikes"),
        F.count_if(F.col(DOCKS) == 0).alias("no_docks"),
    )
    return per_key.join(stations.select("station_key", "name"), "station_key").groupBy("name")


def busiest(status: DataFrame, stations: DataFrame, min_obs: int = 5, n: int = 15) -> DataFrame:
    """Stations with the highest peak level."""
    return (
        _by_name(status, stations)
        .agg(
            F.sum("observations").alias("observations"),
            ratio(F.sum("bike_sum"), F.sum("bike_count"), 1).alias("avg_bikes"),
            F.max("peak").alias("peak_bikes"),
            F.min("trough").alias("trough_bikes"),
        )
        .filter(F.col("observations") >= min_obs)
        .orderBy(F.col("peak_bikes").desc_nulls_last(), "name")
        .limit(n)
    )


def stranding(status: DataFrame, stations: DataFrame, min_obs: int = 5, n: int = 15) -> DataFrame:
    """Share of observations without bikes or docks, worst stations first."""
    seen = F.sum("observations")
    return (
        _by_name(status, stations)
        .agg(
            seen.alias("observations"),
            ratio(F.sum("no_bikes"), seen, 1, scale=100).alias("pct_no_bikes"),
            ratio(F.sum("no_docks"), seen, 1, scale=100).alias("pct_no_docks"),
        )
        .filter(F.col("observations") >= min_obs)
        .orderBy(F.col("pct_no_bikes").desc_nulls_last(), "name")
        .limit(n)
    )


def ebike_share(status: DataFrame, n: int = 24) -> DataFrame:
    """E-bikes as a share of available bikes, newest ``n`` hours."""
    return (
        status.groupBy(_hour_start())
        .agg(
            F.sum(BIKES).alias("bikes"),
            F.sum(EBIKES).alias("ebikes"),
            ratio(F.sum(EBIKES), F.sum(BIKES), 1, scale=100).alias("pct_electric"),
        )
        .orderBy(F.col("hour_utc").desc_nulls_last())
        .limit(n)
    )


def out_of_service(status: DataFrame, n: int = 24) -> DataFrame:
    """Disabled bikes and docks and closed station polls, newest ``n`` hours."""
    return (
        status.groupBy(_hour_start())
        .agg(
            F.sum("num_bikes_disabled").alias("bikes_disabled"),
            F.sum("num_docks_disabled").alias("docks_disabled"),
            F.count_if(~F.col("is_renting")).alias("station_polls_not_renting"),
            F.count_if(~F.col("is_returning")).alias("station_polls_not_returning"),
        )
        .orderBy(F.col("hour_utc").desc_nulls_last())
        .limit(n)
    )


def pressure(status: DataFrame, stations: DataFrame) -> DataFrame:
    """Stranding shares per station with their difference, placed on the map."""
    per_key = status.groupBy("station_key").agg(
        _rows().alias("observations"),
        F.count_if(F.col(BIKES) == 0).alias("no_bikes"),
        F.count_if(F.col(DOCKS) == 0).alias("no_docks"),
    )
    seen = F.col("observations")
    return per_key.join(stations.select("station_key", "name", "lon", "lat"), "station_key").select(
        "station_key", "name", "lon", "lat", "observations",
        ratio(F.col("no_bikes"), seen, 1, scale=100).alias("pct_no_bikes"),
        ratio(F.col("no_docks"), seen, 1, scale=100).alias("pct_no_docks"),
        ratio(F.col("no_docks") - F.col("no_bikes"), seen, 1, scale=100).alias("net"),
    )


def trip_hours(trips: DataFrame) -> DataFrame:
    """Trips by hour of day (UTC) and source."""
    return trips.groupBy(F.hour("started_at").alias("hour_utc"), "source").agg(
        _rows().alias("trips"),
        half_up(F.avg("duration_s")).alias("avg_seconds"),
        half_up(F.avg("meters")).alias("avg_meters"),
    )


def trip_pairs(trips: DataFrame, stations: DataFrame, n: int = 20) -> DataFrame:
    """Busiest routes by pair of station names."""
    pairs = trips.groupBy("start_station_key", "end_station_key").agg(
        _rows().alias("trips"),
        F.sum("duration_s").alias("seconds"),
        F.count("duration_s").alias("timed"),
    )
    a = stations.select(F.col("station_key").alias("start_station_key"), F.col("name").alias("from_station"))
    b = stations.select(F.col("station_key").alias("end_station_key"), F.col("name").alias("to_station"))
    return (
        pairs.join(a, "start_station_key")
        .join(b, "end_station_key")
        .groupBy("from_station", "to_station")
        .agg(
            F.sum("trips").alias("trips"),
            ratio(F.sum("seconds"), F.sum("timed"), 0).alias("avg_seconds"),
        )
        .orderBy(F.col("trips").desc_nulls_last(), "from_station", "to_station")
        .limit(n)
    )


def rider_mix(trips: DataFrame) -> DataFrame:
    """Trips by rider and bike type with their share of all trips."""
    counted = trips.groupBy("member_casual", "rideable_type").agg(
        _rows().alias("trips"),
        half_up(F.avg("duration_s")).alias("avg_seconds"),
        half_up(F.avg("meters")).alias("avg_meters"),
    )
    # The window sees one row per rider and bike type, never the trips.
    everything = F.sum("trips").over(Window.partitionBy(F.lit(0)))
    return counted.withColumn("pct", ratio(F.col("trips"), everything, 1, scale=100))


def od_pairs(
    trips: DataFrame, as_of: AsOf, hours: float = 24, min_trips: int = 2, n: int = 600
) -> DataFrame:
    """Most used origin-destination pairs of the last ``hours``."""
    recent = F.col("started_at") > instant(as_of) - span(hours * 3600)
    return (
        trips.filter(recent)
        .groupBy("start_station_key", "end_station_key")
        .agg(_rows().alias("trips"))
        .filter(F.col("trips") >= min_trips)
        .orderBy(F.col("trips").desc_nulls_last(), "start_station_key", "end_station_key")
        .limit(n)
    )


def ingest_buckets(status: DataFrame, as_of: AsOf, hours: float = 6, minutes: int = 10) -> DataFrame:
    """Rows that arrived per ``minutes`` over the last ``hours``."""
    return (
        status.filter(F.col("polled_at") > instant(as_of) - span(hours * 3600))
        .groupBy(time_bucket(F.col("polled_at"), minutes).alias("bucket"))
        .agg(_rows().alias("rows"))
        .withColumn("at", F.date_format("bucket", "HH:mm"))
    )


def system_level(status: DataFrame, as_of: AsOf, hours: float = 6) -> DataFrame:
    """All docked bikes per snapshot over the last ``hours``."""
    return (
        status.filter(F.col("polled_at") > instant(as_of) - span(hours * 3600))
        .groupBy("polled_at")
        .agg(F.sum(BIKES).alias("bikes"))
        .withColumn("at", F.date_format("polled_at", "HH:mm"))
    )


def fleet_hour_spine(status: DataFrame) -> DataFrame:
    """Average bikes for each of the 24 hours, 0 where nothing was seen."""
    spine = status.sparkSession.range(24).select(F.col("id").cast("int").alias("h"))
    seen = status.groupBy(F.hour("polled_at").alias("h")).agg(mean(F.col(BIKES), 2).alias("bikes"))
    return spine.join(seen, "h", "left").select(
        F.lpad(F.col("h").cast("string"), 2, "0").alias("hour"),
        F.coalesce("bikes", F.lit(0.0)).alias("bikes"),
    )


# Fixed labels and upper limits (percent, exclusive) of the dry-share bands.
DRY_BANDS = [("under 5%", 5), ("5–20%", 20), ("20–50%", 50), ("50–99%", 100)]


def dry_distribution(status: DataFrame, min_obs: int = 10) -> DataFrame:
    """Stations by how often they had no bike to give."""
    per_key = (
        status.groupBy("station_key")
        .agg(_rows().alias("n"), F.count_if(F.col(BIKES) == 0).alias("dry"))
        .filter(F.col("n") >= min_obs)
    )
    # dry / n < limit % compared without a division
    label = F.when(F.col("dry") == 0, "never")
    place = F.when(F.col("dry") == 0, 1)
    for i, (name, limit) in enumerate(DRY_BANDS):
        below = F.col("dry") * 100 < F.col("n") * limit
        label, place = label.when(below, name), place.when(below, i + 2)
    return per_key.groupBy(
        label.otherwise("always").alias("bucket"), place.otherwise(6).alias("ord")
    ).agg(_rows().alias("stations"))


def weekday_weekend(
    trips: DataFrame, as_of: AsOf, tz: str = "America/New_York", days: float = 7
) -> DataFrame:
    """Trips by local hour, weekdays against weekends, over the last ``days``."""
    local = utc_to_local(F.col("started_at"), tz)
    return (
        trips.filter(F.col("started_at") > instant(as_of) - span(days * 86400))
        .groupBy(F.lpad(F.hour(local).cast("string"), 2, "0").alias("hour"))
        .agg(
            F.count_if(iso_weekday(local) < 6).alias("weekday"),
            F.count_if(iso_weekday(local) >= 6).alias("weekend"),
        )
    )


# Fixed labels and upper limits (seconds, exclusive) of the trip-length bands.
DURATION_BANDS = [("0–5", 300), ("5–10", 600), ("10–15", 900), ("15–30", 1800), ("30–60", 3600)]


def duration_hist(trips: DataFrame, as_of: AsOf, days: float = 7) -> DataFrame:
    """Trips by length in minutes over the last ``days``."""
    label, place = F.when(F.lit(False), ""), F.when(F.lit(False), 0)
    for i, (name, limit) in enumerate(DURATION_BANDS):
        below = F.col("duration_s") < limit
        label, place = label.when(below, name), place.when(below, i + 1)
    return (
        trips.filter(F.col("started_at") > instant(as_of) - span(days * 86400))
        .groupBy(label.otherwise("60+").alias("bucket"), place.otherwise(6).alias("ord"))
        .agg(_rows().alias("trips"))
    )


def hour_rollup(status: DataFrame, n: int = 24) -> DataFrame:
    """Observations, bikes and e-bikes of the newest ``n`` hours."""
    return (
        status.groupBy(F.date_trunc("hour", "polled_at").alias("hour"))
        .agg(
            _rows().alias("observations"),
            F.sum(BIKES).alias("bikes"),
            F.sum(EBIKES).alias("ebikes"),
        )
        .orderBy(F.col("hour").desc_nulls_last())
        .limit(n)
    )


def count_all(df: DataFrame) -> DataFrame:
    return df.agg(_rows().alias("snapshots"))


def observations_by_station(status: DataFrame, stations: DataFrame, n: int = 10) -> DataFrame:
    """Stations with the most observations."""
    return (
        _by_name(status, stations)
        .agg(
            F.sum("observations").alias("observations"),
            ratio(F.sum("bike_sum"), F.sum("bike_count"), 1).alias("avg_bikes"),
        )
        .orderBy(F.col("observations").desc_nulls_last(), "name")
        .limit(n)
    )


def log_summary(log: DataFrame) -> DataFrame:
    """Roll up a query log with ``kind``, ``engine`` (remote/local), ``ms`` and ``crossed``."""
    agg = F.col("kind") == "agg"
    remote, local = agg & (F.col("engine") == "remote"), agg & (F.col("engine") == "local")
    ms = F.col("ms").cast("decimal(18,3)")

    def total_ms(which: Column) -> Column:
        return F.round(F.coalesce(F.sum(F.when(which, ms)), F.lit(0)), 1).cast("double")

    return log.agg(
        _rows().alias("total"),
        F.count_if(agg).alias("aggregates"),
        F.count_if(remote).alias("pushed_down"),
        F.count_if(local).alias("run_locally"),
        total_ms(remote).alias("ms_remote"),
        total_ms(local).alias("ms_local"),
        F.sum(F.coalesce(F.col("crossed").cast("bigint"), F.lit(0))).alias("rows_crossed"),
    )
