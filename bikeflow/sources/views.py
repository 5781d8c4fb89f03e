"""The driver's tables seen as bike-share data (bindings for tests and benchmarks)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bikeflow.sources.schemas import STATUS_COUNTS, STATUS_FLAGS

DOCUMENT_STATIONS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def status_of(events: DataFrame) -> DataFrame:
    bikes = F.floor("value").cast("int") % 31
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        F.col("event_id").alias("status_id"),
        F.col("user_id").alias("station_key"),
        F.col("ts").cast("timestamp").alias("polled_at"),
        F.timestamp_seconds(F.unix_seconds(F.col("ts").cast("timestamp"))).alias("last_reported"),
        bikes.alias("num_bikes_available"),
        F.floor(bikes / 3).cast("int").alias("num_ebikes_available"),
        (F.lit(30) - bikes).alias("num_docks_available"),
        (k % 4).alias("num_bikes_disabled"),
        (k % 3).alias("num_docks_disabled"),
        F.lit(True).alias("is_installed"),
        (F.col("event_type") != "error").alias("is_renting"),
        (F.col("event_type") != "signup").alias("is_returning"),
        "event_type",
        k.alias("k"),
        "value",
    )


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_of(table(spark, sf_dir, "events"))


def _spread(a: int, b: int, modulus: int) -> Column:
    c = F.col("c_custkey")
    return ((F.lit(a) * c * c + F.lit(b) * c) % modulus).cast("double") / F.lit(float(modulus))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    u, v = _spread(31, 7919, 10007), _spread(37, 104729, 10009)
    return table(spark, sf_dir, "customer").select(
        c.alias("station_key"),
        F.concat(F.lit("S"), c.cast("string")).alias("station_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("N"), c.cast("string")).alias("short_name"),
        (F.lit(40.60) + F.lit(0.25) * u * u).alias("lat"),
        (F.lit(-74.05) + F.lit(0.25) * v * v).alias("lon"),
        F.when(c % 17 != 0, (F.lit(20) + c % 40).cast("int")).alias("capacity"),
        F.col("c_nationkey").cast("string").alias("region_id"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.timestamp_seconds(
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")) + (F.col("l_partkey") * 37) % 86400
    )
    seconds = F.lit(60) + F.floor("l_extendedprice").cast("int") % 3600
    return table(spark, sf_dir, "lineitem").select(
        start.alias("started_at"),
        F.timestamp_seconds(F.unix_seconds(start) + seconds).alias("ended_at"),
        F.col("l_suppkey").alias("start_station_key"),
        (F.col("l_partkey") % 150).alias("end_station_key"),
        seconds.alias("duration_s"),
        (F.col("l_quantity") * 100).alias("meters"),
        F.when(F.col("l_linestatus") == "F", "electric_bike").otherwise("classic_bike").alias("rideable_type"),
        F.when(F.col("l_discount") < 0.05, "member").otherwise("casual").alias("member_casual"),
        F.when(F.col("l_returnflag") == "A", "modelled").otherwise("observed").alias("source"),
    )


def status_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status documents by hour, at most ``DOCUMENT_STATIONS`` rows each."""
    rows = status(spark, sf_dir).select(
        F.unix_seconds(F.date_trunc("hour", "polled_at")).alias("last_updated"),
        F.call_function("div", F.col("status_id"), F.lit(DOCUMENT_STATIONS)).alias("part"),
        F.struct(
            F.concat(F.lit("S"), F.col("station_key").cast("string")).alias("station_id"),
            F.unix_seconds("last_reported").alias("last_reported"),
            *STATUS_COUNTS,
            *[F.col(c).cast("int").alias(c) for c in STATUS_FLAGS],
        ).alias("s"),
    )
    return rows.groupBy("last_updated", "part").agg(F.collect_list("s").alias("stations")).select(
        F.to_json(F.struct("last_updated", F.struct("stations").alias("data"))).alias("json")
    )


def station_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station-list documents of at most ``DOCUMENT_STATIONS`` entries; null fields stay absent."""
    rows = stations(spark, sf_dir).select(
        F.call_function("div", F.col("station_key"), F.lit(DOCUMENT_STATIONS)).alias("part"),
        F.struct("station_id", "name", "short_name", "lat", "lon", "capacity", "region_id").alias("s"),
    )
    return rows.groupBy("part").agg(F.collect_list("s").alias("stations")).select(
        F.to_json(F.struct(F.lit(1).alias("last_updated"), F.struct("stations").alias("data"))).alias("json")
    )


def discovery_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One discovery document per page: two languages, or feeds directly under ``data``."""
    feeds = F.array(
        F.struct(F.lit("station_status").alias("name"), F.concat("url", F.lit("/status")).alias("url")),
        F.struct(F.lit("station_information").alias("name"), F.concat("url", F.lit("/stations")).alias("url")),
    )
    nested = F.to_json(
        F.struct(
            F.struct(
                F.struct(feeds.alias("feeds")).alias("en"), F.struct(feeds.alias("feeds")).alias("fr")
            ).alias("data")
        )
    )
    flat = F.to_json(F.struct(F.struct(feeds.alias("feeds")).alias("data")))
    return table(spark, sf_dir, "pages").select(
        F.when(F.col("page_id") % 3 == 0, flat).otherwise(nested).alias("json")
    )


def incoming_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later station list: renamed, resized, moved, unplaced and new stations."""
    base = stations(spark, sf_dir)
    c = F.col("station_key")
    changed = base.select(
        "station_id",
        F.when(c % 5 == 0, F.concat("name", F.lit(" (new)"))).otherwise(F.col("name")).alias("name"),
        F.concat("short_name", F.lit("x")).alias("short_name"),
        F.when(c % 13 == 0, 0.0).when(c % 11 == 0, F.col("lat") + 0.001).otherwise(F.col("lat")).alias("lat"),
        "lon",
        F.when(c % 7 == 0, F.lit(99)).otherwise(F.col("capacity")).alias("capacity"),
        F.lit("moved").alias("region_id"),
    )
    added = changed.filter(c % 10 == 0).withColumn("station_id", F.concat(F.lit("T"), "station_id"))
    return changed.unionByName(added)


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change rows of the dimension: every station in, some updated twice, some deleted."""
    base = stations(spark, sf_dir).select("station_key", "name", "capacity")
    c = F.col("station_key")

    def version(rows: DataFrame, ver: int, op: str, name: Column) -> DataFrame:
        return rows.select(
            "station_key", name.alias("name"), "capacity",
            F.lit(ver).cast("bigint").alias("ver"), F.lit(op).alias("op"),
        )

    return (
        version(base, 1, "I", F.col("name"))
        .unionByName(version(base.filter(c % 3 == 0), 2, "U", F.concat("name", F.lit(" v2"))))
        .unionByName(version(base.filter(c % 6 == 0), 3, "U", F.concat("name", F.lit(" v3"))))
        .unionByName(version(base.filter(c % 10 == 0), 4, "D", F.col("name")))
    )
