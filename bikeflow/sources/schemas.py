"""Explicit schemas. Feed JSON is never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

STATUS_COUNTS = [
    "num_bikes_available",
    "num_ebikes_available",
    "num_docks_available",
    "num_bikes_disabled",
    "num_docks_disabled",
]
STATUS_FLAGS = ["is_installed", "is_renting", "is_returning"]

STATUS_DOCUMENT = T.StructType(
    [
        T.StructField("last_updated", T.LongType()),
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField(
                        "stations",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField("station_id", T.StringType()),
                                    T.StructField("last_reported", T.LongType()),
                                    *[T.StructField(c, T.IntegerType()) for c in STATUS_COUNTS],
                                    *[T.StructField(c, T.IntegerType()) for c in STATUS_FLAGS],
                                ]
                            )
                        ),
                    )
                ]
            ),
        ),
    ]
)

STATION_DOCUMENT = T.StructType(
    [
        T.StructField("last_updated", T.LongType()),
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField(
                        "stations",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField("station_id", T.StringType()),
                                    T.StructField("name", T.StringType()),
                                    T.StructField("short_name", T.StringType()),
                                    T.StructField("lat", T.DoubleType()),
                                    T.StructField("lon", T.DoubleType()),
                                    T.StructField("capacity", T.IntegerType()),
                                    T.StructField("region_id", T.StringType()),
                                ]
                            )
                        ),
                    )
                ]
            ),
        )
    ]
)

FEED_LIST = T.ArrayType(
    T.StructType([T.StructField("name", T.StringType()), T.StructField("url", T.StringType())])
)
# A discovery document lists its feeds per language, or directly under ``data``.
DISCOVERY_BY_LANGUAGE = T.StructType(
    [
        T.StructField(
            "data",
            T.MapType(T.StringType(), T.StructType([T.StructField("feeds", FEED_LIST)])),
        )
    ]
)
DISCOVERY_FLAT = T.StructType(
    [T.StructField("data", T.StructType([T.StructField("feeds", FEED_LIST)]))]
)

TRIP_ARCHIVE = T.StructType(
    [
        T.StructField("started_at", T.TimestampType()),
        T.StructField("ended_at", T.TimestampType()),
        T.StructField("start_station_id", T.StringType()),
        T.StructField("end_station_id", T.StringType()),
        T.StructField("start_lat", T.DoubleType()),
        T.StructField("start_lng", T.DoubleType()),
        T.StructField("end_lat", T.DoubleType()),
        T.StructField("end_lng", T.DoubleType()),
        T.StructField("member_casual", T.StringType()),
    ]
)

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
