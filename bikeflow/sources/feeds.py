"""Feed documents to rows. Input frames hold one JSON text per row in ``json``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bikeflow.sources.schemas import (
    DISCOVERY_BY_LANGUAGE,
    DISCOVERY_FLAT,
    STATION_DOCUMENT,
    STATUS_COUNTS,
    STATUS_DOCUMENT,
    STATUS_FLAGS,
)


def _or_zero(column: Column, kind: str) -> Column:
    return F.coalesce(column, F.lit(0)).cast(kind)


def parse_status(docs: DataFrame) -> DataFrame:
    """One row per station per status document; absent fields become 0 or ''."""
    parsed = docs.select(F.from_json("json", STATUS_DOCUMENT).alias("doc"))
    rows = parsed.select(
        F.col("doc.last_updated").alias("last_updated"), F.explode("doc.data.stations").alias("s")
    )
    return rows.select(
        F.timestamp_seconds(F.coalesce("last_updated", F.lit(0))).alias("polled_at"),
        F.coalesce("s.station_id", F.lit("")).alias("station_id"),
        F.timestamp_seconds(F.coalesce("s.last_reported", F.lit(0))).alias("last_reported"),
        *[_or_zero(F.col(f"s.{c}"), "int").alias(c) for c in STATUS_COUNTS + STATUS_FLAGS],
    )


def document_summary(docs: DataFrame) -> DataFrame:
    """Number of status documents and of those that give no list of stations, broken ones included."""
    stations = F.from_json("json", STATUS_DOCUMENT)["data"]["stations"]
    return docs.agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(stations.isNull()).alias("unreadable")
    )


def parse_stations(docs: DataFrame) -> DataFrame:
    """One row per station of a station list; absent fields become 0 or ''."""
    return dated_stations(docs).drop("last_updated")


def dated_stations(docs: DataFrame) -> DataFrame:
    """``parse_stations`` with the ``last_updated`` of the list (0 when absent)."""
    rows = docs.select(F.from_json("json", STATION_DOCUMENT).alias("doc")).select(
        F.col("doc.last_updated").alias("last_updated"), F.explode("doc.data.stations").alias("s")
    )
    return rows.select(
        F.coalesce("last_updated", F.lit(0)).alias("last_updated"),
        F.coalesce("s.station_id", F.lit("")).alias("station_id"),
        F.coalesce("s.name", F.lit("")).alias("name"),
        F.coalesce("s.short_name", F.lit("")).alias("short_name"),
        _or_zero(F.col("s.lat"), "double").alias("lat"),
        _or_zero(F.col("s.lon"), "double").alias("lon"),
        _or_zero(F.col("s.capacity"), "int").alias("capacity"),
        F.coalesce("s.region_id", F.lit("")).alias("region_id"),
    )


def feed_catalog(docs: DataFrame, name: str | None = None, language: str = "en") -> DataFrame:
    """Feeds of discovery documents, as ``language``, ``name``, ``url``.

    With ``name``, only that feed: from ``language`` where the document has it, else
    from feeds listed directly under ``data``.
    """
    parsed = docs.select(
        F.from_json("json", DISCOVERY_BY_LANGUAGE).alias("by_language"),
        F.from_json("json", DISCOVERY_FLAT)["data"]["feeds"].alias("flat"),
    ).select(F.col("by_language.data").alias("languages"), "flat")
    # The key "feeds" of a flat document is not a language.
    entries = F.when(
        F.col("flat").isNotNull(),
        F.array(F.struct(F.lit("").alias("key"), F.col("flat").alias("feeds"))),
    ).otherwise(
        F.transform(
            F.map_entries("languages"),
            lambda e: F.struct(e["key"].alias("key"), e["value"]["feeds"].alias("feeds")),
        )
    )
    listed = parsed.select(F.explode(entries).alias("entry")).select(
        F.col("entry.key").alias("language"), F.explode("entry.feeds").alias("feed")
    )
    rows = listed.select("language", F.col("feed.name").alias("name"), F.col("feed.url").alias("url"))
    if name is None:
        return rows
    return rows.filter((F.col("name") == name) & F.col("language").isin(language, ""))
