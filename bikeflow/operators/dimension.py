"""Keeping the dimension and the fact table current."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bikeflow.functions.clock import instant, span
from bikeflow.functions.geo import has_point, point
from bikeflow.plans.segments import row_numbers
from bikeflow.sources.schemas import STATUS_COUNTS, STATUS_FLAGS

STATION_COLUMNS = ["station_id", "name", "short_name", "lat", "lon", "capacity", "region_id"]


def with_point(df: DataFrame) -> DataFrame:
    """Add ``geom`` from lon/lat; rows with a zero or missing coordinate are dropped."""
    return df.filter(has_point(F.col("lon"), F.col("lat"))).withColumn(
        "geom", point(F.col("lon"), F.col("lat"))
    )


def number_after(
    rows: DataFrame, order: Sequence[str], alias: str, start: Column, max_rows: int | None = None
) -> DataFrame:
    """Number ``rows`` densely in ``order``, continuing after ``start`` (null counts as 0)."""
    numbered = row_numbers(rows, order, "_n", max_rows=max_rows)
    first = F.coalesce(start, F.lit(0).cast("bigint"))
    return numbered.withColumn(alias, first + F.col("_n")).drop("_n")


def assign_keys(dim: DataFrame, incoming: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``station_id`` to ``station_key``: known ids keep their key, new ids are numbered on."""
    known = dim.select("station_id", "station_key")
    new = incoming.select("station_id").distinct().join(known, "station_id", "left_anti")
    highest = dim.select(F.max("station_key")).scalar()
    return known.unionByName(number_after(new, ["station_id"], "station_key", highest, max_rows))


def upsert_stations(dim: DataFrame, incoming: DataFrame, max_rows: int | None = None) -> DataFrame:
    """The dimension after a new station list, with ``_change``: insert, update or same.

    Name, capacity and position follow the list where they differ; the other columns
    keep what they had. Stations absent from the list stay. Rows without a usable
    position are ignored. Write only rows whose ``_change`` is not ``same``.
    """
    fields = [F.col(c).alias("n_" + c) for c in STATION_COLUMNS[1:]]
    # Of repeated ids the greatest row counts, so that every use below sees the same one.
    fresh = (
        incoming.filter(has_point(F.col("lon"), F.col("lat")))
        .groupBy("station_id")
        .agg(F.max(F.struct(*fields)).alias("_r"))
        .select("station_id", "_r.*")
    )
    known = dim.select("station_key", *STATION_COLUMNS)
    # Merged, not broadcast: a broadcast would read the list by the tasks that wrote it, which is one for a single file.
    arrived = fresh.join(known.select("station_id").hint("merge"), "station_id", "left_anti")
    highest = dim.select(F.max("station_key")).scalar()
    inserts = number_after(arrived, ["station_id"], "station_key", highest, max_rows)

    moving = ["name", "capacity", "lat", "lon"]
    differs = F.lit(False)
    for c in moving:
        differs = differs | ~F.col(c).eqNullSafe(F.col("n_" + c))
    flagged = known.join(fresh.withColumn("_listed", F.lit(True)), "station_id", "left")
    change = F.when(F.col("_listed") & differs, "update").otherwise("same")
    kept = flagged.withColumn("_change", change).select(
        "station_key",
        "station_id",
        *[
            F.when((F.col("_change") == "update") & F.lit(c in moving), F.col("n_" + c))
            .otherwise(F.col(c))
            .alias(c)
            for c in STATION_COLUMNS[1:]
        ],
        "_change",
    )
    added = inserts.select(
        "station_key",
        "station_id",
        *[F.col("n_" + c).alias(c) for c in STATION_COLUMNS[1:]],
        F.lit("insert").alias("_change"),
    )
    return kept.unionByName(added)


def high_water_mark(fact: DataFrame) -> Column:
    """Newest ``polled_at`` of the fact table, 1970-01-01 when it is empty."""
    return F.coalesce(
        fact.select(F.max("polled_at")).scalar(), F.lit("1970-01-01 00:00:00").cast("timestamp")
    )


Facts = DataFrame | Column | dt.datetime | str | None


def _newer(fact: Facts, landing: DataFrame) -> DataFrame:
    mark = high_water_mark(fact) if isinstance(fact, DataFrame) else instant("1970-01-01 00:00:00" if fact is None else fact)
    return landing.filter(F.col("polled_at") > mark)


def incremental_load(fact: Facts, landing: DataFrame, dim: DataFrame) -> DataFrame:
    """Landing rows newer than the fact table, keyed and typed for appending to it.

    ``fact`` is the table, or its newest instant where that is known from metadata (None for an empty one): the facts are
    then not read.
    """
    return as_facts(_newer(fact, landing).join(dim.select("station_id", "station_key"), "station_id"))


def as_facts(keyed: DataFrame) -> DataFrame:
    """Landing rows that have their ``station_key``, typed for the fact table."""
    return keyed.select(
        "station_key", "polled_at", "last_reported",
        *STATUS_COUNTS,
        *[F.col(c).cast("boolean").alias(c) for c in STATUS_FLAGS],
    )


def keyed_landing(fact: Facts, landing: DataFrame, dim: DataFrame) -> DataFrame:
    """Newer landing rows with ``station_key``, null where the dimension does not know the station.

    The rows of ``incremental_load`` and ``unmatched_landing`` from one join.
    """
    return _newer(fact, landing).join(dim.select("station_id", "station_key"), "station_id", "left")


def unmatched_landing(fact: Facts, landing: DataFrame, dim: DataFrame) -> DataFrame:
    """Newer landing rows of stations the dimension does not know yet.

    The mark moves past them, so a caller that wants them later keeps them.
    """
    return _newer(fact, landing).join(dim.select("station_id"), "station_id", "left_anti")


def operation_rank() -> Column:
    """Of changes with one version the greatest rank counts."""
    return F.when(F.col("op") == "D", 2).when(F.col("op") == "U", 1).otherwise(0)


def apply_cdc(base: DataFrame, changes: DataFrame, key: str = "station_key", ver: str = "ver") -> DataFrame:
    """``base`` after its change rows: highest version per key, deleted keys gone.

    ``changes`` has the columns of ``base`` plus ``ver`` and ``op`` (I, U, D). Of equal versions a
    delete counts before an update, an update before an insert, then the greatest row.
    """
    columns = [c for c in base.columns if c != key]
    start = base.select(key, *columns).withColumn(ver, F.lit(-1).cast("bigint")).withColumn("op", F.lit("I"))
    rows = start.unionByName(changes.select(key, *columns, F.col(ver).cast("bigint").alias(ver), "op"))
    newest = rows.groupBy(key).agg(
        F.max_by(F.struct(*columns, "op"), F.struct(F.col(ver), operation_rank().alias("_rank"), *columns)).alias("_r")
    )
    return newest.filter(F.col("_r.op") != "D").select(key, *[F.col("_r." + c).alias(c) for c in columns])


def retain(df: DataFrame, ts: str, days: float, as_of: Column | dt.datetime | str) -> DataFrame:
    """Rows not older than ``days`` before ``as_of``."""
    return df.filter(F.col(ts) >= instant(as_of) - span(days * 86400))


def collapse_landing(landing: DataFrame) -> DataFrame:
    """One row per ``(polled_at, station_id)``; of differing copies the greatest row stays."""
    keys = ["polled_at", "station_id"]
    rest = [c for c in landing.columns if c not in keys]
    return (
        landing.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_r")).select(*keys, "_r.*")
    )


def landing_summary(landing: DataFrame) -> DataFrame:
    """Rows, distinct snapshots and stations, and the time range of the landing table."""
    return landing.agg(
        F.count(F.lit(1)).alias("status_rows"),
        F.count_distinct("polled_at").alias("snapshots"),
        F.count_distinct("station_id").alias("stations"),
        F.min("polled_at").alias("first"),
        F.max("polled_at").alias("last"),
    )
