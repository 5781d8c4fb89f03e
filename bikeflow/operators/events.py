"""Dock-level snapshots to departure and arrival events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bikeflow.functions.clock import instant, seconds_between, span
from bikeflow.functions.numbers import ratio, unit_draw
from bikeflow.plans.segments import with_previous

LEVEL = "num_bikes_available"


def snapshot_deltas(
    status: DataFrame,
    key: str = "station_key",
    ts: str = "polled_at",
    level: str = LEVEL,
    tiebreak: str = "status_id",
    max_rows: int | None = None,
) -> DataFrame:
    """Change of ``level`` and seconds since the preceding snapshot of the same key.

    Both lags come from one shuffle and one sort; hot keys are cut into segments
    (see ``plans.segments``), which costs a count up front.
    """
    kept = status.select(key, ts, tiebreak, level)
    seen = with_previous(
        kept, [key], [ts, tiebreak], {"_level": level, "_ts": ts}, max_rows
    )
    return seen.select(
        key, ts, tiebreak, level,
        (F.col(level) - F.col("_level")).alias("delta"),
        seconds_between(F.col(ts), F.col("_ts")).alias("gap_seconds"),
    )


def _departed() -> Column:
    return F.sum(F.when(F.col("delta") < 0, -F.col("delta")).otherwise(0))


def _arrived() -> Column:
    return F.sum(F.when(F.col("delta") > 0, F.col("delta")).otherwise(0))


def _plausible(max_gap: float) -> Column:
    """A real delta over a gap short enough to be one event."""
    return F.col("delta").isNotNull() & (F.col("gap_seconds") < max_gap)


def hourly_flows(
    status: DataFrame, max_gap: float = 180, rebalance: int = 5, n: int = 24, max_rows: int | None = None
) -> DataFrame:
    """Departures, arrivals and likely truck moves of the newest ``n`` hours."""
    return (
        snapshot_deltas(status, max_rows=max_rows)
        .filter(_plausible(max_gap))
        .groupBy(F.date_trunc("hour", "polled_at").alias("hour_utc"))
        .agg(
            _departed().alias("bikes_departed"),
            _arrived().alias("bikes_arrived"),
            F.count_if(F.abs("delta") >= rebalance).alias("likely_rebalance_events"),
        )
        .orderBy(F.col("hour_utc").desc_nulls_last())
        .limit(n)
    )


def station_flows(
    status: DataFrame, stations: DataFrame, max_gap: float = 180, n: int = 15, max_rows: int | None = None
) -> DataFrame:
    """Stations by derived departures, with arrivals and net drain."""
    per_key = (
        snapshot_deltas(status, max_rows=max_rows)
        .filter(_plausible(max_gap))
        .groupBy("station_key")
        .agg(_departed().alias("out"), _arrived().alias("in"))
    )
    return (
        per_key.join(stations.select("station_key", "name"), "station_key")
        .groupBy("name")
        .agg(F.sum("out").alias("departed"), F.sum("in").alias("arrived"))
        .withColumn("net_drain", F.col("departed") - F.col("arrived"))
        .orderBy(F.col("departed").desc_nulls_last(), "name")
        .limit(n)
    )


def total_departures(status: DataFrame, max_rows: int | None = None) -> DataFrame:
    """All downward movement, whatever the gap."""
    return snapshot_deltas(status, max_rows=max_rows).agg(_departed().alias("departed"))


def _first_deltas(status: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows by station and ``order``, each with its ``delta`` to the row before it.

    A row's predecessor stands right before it in this order, so the first rows hold all they need, and
    the facts are cut to ``n`` rows before anything is shuffled.
    """
    first = status.select("station_key", "polled_at", "status_id", LEVEL).orderBy("station_key", *order).limit(n)
    before = F.lag(LEVEL).over(Window.partitionBy("station_key").orderBy(*order))
    return first.withColumn("delta", F.col(LEVEL) - before).orderBy("station_key", *order)


def delta_listing(status: DataFrame, n: int = 200) -> DataFrame:
    """First ``n`` deltas by station and time."""
    listed = _first_deltas(status, n, ["polled_at", "status_id"])
    return listed.select("station_key", "polled_at", LEVEL, "delta")


def delta_by_level(status: DataFrame, n: int = 200) -> DataFrame:
    """Deltas between rows ordered by level instead of time, ties in time order."""
    listed = _first_deltas(status, n, [LEVEL, "polled_at", "status_id"])
    return listed.select("station_key", LEVEL, "delta")


def flow_balance(status: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Gross flows, their balance and the daily departure rate they imply."""
    totals = snapshot_deltas(status, max_rows=max_rows).agg(
        _departed().alias("gross_out"),
        _arrived().alias("gross_in"),
        (F.unix_micros(F.max("polled_at")) - F.unix_micros(F.min("polled_at"))).alias("covered"),
    )
    covered_s = F.call_function("div", F.col("covered"), F.lit(1_000_000))
    return totals.select(
        "gross_out", "gross_in",
        (F.col("gross_in") - F.col("gross_out")).alias("net"),
        ratio(covered_s, F.lit(3600), 1).alias("covered_hours"),
        ratio(F.col("gross_out"), covered_s, 0, scale=86400).alias("implied_per_day"),
    )


def departures(
    status: DataFrame,
    since: Column | dt.datetime | str | None = None,
    lookback_s: float = 120,
    cap: int = 8,
    max_rows: int | None = None,
) -> DataFrame:
    """Bikes that left per snapshot after ``since``, clamped to ``cap``.

    Rows up to ``lookback_s`` before the mark only provide the previous level. The
    mark compares with ``polled_at``, so a repeated run yields nothing twice.
    """
    rows = status
    if since is not None:
        rows = rows.filter(F.col("polled_at") > instant(since) - span(lookback_s))
    out = snapshot_deltas(rows, max_rows=max_rows).filter(F.col("delta") < 0)
    if since is not None:
        out = out.filter(F.col("polled_at") > instant(since))
    return out.select(
        "station_key", "polled_at", "status_id", F.least(-F.col("delta"), F.lit(cap)).alias("n")
    )


def explode_count(df: DataFrame, n: str = "n", alias: str = "unit") -> DataFrame:
    """Repeat each row ``n`` times, numbered from 1; rows with ``n`` < 1 vanish."""
    return df.filter(F.col(n) >= 1).withColumn(alias, F.explode(F.sequence(F.lit(1), F.col(n))))


def thin(df: DataFrame, key: list[str], p: float = 0.55, salt: str = "keep") -> DataFrame:
    """Keep the share ``p`` of the rows, chosen by a deterministic draw on ``key``."""
    return df.filter(unit_draw(F.lit(salt), *key) < p)
