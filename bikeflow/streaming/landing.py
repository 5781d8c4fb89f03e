"""Feed documents into the landing table, the dimension and the fact table.

Output is keyed by the micro-batch number and overwritten when a batch is repeated after a
failure, so every job can be restarted from its checkpoint.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from bikeflow.operators.dimension import (
    as_facts,
    collapse_landing,
    incremental_load,
    keyed_landing,
    upsert_stations,
)
from bikeflow.plans.runtime import remove
from bikeflow.sources.feeds import parse_status
from bikeflow.sources.schemas import STATUS_COUNTS, STATUS_FLAGS
from bikeflow.streaming.mergelog import FAN, MergeLog

VALUES = ["last_reported timestamp", *[f"{c} int" for c in STATUS_COUNTS]]
FACTS = ", ".join(["station_key bigint", "polled_at timestamp", *VALUES, *[f"{c} boolean" for c in STATUS_FLAGS]])
WAITING = ", ".join(["station_id string", "polled_at timestamp", *VALUES, *[f"{c} int" for c in STATUS_FLAGS]])
STATIONS = (
    "station_key bigint, station_id string, name string, short_name string, lat double, lon double, capacity int, "
    "region_id string"
)
EVERY_MINUTE = {"processingTime": "1 minute"}
ONCE = {"availableNow": True}


def read_documents(
    spark: SparkSession, path: str, files_per_trigger: int = 1000, one_per_file: bool = True
) -> DataFrame:
    """Landed JSON files as a stream of documents in ``json``, bounded per batch.

    A file holds one document, or one per line when ``one_per_file`` is false.
    """
    return (
        spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
        .text(path, wholetext=one_per_file)
        .select(F.col("value").alias("json"))
    )


def _start(writer: DataStreamWriter, checkpoint: str, trigger: dict) -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def stream_append_status(
    docs: DataFrame, sink: str, checkpoint: str, dedup_within: str | None = None, trigger: dict = ONCE
) -> StreamingQuery:
    """Append every station row of the document stream to ``sink``, partitioned by day.

    ``dedup_within`` drops repeated ``(polled_at, station_id)`` in the stream already,
    with state for that long; rows later than that are then dropped too. Without it
    nothing is dropped, and ``read_landing`` collapses the repeats.
    """
    rows = parse_status(docs)
    if dedup_within:
        rows = rows.withWatermark("polled_at", dedup_within).dropDuplicatesWithinWatermark(
            ["polled_at", "station_id"]
        )
    writer = (
        rows.withColumn("day", F.to_date("polled_at"))
        .writeStream.format("parquet")
        .partitionBy("day")
        .option("path", sink)
        .outputMode("append")
    )
    return _start(writer, checkpoint, trigger)


def read_landing(spark: SparkSession, sink: str) -> DataFrame:
    """The landing table with one row per ``(polled_at, station_id)``."""
    return collapse_landing(spark.read.parquet(sink).drop("day"))


@dataclass(frozen=True)
class SyncTarget:
    """Folders of the dimension, the facts and the rows that wait for their station, each a log of the batches' changes.

    ``fan`` is the number of runs of a level that are merged into one.
    """

    spark: SparkSession
    path: str
    fan: int = FAN

    @property
    def station_log(self) -> MergeLog:
        schema = f"{STATIONS}, batch bigint, changed_at timestamp"
        return MergeLog(self.spark, f"{self.path}/stations", schema, ("station_id",), "changed_at", ("batch",), self.fan)

    @property
    def fact_log(self) -> MergeLog:
        return MergeLog(self.spark, f"{self.path}/status", FACTS, ("station_key", "polled_at"), "polled_at", (), self.fan)

    @property
    def waiting_log(self) -> MergeLog:
        return MergeLog(self.spark, f"{self.path}/unmatched", WAITING, ("station_id", "polled_at"), "polled_at", (), self.fan)

    def stations(self, before: int | None = None) -> DataFrame:
        """The dimension: newest logged row per station."""
        return self.station_log.read(before=before).drop("batch", "changed_at")

    def facts(self, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """The facts, one row per station and poll; of some days only if these are given."""
        return self.fact_log.read(first, last)

    def unmatched(self, before: int | None = None) -> DataFrame:
        """Landing rows whose station is not known yet."""
        known = self.stations(before).select("station_id")
        return self.waiting_log.read(before=before).join(known, "station_id", "left_anti")


def sync_micro_batch(
    target: SyncTarget, station_list: Callable[[], DataFrame]
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of the copy: dimension first, then the facts.

    Only inserted and updated stations are written. Facts are appended without reading those there are: of differing rows
    of a station and poll the greatest wins, whichever batch brought it, as in ``collapse_landing``. Rows whose station is
    still unknown wait apart; a batch reads them only if it brings new stations, and loads those of these stations.
    """

    work = f"{target.path}/work"

    def staged(rows: DataFrame, name: str) -> DataFrame:
        # Files, as a persisted frame keeps every shuffle partition, however small, and each step after it starts that many tasks.
        rows.write.mode("overwrite").parquet(f"{work}/{name}")
        return target.spark.read.schema(rows.schema).parquet(f"{work}/{name}")

    def run(batch: DataFrame, epoch: int) -> None:
        try:
            merged = staged(upsert_stations(target.stations(epoch), station_list()), "stations")
            changed = merged.filter(F.col("_change") != "same")
            target.station_log.append(
                changed.drop("_change").withColumn("batch", F.lit(epoch).cast("bigint"))
                .withColumn("changed_at", F.lit(None).cast("timestamp")), epoch,
            )
            dim = merged.select("station_id", "station_key")
            landing = staged(keyed_landing(None, collapse_landing(batch), dim), "landing")
            keyed, waited = as_facts(landing.filter(F.col("station_key").isNotNull())), False
            added = merged.filter(F.col("_change") == "insert").select("station_id", "station_key")
            if not added.isEmpty() and target.waiting_log.manifest(epoch).live:
                keyed = keyed.unionByName(incremental_load(None, target.waiting_log.read(before=epoch), added))
                waited = True
            target.fact_log.append(keyed, epoch, collapsed=not waited)
            target.waiting_log.append(landing.filter(F.col("station_key").isNull()), epoch, collapsed=True)
        finally:
            remove(target.spark, work)

    return run


def stream_sync(
    docs: DataFrame,
    station_list: Callable[[], DataFrame],
    target: SyncTarget,
    checkpoint: str,
    trigger: dict = EVERY_MINUTE,
) -> StreamingQuery:
    """Run the copy over a stream of status documents."""
    writer = parse_status(docs).writeStream.foreachBatch(sync_micro_batch(target, station_list))
    return _start(writer, checkpoint, trigger)


def _totals_log(spark: SparkSession, sink: str) -> MergeLog:
    sums = ("stations", "bikes", "ebikes", "docks")
    schema = "polled_at timestamp, " + ", ".join(f"{c} bigint" for c in sums)
    return MergeLog(spark, sink, schema, ("polled_at",), "polled_at", sums=sums)


def stream_poll_totals(
    status: DataFrame, sink: str, checkpoint: str, trigger: dict = ONCE
) -> StreamingQuery:
    """Station, bike and dock totals per poll, as partial totals of each batch that are merged now and then.

    Totals add up, so the stream keeps no state and needs no watermark: a row counts however late it is.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        totals = batch.groupBy("polled_at").agg(
            F.count(F.lit(1)).alias("stations"),
            F.sum("num_bikes_available").alias("bikes"),
            F.sum("num_ebikes_available").alias("ebikes"),
            F.sum("num_docks_available").alias("docks"),
        )
        _totals_log(batch.sparkSession, sink).append(totals, epoch)

    return _start(status.writeStream.foreachBatch(write), checkpoint, trigger)


def read_poll_totals(spark: SparkSession, sink: str) -> DataFrame:
    """Totals per poll over all batches."""
    return _totals_log(spark, sink).read()


GRAINS = ("minute", "hour", "day")


def _rollup_log(spark: SparkSession, sink: str, grain: str) -> MergeLog:
    sums = ("observations", "bikes", "ebikes")
    schema = f"{grain} timestamp, " + ", ".join(f"{c} bigint" for c in sums)
    return MergeLog(spark, f"{sink}/{grain}", schema, (grain,), grain, sums=sums)


def stream_rollups(
    status: DataFrame, sink: str, checkpoint: str, grains: Sequence[str] = GRAINS, trigger: dict = ONCE
) -> StreamingQuery:
    """Observations, bikes and e-bikes by minute, hour and day, kept current by each batch; late rows count where they belong.

    A batch is aggregated once, by the finest grain; the coarser ones add that up.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        fine = [g for g in GRAINS if g in grains]
        rows = batch.groupBy(F.date_trunc(fine[0], "polled_at").alias(fine[0])).agg(
            F.count(F.lit(1)).alias("observations"),
            F.sum("num_bikes_available").alias("bikes"),
            F.sum("num_ebikes_available").alias("ebikes"),
        ).persist()
        try:
            for g in fine:
                _rollup_log(batch.sparkSession, sink, g).append(rows.withColumn(g, F.date_trunc(g, fine[0])), epoch)
        finally:
            rows.unpersist()

    return _start(status.writeStream.foreachBatch(write), checkpoint, trigger)


def read_rollup(spark: SparkSession, sink: str, grain: str, n: int | None = None) -> DataFrame:
    """The rollup by ``grain``, of the newest ``n`` minutes, hours or days if given; batch twin: ``aggregates.hour_rollup``.

    For ``n`` of them only the newest ``n`` days are read: each holds one at least.
    """
    rows = _rollup_log(spark, sink, grain).read(newest_days=n)
    return rows if n is None else rows.orderBy(F.col(grain).desc()).limit(n)
