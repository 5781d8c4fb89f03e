"""Departures of a status stream whose rows may arrive late and in any order.

Every station keeps its rows of the last while as keyed state. A row that arrives between two known ones changes the delta
of the later one and makes a delta of its own, so the departures of a batch are changes: a departure that no longer holds
is taken back (``sign`` -1) and the one that takes its place is added (+1). The sink adds the changes up per departure;
whatever the order and the batches, what is left equals the batch operator's result.

Of a station the state has its newest row of ``lateness`` ago or earlier, and all rows since. It goes by the station's own
clock, so a silent station keeps just that one row and is never forgotten. Stations are dealt over ``BUCKETS`` groups by hash;
a group is one packed value and its stations are repaired together, as a call for every station would cost far more than its rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bikeflow.operators.events import LEVEL
from bikeflow.streaming.mergelog import FAN, MergeLog
from bikeflow.streaming.repair import Repair

KEY, TS, TIE = "station_key", "polled_at", "status_id"
CHANGES = "station_key bigint, polled_at timestamp, status_id bigint, n int, sign bigint"
BUCKETS = 1024    # groups of stations; a checkpoint keeps the number that it began with
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _log(spark: SparkSession, sink: str, fan: int = FAN) -> MergeLog:
    return MergeLog(spark, sink, CHANGES, (KEY, TS, TIE, "n"), TS, fan=fan, sums=("sign",))


def _writer(sink: str, late: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, epoch: int) -> None:
        rows = batch.withColumn(TS, F.timestamp_micros("ts")).withColumnRenamed("tie", TIE).persist()
        try:
            changes = rows.filter("not late").select(KEY, TS, TIE, F.col("n").cast("int").alias("n"), "sign")
            _log(batch.sparkSession, sink).append(changes, epoch)
            rows.filter("late").select(KEY, TS, TIE, "level").write.mode("overwrite").parquet(f"{late}/batch={epoch}")
        finally:
            rows.unpersist()

    return write


def stream_departures(
    status: DataFrame, sink: str, checkpoint: str, lateness_s: float, cap: int = 8, trigger: dict | None = None
) -> StreamingQuery:
    """Departures of a status stream; batch twin: ``events.departures``.

    A row that is at most ``lateness_s`` older than the newest one of its station is put where it belongs. One that is
    older still is too, while the rows around it are held; otherwise it changes nothing and ``read_late`` returns it. Rows
    without an instant are left out; of rows that repeat instant and id the greatest level counts. A null station is one.

    The state is kept in RocksDB, which the session's state store provider is set to for this query.
    """
    spark = status.sparkSession
    rows = status.filter(F.col(TS).isNotNull()).select(
        F.pmod(F.xxhash64(F.col(KEY).cast("bigint")), F.lit(BUCKETS)).alias("bucket"),
        F.col(KEY).isNull().alias("nokey"), F.coalesce(F.col(KEY).cast("bigint"), F.lit(0)).alias("key"), F.unix_micros(TS).alias("ts"), F.coalesce(F.col(TIE).cast("bigint"), F.lit(-(2**63))).alias("tie"),
        F.col(LEVEL).cast("int").alias("level"),
    )
    schema = f"{KEY} bigint, ts bigint, tie bigint, n bigint, sign bigint, level int, late boolean"
    changes = rows.groupBy("bucket").transformWithStateInPandas(
        Repair(int(lateness_s * 1_000_000), cap), schema, outputMode="Append", timeMode="None"
    )
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:  # the query takes the session's settings as they are when it starts
        return (
            changes.writeStream.foreachBatch(_writer(sink, f"{checkpoint}/late"))
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
    finally:
        spark.conf.set(PROVIDER, before)


def read_late(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Rows that came too late to be put in order, with their ``batch``."""
    return spark.read.parquet(f"{checkpoint}/late")


def read_departures(spark: SparkSession, sink: str) -> DataFrame:
    """The departures after all batches."""
    return _log(spark, sink).read().filter("sign > 0").drop("sign")
