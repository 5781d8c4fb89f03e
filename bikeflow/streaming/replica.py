"""A replica of a table, kept by a stream of change rows that may arrive in any order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bikeflow.operators.dimension import operation_rank
from bikeflow.streaming.mergelog import FAN, MergeLog

_DELETED = 2


def replica_log(
    spark: SparkSession, path: str, base: DataFrame, key: str = "station_key", ver: str = "ver", fan: int = FAN
) -> MergeLog:
    """The log of changes to a table with the columns of ``base``."""
    fields = [f for f in base.schema.fields if f.name != key]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    schema = f"`{key}` {base.schema[key].dataType.simpleString()}, `{ver}` bigint, `_op` int, `_at` timestamp, {columns}"
    return MergeLog(spark, path, schema, (key,), "_at", (ver, "_op"), fan)


def _as_changes(rows: DataFrame, log: MergeLog, op: Column) -> DataFrame:
    ver = log.rank[0]
    typed = rows.withColumn("_op", op).withColumn("_at", F.lit(None).cast("timestamp")).withColumn(ver, F.col(ver).cast("bigint"))
    return typed.select(*log.columns)


def start_replica(log: MergeLog, base: DataFrame) -> None:
    """Batch 0: the rows that were there before any change."""
    log.append(_as_changes(base.withColumn(log.rank[0], F.lit(-1)), log, F.lit(0)), 0)


def stream_changes(changes: DataFrame, log: MergeLog, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append the change rows (columns of the table, version, ``op`` in I, U, D) of each batch to ``log``.

    Nothing is looked up: per key the highest version stays, whenever it arrives. A delete stays as a row of its own, so it
    holds against an insert with a lower version that comes later. Batches follow ``start_replica``.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        log.append(_as_changes(batch, log, operation_rank()), epoch + 1)

    return (
        changes.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_replica(log: MergeLog, columns: Sequence[str] | None = None) -> DataFrame:
    """The table after all changes; batch twin: ``dimension.apply_cdc``."""
    hidden = {*log.rank, "_at"}
    return log.read().filter(F.col("_op") != _DELETED).select(*(columns or [c for c in log.columns if c not in hidden]))
