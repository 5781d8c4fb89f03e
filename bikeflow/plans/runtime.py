"""Session-level helpers: lineage cuts and scratch folders on shared storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints.

    Only a local master may fall back to a folder of this machine; on a cluster
    another executor could not read it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or (
        spark.sparkContext.getCheckpointDir()
    )
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    made = tempfile.mkdtemp(prefix="bikeflow-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably and drop its lineage."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, one per call."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this session's jobs have written, wherever its file system is; a missing one is no error."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Spread a small frame over all tasks before an operator multiplies its rows.

    A dimension fits in one file and so starts in one task; without this the join
    that expands it would stay there.
    """
    return df.repartition(parallelism(df.sparkSession), *columns)


def parallelism(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
