"""Trip-archive CSV files and the overwrite-mode station list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bikeflow.sources.feeds import dated_stations
from bikeflow.sources.schemas import TRIP_ARCHIVE


def read_trip_csv(spark: SparkSession, path: str) -> DataFrame:
    """The columns of ``TRIP_ARCHIVE`` from CSV files with a header row, plain or gzip.

    Columns are found by name, so their order and further columns do not matter; a missing one raises, and so
    does a file whose header differs from the first one's. A value that is not of its type is null.
    """
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    missing = [f.name for f in TRIP_ARCHIVE if f.name not in raw.columns]
    if missing:
        raise ValueError(f"the archive lacks the columns {', '.join(missing)}")

    def typed(name: str, kind: T.DataType) -> Column:
        if isinstance(kind, T.TimestampType):
            return F.try_to_timestamp(F.col(name), F.lit("yyyy-MM-dd HH:mm:ss[.SSS]"))
        return F.col(name).try_cast(kind)

    return raw.select(*[typed(f.name, f.dataType).alias(f.name) for f in TRIP_ARCHIVE])


def replace_stations(docs: DataFrame, path: str) -> DataFrame:
    """Write the newest station list over the old one and read it back."""
    rows = dated_stations(docs)
    newest = rows.filter(F.col("last_updated") == rows.select(F.max("last_updated")).scalar())
    fields = [c for c in newest.columns if c not in ("last_updated", "station_id")]
    one_each = newest.groupBy("station_id").agg(F.max(F.struct(*fields)).alias("_r"))
    one_each.select("station_id", "_r.*").write.mode("overwrite").parquet(path)
    return docs.sparkSession.read.parquet(path)
