"""Data-quality checks and reconciliation of two copies."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bikeflow.functions.clock import instant, seconds_between
from bikeflow.plans.runtime import cut
from bikeflow.plans.segments import with_previous


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def orphans(fact: DataFrame, dim: DataFrame, key: str = "station_key") -> DataFrame:
    """Keys of facts without a dimension row, with their number of facts."""
    return (
        fact.groupBy(key)
        .agg(F.count(F.lit(1)).alias("facts"))
        .join(dim.select(key), key, "left_anti")
    )


def freshness(df: DataFrame, as_of: Column | dt.datetime | str, limit_s: float = 300) -> DataFrame:
    """Age of the newest snapshot and whether it is below ``limit_s``; false when empty."""
    newest = df.agg(F.max("polled_at").alias("newest"), F.count(F.lit(1)).alias("rows"))
    age = F.rint(seconds_between(instant(as_of), F.col("newest"))).cast("int")
    return newest.select(
        age.alias("seconds_old"), "rows", F.coalesce(age < limit_s, F.lit(False)).alias("ok")
    )


def reconcile_counts(a: DataFrame, b: DataFrame, names: tuple[str, str] = ("a", "b")) -> DataFrame:
    """Row counts of two copies, side by side."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("side"), "rows")

    return counted(a, names[0]).unionByName(counted(b, names[1]))


def reconcile_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows by which two copies differ: side that has them and by how many copies.

    One aggregation over both sides instead of two ``exceptAll``: equal rows cancel
    on the map side, so identical copies of any number move as one row.
    """
    columns = a.columns
    both = a.select(*columns, F.lit(1).alias("_w")).unionByName(
        b.select(*columns, F.lit(-1).alias("_w"))
    )
    net = both.groupBy(*columns).agg(F.sum("_w").alias("_net")).filter(F.col("_net") != 0)
    return net.select(
        *columns,
        F.when(F.col("_net") > 0, "only_a").otherwise("only_b").alias("side"),
        F.abs("_net").alias("copies"),
    )


def _row_hash(columns: Sequence[str]) -> Column:
    """64 bits of a row; nulls count by their place."""
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


def differing_buckets(a: DataFrame, b: DataFrame, bits: int, within: DataFrame | None = None) -> DataFrame:
    """Numbers (``bucket``) of those of the 2**``bits`` buckets, by the leading bits of a row's hash, whose digests differ.

    A digest is a count and two sums, so only a row per bucket and task moves. ``within`` has the differing buckets of fewer bits
    (and that number as ``_bits``); other rows are left out.
    """
    columns = a.columns

    def digests(df: DataFrame, side: int) -> DataFrame:
        rows = hashed(df, columns)
        if within is not None:
            rows = _inside(rows, within)
        return rows.groupBy(F.shiftrightunsigned("_hash", 64 - bits).alias("bucket")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("_hash").cast("decimal(38,0)")).alias("sum"),
            F.bit_xor(F.xxhash64("_hash", F.lit(1))).alias("mix"),
        ).withColumn("side", F.lit(side))

    sums = [F.sum(F.col(c) * F.when(F.col("side") == 0, 1).otherwise(-1)).alias(c) for c in ("n", "sum")]
    both = digests(a, 0).unionByName(digests(b, 1)).groupBy("bucket").agg(*sums, F.bit_xor("mix").alias("mix"))
    return both.filter("n <> 0 or sum <> 0 or mix <> 0").select("bucket", F.lit(bits).alias("_bits"))


def hashed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).withColumn("_hash", _row_hash(columns))


def _inside(rows: DataFrame, buckets: DataFrame) -> DataFrame:
    bits = buckets.first()["_bits"]
    return rows.withColumn("_bucket", F.shiftrightunsigned("_hash", 64 - bits)).join(
        buckets.select(F.col("bucket").alias("_bucket")), "_bucket", "left_semi"
    ).drop("_bucket")


def reconcile_tree(a: DataFrame, b: DataFrame, levels: Sequence[int] = (8, 16)) -> DataFrame:
    """``reconcile_rows`` of two large copies that differ little: rows move only from buckets whose digests differ.

    Each level splits the differing buckets of the one before (``levels`` are bits of the hash) and reads only its rows; equal
    copies end after the first. Two differing buckets have equal digests with odds of about 1 in 2**100.
    """
    columns, within = a.columns, None
    for bits in levels:
        within = cut(differing_buckets(a, b, bits, within))
        if within.isEmpty():
            return reconcile_rows(a.limit(0), b.limit(0))
    left, right = (_inside(hashed(df, columns), within).drop("_hash") for df in (a, b))
    return reconcile_rows(left, right)


@dataclass(frozen=True)
class Check:
    """A named check; ``run`` gives one row with ``ok`` (boolean) and ``detail`` (string)."""

    name: str
    run: Callable[[], DataFrame]
    hint: str = ""


def run_checks(spark: SparkSession, checks: Sequence[Check]) -> DataFrame:
    """Outcome of every check as a row; a check that fails to run is reported, not raised.

    Runs eagerly, because a failure inside a job shows only there. Each check
    brings one row to the driver.
    """
    out = []
    for check in checks:
        try:
            row = check.run().select("ok", "detail").first()
            ok, detail = (bool(row["ok"]), row["detail"]) if row else (False, "no result")
        except Exception as exc:  # noqa: BLE001 - one broken check must not stop the rest
            ok, detail = False, f"{type(exc).__name__}: {(str(exc).splitlines() or [''])[0]}"
        out.append((check.name, ok, detail, "" if ok else check.hint))
    return spark.createDataFrame(out, "name string, ok boolean, detail string, hint string")


def poll_gaps(status: DataFrame, limit_s: float = 180, max_rows: int | None = None) -> DataFrame:
    """Intervals between consecutive polls that are longer than ``limit_s``."""
    polls = status.select("polled_at").distinct()
    seen = with_previous(polls, [], ["polled_at"], {"after": "polled_at"}, max_rows)
    return seen.select(
        "after",
        F.col("polled_at").alias("until"),
        seconds_between(F.col("polled_at"), F.col("after")).alias("gap_seconds"),
    ).filter(F.col("gap_seconds") > limit_s)
