"""Joins of many rows with one row per key, where a few keys may hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 100_000    # rows of one key that a join group takes before it is split


def hot_keys(rows: DataFrame, keys: Sequence[str], per_group: int | None = None) -> DataFrame:
    """``keys`` with more than ``per_group`` rows and ``_groups``, the join groups that they get.

    Counted on the map side first. The result has at most one row per ``per_group`` rows.
    """
    each = per_group or HOT_ROWS
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return grouped(counted, keys, each)


def grouped(counted: DataFrame, keys: Sequence[str], per_group: int | None = None) -> DataFrame:
    """``hot_keys`` from counts (``_n``) that are there already."""
    each = per_group or HOT_ROWS
    return counted.filter(F.col("_n") > each).select(*keys, F.ceil(F.col("_n") / each).alias("_groups"))


def split_join(
    rows: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    hot: DataFrame | None = None,
    per_group: int | None = None,
) -> DataFrame:
    """Inner join of ``rows`` with ``side``, which has one row per key; a hot key is split.

    Rows of a hot key are dealt by their hash over as many groups as their count asks
    for, and the row of ``side`` is repeated once per group. All other keys join plainly.
    Without a hot key, which one count decides, it is a plain join.
    """
    hot = hot_keys(rows, keys, per_group) if hot is None else hot
    if hot.isEmpty():
        return rows.join(side, list(keys))
    groups = F.coalesce("_groups", F.lit(1).cast("bigint"))
    dealt = rows.join(hot, list(keys), "left").withColumn(
        "_group", F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), groups)
    )
    copies = side.join(hot, list(keys), "left").withColumn(
        "_group", F.explode(F.sequence(F.lit(0).cast("bigint"), groups - 1))
    )
    return dealt.drop("_groups").join(copies.drop("_groups"), [*keys, "_group"]).drop("_group")
