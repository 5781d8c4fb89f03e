"""Ordered windows that survive a hot key.

A window partition runs in one task, so a station that holds a third of the rows
would hold up the whole job. Keys above an average task's share are cut into
consecutive *segments* of the window order; the window runs per (key, segment)
and one carry row per segment joins the pieces again. Results are exactly those
of the plain window. Split points come from a small sample, which decides only
where the cuts fall, never which rows take part.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bikeflow.plans.runtime import parallelism

SEGMENT_ROWS = 1_000_000   # below this a single task is never the bottleneck
SAMPLES_PER_SEGMENT = 64

SEG = "_seg"


def _order_struct(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    return reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(right[prefix + k]) for k in keys], F.lit(True)
    )


def add_segments(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    max_rows: int | None = None,
    total: int | None = None,
) -> tuple[DataFrame, bool]:
    """Add ``_seg`` (null for keys that need no cut); the flag tells whether any key was cut.

    Counts the rows first unless the caller knows their ``total``.
    """
    spark = df.sparkSession
    total = df.count() if total is None else total
    limit = max_rows or max(SEGMENT_ROWS, total // parallelism(spark))
    plain = df.withColumn(SEG, F.lit(None).cast("int"))
    if total <= limit:
        return plain, False

    # At most total / limit <= shuffle-partition-many keys reach the driver.
    if keys:
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        hot = [r.asDict() for r in sizes.filter(F.col("_n") > limit).collect()]
    else:
        hot = [{"_n": total}]
    if not hot:
        return plain, False

    wanted = {tuple(h[k] for k in keys): -(-h["_n"] // limit) for h in hot}
    rows = sum(h["_n"] for h in hot)
    fraction = min(1.0, SAMPLES_PER_SEGMENT * sum(wanted.values()) / rows)
    schema = df.select(*keys, *order).schema
    pool = df.select(*keys, *order)
    if keys:
        key_schema = T.StructType([T.StructField("_h_" + k, schema[k].dataType) for k in keys])
        hot_keys = spark.createDataFrame([tuple(h[k] for k in keys) for h in hot], key_schema)
        pool = pool.join(
            F.broadcast(hot_keys), _same_keys(pool, hot_keys, keys, "_h_"), "left_semi"
        )
    seen: dict[tuple, list] = {}
    drawn = pool if fraction >= 1.0 else pool.sample(fraction, seed=7)
    for row in drawn.distinct().collect():
        seen.setdefault(tuple(row[k] for k in keys), []).append(tuple(row[c] for c in order))

    order_type = T.StructType(
        [T.StructField(f"o{i}", schema[c].dataType) for i, c in enumerate(order)]
    )
    split_schema = T.StructType(
        [T.StructField("_s_" + k, schema[k].dataType) for k in keys]
        + [
            T.StructField("_heads", T.ArrayType(order_type)),
            T.StructField("_blocks", T.ArrayType(T.ArrayType(order_type))),
            T.StructField("_width", T.IntegerType()),
        ]
    )
    table = []
    for key, points in seen.items():
        points.sort(key=lambda p: tuple((v is not None, v) for v in p))
        n = wanted[key]
        cuts = sorted({len(points) * i // n for i in range(1, n)} - {0})
        chosen = [points[i] for i in cuts]
        width = max(math.isqrt(len(chosen)), 1)
        blocks = [chosen[i : i + width] for i in range(0, len(chosen), width)]
        table.append((*key, [b[0] for b in blocks], blocks, width))
    splits = F.broadcast(spark.createDataFrame(table, split_schema))

    # Number of split points at or below the row, found block first, then inside the block.
    at = _order_struct(order)
    block = F.size(F.filter(F.col("_heads"), lambda h: h <= at))
    inside = F.size(F.filter(F.element_at("_blocks", F.greatest(block, F.lit(1))), lambda s: s <= at))
    seg = (
        F.when(F.col("_heads").isNull(), F.lit(None))
        .when(block == 0, F.lit(0))
        .otherwise((block - 1) * F.col("_width") + inside)
    )
    joined = df.join(splits, _same_keys(df, splits, keys, "_s_"), "left")
    return joined.withColumn(SEG, seg).select(*df.columns, SEG), True


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Mapping[str, str],
    max_rows: int | None = None,
) -> DataFrame:
    """Add ``alias -> column`` of the preceding row in ``order`` within ``keys``."""
    cut, was_cut = add_segments(df, keys, order, max_rows)
    payload = F.struct(*[F.col(c).alias(a) for a, c in columns.items()])
    by_key = [*keys, SEG] if was_cut else list(keys)
    spec = Window.partitionBy(*by_key).orderBy(*order)
    out = cut.withColumn("_prev", F.lag(payload).over(spec))
    if was_cut:
        tails = (
            cut.filter(F.col(SEG).isNotNull())
            .groupBy(*keys, SEG)
            .agg(F.max_by(payload, _order_struct(order)).alias("_tail"))
        )
        carry = tails.select(
            *[F.col(k).alias("_c_" + k) for k in keys],
            F.col(SEG).alias("_c_seg"),
            F.lag("_tail").over(Window.partitionBy(*keys).orderBy(SEG)).alias("_carry"),
        ).filter(F.col("_c_seg") > 0)
        # One row per segment of a hot key, so at most about twice the shuffle partitions.
        out = out.join(
            F.broadcast(carry), _same_keys(out, carry, keys, "_c_") & (out[SEG] == carry["_c_seg"]), "left"
        ).withColumn("_prev", F.coalesce("_prev", "_carry"))
    return out.select(*df.columns, *[F.col("_prev")[a].alias(a) for a in columns])


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    alias: str,
    max_rows: int | None = None,
    total: int | None = None,
) -> DataFrame:
    """Add the inclusive running sum of ``value`` in ``order`` within ``keys``."""
    cut, was_cut = add_segments(df, keys, order, max_rows, total)
    by_key = [*keys, SEG] if was_cut else list(keys)
    spec = (
        Window.partitionBy(*by_key)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = cut.withColumn(alias, F.sum(value).over(spec))
    if was_cut:
        totals = cut.filter(F.col(SEG).isNotNull()).groupBy(*keys, SEG).agg(F.sum(value).alias("_t"))
        before = (
            Window.partitionBy(*keys)
            .orderBy(SEG)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        carry = totals.select(
            *[F.col(k).alias("_c_" + k) for k in keys],
            F.col(SEG).alias("_c_seg"),
            F.sum("_t").over(before).alias("_carry"),
        ).filter(F.col("_c_seg") > 0)
        # One row per segment of a hot key, so at most about twice the shuffle partitions.
        out = out.join(
            F.broadcast(carry), _same_keys(out, carry, keys, "_c_") & (out[SEG] == carry["_c_seg"]), "left"
        ).withColumn(alias, F.col(alias) + F.coalesce("_carry", F.lit(0)))
    return out.select(*df.columns, alias)


def row_numbers(
    df: DataFrame,
    order: Sequence[str],
    alias: str,
    keys: Sequence[str] = (),
    max_rows: int | None = None,
    total: int | None = None,
) -> DataFrame:
    """Add dense 1-based numbers in ``order``, over the whole frame or within ``keys``."""
    ones = df.withColumn("_one", F.lit(1).cast("bigint"))
    return running_sum(ones, keys, order, "_one", alias, max_rows, total).drop("_one")
