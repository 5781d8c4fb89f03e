"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from bikeflow.plans import skew
from bikeflow.plans.runtime import cut


# Executors need no copy of the package: the function for one task travels with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _fingerprint(edges: DataFrame) -> tuple:
    """Order-free content summary; two different digests make a false match negligible."""
    pair = F.xxhash64("a", "b").cast("decimal(38,0)")
    other = F.hash("b", "a").cast("bigint")
    row = edges.agg(F.count(F.lit(1)), F.sum(pair), F.sum(other)).first()
    return tuple(row)


def _large_star(edges: DataFrame, count: int) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node it knows.

    No node has more than ``count`` edges, the number of all; only beyond that are hubs split.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    seen = both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("_n"))
    low = seen.select("a", F.least("a", "m").alias("m"))
    if count > skew.HOT_ROWS:
        handed = skew.split_join(both, low, ["a"], skew.grouped(seen, ["a"]))
    else:
        handed = both.join(low, "a")
    return (
        handed
        .filter(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours to the smallest of them."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").filter(F.col("b") != F.col("m")).select(
        F.col("b").alias("a"), F.col("m").alias("b")
    )
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def joined_labels(batches):
    """For the edges (``a``, ``b``, integers) of one task: every node with the smallest one of its component."""
    parts = [np.stack([b.column("a").to_numpy(), b.column("b").to_numpy()]) for b in batches if b.num_rows]
    if not parts:
        return
    names, at = np.unique(np.concatenate(parts, axis=1), return_inverse=True)
    a, b = at.reshape(2, -1)
    parent = np.arange(len(names))  # in order of the names, so the smallest place is the smallest node
    while True:
        x, y = parent[a], parent[b]
        if (x == y).all():
            break
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while (parent[parent] != parent).any():
            parent = parent[parent]
    yield pa.RecordBatch.from_pydict({"a": names, "b": names[parent]})


def components(nodes: DataFrame, edges: DataFrame, in_one_task: int = 0) -> DataFrame:
    """``node`` -> ``label``, the smallest node of its component.

    ``edges`` has ``a`` and ``b``. Each round is checkpointed, so a lost executor
    repeats at most one round and the plan does not grow. Up to ``in_one_task`` edges between
    bigint nodes are joined in one task instead, which saves the rounds.
    """
    current = cut(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    seen = _fingerprint(current)
    if seen[0] <= in_one_task and current.schema["a"].dataType == LongType():
        stars = cut(current.coalesce(1).mapInArrow(joined_labels, "a bigint, b bigint")).select(F.col("a").alias("node"), F.col("b").alias("label"))
        return nodes.join(stars, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
    while True:
        current = cut(_small_star(_large_star(current, seen[0])))
        now = _fingerprint(current)
        if now == seen:
            break
        seen = now
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes.join(stars, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
