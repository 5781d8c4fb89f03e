"""Density clusters without pairing up the points of a dense cell.

Points fall into square cells whose diagonal is ``eps``: all points of a cell are
neighbours, so a cell with ``minpts`` points is all core and needs no comparison.
Two groups of points are compared by bounding box first and are split into smaller
boxes only while the boxes leave the answer open; point pairs are formed only for
small boxes. Work therefore stays near linear when one cell holds a third of all.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bikeflow.functions.geo import web_mercator
from bikeflow.functions.metrics import Box, Planar
from bikeflow.plans import skew
from bikeflow.plans.components import components
from bikeflow.plans.runtime import cut
from bikeflow.plans.skew import grouped, split_join

PAIR_LIMIT = 16384     # box pairs with at most this many point pairs are compared directly
BAND = 1 << 31
ONE_TASK_EDGES = 200_000   # pairs of touching cells (3 MB) whose components one task finds at once


def _boxed(points: DataFrame, level: int, prefix: str) -> DataFrame:
    """Sub-cells of every group at ``level``: tight box, weight and number of points."""
    scale = float(1 << level)
    return points.groupBy(
        F.col("gid").alias(prefix + "gid"),
        F.floor(F.col("tx") * scale).alias(prefix + "sx"),
        F.floor(F.col("ty") * scale).alias(prefix + "sy"),
    ).agg(
        F.min("x").alias(prefix + "x0"), F.max("x").alias(prefix + "x1"),
        F.min("y").alias(prefix + "y0"), F.max("y").alias(prefix + "y1"),
        F.sum("w").alias(prefix + "w"), F.count(F.lit(1)).alias(prefix + "m"),
    )


def _points_at(points: DataFrame, level: int, prefix: str) -> DataFrame:
    scale = float(1 << level)
    return points.select(
        F.col("gid").alias(prefix + "gid"),
        F.floor(F.col("tx") * scale).alias(prefix + "sx"),
        F.floor(F.col("ty") * scale).alias(prefix + "sy"),
        F.col("x").alias(prefix + "px"), F.col("y").alias(prefix + "py"), F.col("w").alias(prefix + "pw"),
    )


def close_pairs(
    left: DataFrame, right: DataFrame, pairs: DataFrame, eps: float, large: bool, enough: int = 1
) -> DataFrame:
    """``l_gid r_gid hits`` for the pairs of groups that come within ``eps``.

    ``left`` and ``right`` hold points (``gid x y tx ty w``), ``pairs`` the group pairs
    to look at. For left groups of one position ``hits`` counts the weight of the
    right points in reach, exact below ``enough``; otherwise it only tells that there
    are some. ``large`` says whether splitting may be needed at all.
    """
    a, b = Box.of("l_"), Box.of("r_")
    found: list[DataFrame] = []
    todo = pairs
    level = 0
    while True:
        boxes_l, boxes_r = _boxed(left, level, "l_"), _boxed(right, level, "r_")
        if level == 0:
            open_ = todo.join(boxes_l, "l_gid").join(boxes_r, "r_gid")
        else:
            up_l = boxes_l.withColumn("l_ux", F.floor(F.col("l_sx") / 2)).withColumn("l_uy", F.floor(F.col("l_sy") / 2))
            up_r = boxes_r.withColumn("r_ux", F.floor(F.col("r_sx") / 2)).withColumn("r_uy", F.floor(F.col("r_sy") / 2))
            open_ = todo.join(up_l, ["l_gid", "l_ux", "l_uy"]).join(up_r, ["r_gid", "r_ux", "r_uy"])
        open_ = open_.withColumn("_gap", Planar.box_gap(a, b)).filter(F.col("_gap") <= eps)
        open_ = open_.withColumn("_all", Planar.box_span(a, b) <= eps)
        small = F.col("l_m") * F.col("r_m") <= PAIR_LIMIT
        if large:
            open_ = cut(open_)
        found.append(open_.filter("_all").select("l_gid", "r_gid", F.col("r_w").alias("hits")))
        tested = (
            open_.filter(~F.col("_all") & small)
            .select("l_gid", "l_sx", "l_sy", "r_gid", "r_sx", "r_sy")
            .join(_points_at(left, level, "l_"), ["l_gid", "l_sx", "l_sy"])
            .join(_points_at(right, level, "r_"), ["r_gid", "r_sx", "r_sy"])
            .filter(
                Planar.distance(F.col("l_px"), F.col("l_py"), F.col("r_px"), F.col("r_py")) <= eps
            )
            .select("l_gid", "r_gid", F.col("r_pw").alias("hits"))
        )
        found.append(tested)
        if not large:
            break
        settled = found[0]
        for more in found[1:]:
            settled = settled.unionByName(more)
        settled = settled.groupBy("l_gid", "r_gid").agg(F.sum("hits").alias("hits"))
        done = settled.filter(F.col("hits") >= enough).select("l_gid", "r_gid")
        todo = cut(
            open_.filter(~F.col("_all") & ~small)
            .select(
                "l_gid", F.col("l_sx").alias("l_ux"), F.col("l_sy").alias("l_uy"),
                "r_gid", F.col("r_sx").alias("r_ux"), F.col("r_sy").alias("r_uy"),
            )
            .join(done, ["l_gid", "r_gid"], "left_anti")
        )
        if todo.isEmpty():
            break
        found = [cut(settled)]
        level += 1
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.groupBy("l_gid", "r_gid").agg(F.sum("hits").alias("hits"))


def _offsets(half: bool):
    """Neighbouring cells that can hold a point within ``eps``."""
    reach = range(-2, 3)
    steps = [(i, j) for i in reach for j in reach if (i, j) != (0, 0)]
    if half:
        steps = [s for s in steps if s > (0, 0)]
    return F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in steps])


def _cell_id(cx, cy):
    return cx * F.lit(1 << 32) + cy + F.lit(BAND)


def _near_cells(rows: DataFrame, cells: DataFrame, half: bool = False) -> DataFrame:
    """Group pairs of ``rows`` (``l_gid cx cy``) with the existing ``cells`` (``r_gid``) around."""
    spread = rows.withColumn("_o", F.explode(_offsets(half))).select(
        "l_gid", _cell_id(F.col("cx") + F.col("_o.i"), F.col("cy") + F.col("_o.j")).alias("r_gid")
    )
    return spread.join(cells, "r_gid", "left_semi")


def _plain_join(rows: DataFrame, side: DataFrame, keys: list[str], hot: DataFrame | None = None) -> DataFrame:
    return rows.join(side, keys)


def dbscan(
    stations: DataFrame, eps: float = 400.0, minpts: int = 5, project=web_mercator
) -> DataFrame:
    """``station_key`` and ``cluster``; null is unclustered.

    Distances are in the units of ``project`` (web-mercator units by default). A
    cluster is named by its smallest core station; a border station that touches
    several clusters joins the smallest. ``minpts`` counts the station itself.
    """
    if eps < 0.02:
        raise ValueError("eps below 0.02 would overflow the cell numbering")
    side = eps / math.sqrt(2.0) * (1.0 - 1e-9)
    x, y = project(F.col("lon"), F.col("lat"))
    placed = stations.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull()).select(
        "station_key", x.alias("x"), y.alias("y")
    )
    # Stations at one position are one weighted point.
    spots = (
        placed.groupBy("x", "y")
        .agg(F.count(F.lit(1)).alias("w"), F.min("station_key").alias("loc"))
        .withColumn("tx", F.col("x") / side).withColumn("ty", F.col("y") / side)
        .withColumn("cx", F.floor("tx")).withColumn("cy", F.floor("ty"))
        .withColumn("gid", _cell_id(F.col("cx"), F.col("cy")))
    )
    # As many tasks as its size asks for: a fixed number stays with the cut frame, and each step would start that many.
    spots = cut(spots)
    cells = spots.groupBy("gid").agg(F.sum("w").alias("cell_w"), F.count(F.lit(1)).alias("cell_m"))
    biggest = cells.agg(F.max("cell_m")).first()[0] or 0
    large = biggest * biggest > PAIR_LIMIT
    many = grouped(cells.select("gid", F.col("cell_m").alias("_n")), ["gid"])
    # No cell has more positions than the biggest one; joins on cells are split only if that is too large for a task.
    by_cell = split_join if biggest > skew.HOT_ROWS else _plain_join
    sized = by_cell(spots, cells.select("gid", "cell_w"), ["gid"], many)
    dense = sized.filter(F.col("cell_w") >= minpts).drop("cell_w")
    sparse = cut(sized.filter(F.col("cell_w") < minpts))

    # Core points of thin cells: count the neighbours around.
    alone = sparse.select(F.col("loc").alias("gid"), "x", "y", "tx", "ty", "w")
    look = _near_cells(
        sparse.select(F.col("loc").alias("l_gid"), "cx", "cy"), cells.select(F.col("gid").alias("r_gid"))
    )
    counted = (
        close_pairs(alone, spots, look, eps, large, minpts)
        .groupBy(F.col("l_gid").alias("loc"))
        .agg(F.sum("hits").alias("around"))
    )
    judged = sparse.join(counted, "loc", "left").withColumn(
        "core", F.col("cell_w") + F.coalesce("around", F.lit(0)) >= minpts
    )
    judged = cut(judged.drop("cell_w", "around"))
    cores = cut(dense.unionByName(judged.filter("core").drop("core")))

    # Clusters: components of the cells that hold core points.
    core_cells = cut(
        cores.groupBy("gid").agg(
            F.min("loc").alias("node"), F.first("cx").alias("cx"), F.first("cy").alias("cy")
        )
    )
    around = _near_cells(
        core_cells.select(F.col("gid").alias("l_gid"), "cx", "cy"),
        core_cells.select(F.col("gid").alias("r_gid")),
        half=True,
    )
    names = core_cells.select("gid", "node")
    edges = (
        close_pairs(cores, cores, around, eps, large)
        .join(names.select(F.col("gid").alias("l_gid"), F.col("node").alias("a")), "l_gid")
        .join(names.select(F.col("gid").alias("r_gid"), F.col("node").alias("b")), "r_gid")
        .select("a", "b")
    )
    labels = components(names.select("node"), edges, in_one_task=ONE_TASK_EDGES)
    cell_label = cut(names.join(labels, "node").select("gid", "label"))

    # Border points: smallest cluster among the core points in reach.
    border = judged.filter(~F.col("core"))
    touch = _near_cells(
        border.select(F.col("loc").alias("l_gid"), "cx", "cy"), names.select(F.col("gid").alias("r_gid"))
    )
    same = border.select("loc", "gid").join(cell_label, "gid").select("loc", "label")
    beside = (
        close_pairs(
            border.select(F.col("loc").alias("gid"), "x", "y", "tx", "ty", "w"), cores, touch, eps, large
        )
        .join(cell_label.withColumnRenamed("gid", "r_gid"), "r_gid")
        .select(F.col("l_gid").alias("loc"), "label")
    )
    attached = same.unionByName(beside).groupBy("loc").agg(F.min("label").alias("label"))
    clustered = by_cell(cores, cell_label, ["gid"]).select("loc", "label").unionByName(attached)
    by_spot = spots.select("x", "y", "loc").join(clustered, "loc", "left").select("x", "y", "label")
    return split_join(placed, by_spot, ["x", "y"]).select("station_key", F.col("label").alias("cluster"))


def cluster_sizes(clusters: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` largest clusters, unclustered stations counted as one group."""
    return (
        clusters.groupBy("cluster")
        .agg(F.count(F.lit(1)).alias("stations"))
        .orderBy(F.col("stations").desc_nulls_last(), F.col("cluster").asc_nulls_last())
        .limit(n)
        .select(F.coalesce(F.col("cluster").cast("string"), F.lit("unclustered")).alias("cluster"), "stations")
    )
