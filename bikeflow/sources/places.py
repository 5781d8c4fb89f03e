"""Tables laid out by place, so that a question about a radius opens few files.

Rows get their place on a Hilbert curve over the globe. Its leading bits name the folder, and rows lie in its order inside a file;
a radius becomes a few ranges of the curve, which prune folders first and row groups by their statistics next.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bikeflow.functions.geo import degree_box
from bikeflow.operators import proximity
from bikeflow.plans.tiles import CURVE_BITS, curve, curve_of_cell

FOLDER_BITS = 13      # a folder is 0.044 degrees a side
CELLS = 256           # cells that a box is covered with, at most
_ORIGIN, _SPAN = (-180.0, -90.0), 360.0
PLACE, FOLDER = "_place", "_folder"


def write_by_place(rows: DataFrame, path: str, folder_bits: int = FOLDER_BITS) -> None:
    """Write ``rows`` (with ``lon`` and ``lat``) by folder and place. Rows without a position have a folder of their own.

    A folder with very many rows is split over files by Spark's target size.
    """
    place = curve(F.col("lon"), F.col("lat"), *_ORIGIN, _SPAN)
    usable = F.col("lon").isNotNull() & F.col("lat").isNotNull()
    placed = rows.withColumn(PLACE, F.when(usable, place)).withColumn(
        FOLDER, F.shiftright(PLACE, 2 * (CURVE_BITS - folder_bits))
    )
    placed.hint("rebalance", F.col(FOLDER)).sortWithinPartitions(FOLDER, PLACE).write.partitionBy(FOLDER).parquet(path)


def write_facts_by_place(status: DataFrame, stations: DataFrame, path: str, folder_bits: int = FOLDER_BITS) -> None:
    """Write facts by the place of their station; those of unknown stations lie apart."""
    where = stations.select("station_key", "lon", "lat")
    write_by_place(status.join(where, "station_key", "left"), path, folder_bits)


def curve_ranges(lon: float, lat: float, half_lon: float, half_lat: float) -> list[tuple[int, int]]:
    """Ranges of the curve (last place included) that cover a box around a point, at most ``CELLS`` of them."""
    south, north = max(lat - half_lat, -90.0), min(lat + half_lat, 90.0)
    if half_lon >= 180:
        sides = [(-180.0, 180.0)]
    else:  # a box over the date line is two
        west, east = lon - half_lon, lon + half_lon
        sides = [(max(west, -180.0), min(east, 180.0))]
        sides += [(west + 360, 180.0)] if west < -180 else []
        sides += [(-180.0, east - 360)] if east > 180 else []
    out = []
    for west, east in sides:
        bits = CURVE_BITS
        while True:
            # The grid of the curve has 2**CURVE_BITS - 1 steps a side; its cells are found as the curve finds them.
            top = (1 << CURVE_BITS) - 1
            grid = [
                min(max(int((v - o) / _SPAN * top), 0), top) >> (CURVE_BITS - bits)
                for v, o in ((west, _ORIGIN[0]), (east, _ORIGIN[0]), (south, _ORIGIN[1]), (north, _ORIGIN[1]))
            ]
            if (grid[1] - grid[0] + 1) * (grid[3] - grid[2] + 1) <= CELLS:
                break
            bits -= 1
        shift = 2 * (CURVE_BITS - bits)
        cells = (curve_of_cell(i, j, bits) for i in range(grid[0], grid[1] + 1) for j in range(grid[2], grid[3] + 1))
        out += [(c << shift, ((c + 1) << shift) - 1) for c in cells]
    out.sort()
    merged: list[tuple[int, int]] = []
    for lo, hi in out:
        if merged and lo <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
        else:
            merged.append((lo, hi))
    return merged


def near(
    spark: SparkSession, path: str, lon: float, lat: float, metres: float, folder_bits: int = FOLDER_BITS, schema: str = ""
) -> DataFrame:
    """The rows of a table laid out by place that may lie within ``metres`` of a point, never fewer than do.

    An empty table has no file to tell its columns; ``schema`` gives them.
    """
    half_lon, half_lat = spark.range(1).select(*degree_box(F.lit(lat), F.lit(float(metres)))).first()
    ranges = curve_ranges(lon, lat, half_lon, half_lat)
    shift = 2 * (CURVE_BITS - folder_bits)

    def among(column: str, bounds: list[tuple[int, int]]) -> Column:
        return reduce(lambda a, b: a | b, [F.col(column).between(lo, hi) for lo, hi in bounds])

    folders = sorted({(lo >> shift, hi >> shift) for lo, hi in ranges})
    known = f"{schema}, {PLACE} bigint, {FOLDER} bigint"
    rows = (spark.read.schema(known) if schema else spark.read).parquet(path)
    return rows.filter(among(FOLDER, folders)).filter(among(PLACE, ranges)).drop(PLACE, FOLDER)


def within_radius(spark: SparkSession, path: str, lon: float, lat: float, metres: float) -> DataFrame:
    """``proximity.within_radius`` of stations that ``write_by_place`` laid out."""
    return proximity.within_radius(near(spark, path, lon, lat, metres), lon, lat, metres)


def radius_agg(spark: SparkSession, facts: str, stations: str, lon: float, lat: float, metres: float) -> DataFrame:
    """``proximity.radius_agg`` of facts and stations laid out by place: facts of other places are not opened."""
    return proximity.agg_by_keys(near(spark, facts, lon, lat, metres), within_radius(spark, stations, lon, lat, metres))
