"""Nearest neighbours, radius filters, flow lines and point-in-polygon."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bikeflow.functions import polygons as polygon_parts
from bikeflow.functions.geo import EARTH_RADIUS_M, degree_box, distance_m
from bikeflow.functions.metrics import METRICS, Planar
from bikeflow.functions.numbers import half_up, ratio
from bikeflow.plans.runtime import cut, spread
from bikeflow.plans.segments import row_numbers
from bikeflow.plans.skew import split_join
from bikeflow.plans.tiles import Tiling, candidates, cover, curve, tile_points

POINT_TILE = 64
RINGS = 2048    # polygons that look for stations together
BLOCK = 8    # lattice cells per side that look for stations together


def _placed(stations: DataFrame) -> DataFrame:
    return stations.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull())


def nearest_to(stations: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` stations nearest to the largest one, in planar degree order."""
    placed = _placed(stations).select("station_key", "name", "capacity", "lon", "lat")
    first = placed.orderBy(F.col("capacity").desc_nulls_last(), "station_key").limit(1)
    a = first.select(F.struct("name", "lon", "lat")).scalar()
    elsewhere = (F.col("lon") != a["lon"]) | (F.col("lat") != a["lat"])
    return (
        placed.filter(elsewhere)
        .withColumn("d", Planar.distance(F.col("lon"), F.col("lat"), a["lon"], a["lat"]))
        .orderBy("d", "station_key")
        .limit(k)
        .select(
            a["name"].alias("busiest_station"),
            F.col("name").alias("alternative"),
            half_up(distance_m(a["lon"], a["lat"], F.col("lon"), F.col("lat"))).alias("metres"),
        )
    )


def locations(stations: DataFrame, keep: int) -> DataFrame:
    """Distinct positions ``x y`` with ``loc`` (smallest key) and their ``keep`` smallest keys.

    More keys of one position can never be among the nearest ``keep - 1`` of anyone,
    because ties go to the smaller key; so copies at one spot cost nothing.
    """
    spot = Window.partitionBy("x", "y").orderBy("station_key")
    return (
        _placed(stations)
        .select("station_key", F.col("lon").alias("x"), F.col("lat").alias("y"))
        .withColumn("_i", F.row_number().over(spot))
        .filter(F.col("_i") <= keep)
        .groupBy("x", "y")
        .agg(F.min("station_key").alias("loc"), F.sort_array(F.collect_list("station_key")).alias("keys"))
    )


def nearest_spots(tiling: Tiling, k: int, metric=Planar) -> DataFrame:
    """``qid qx qy near`` per position: its ``k + 1`` nearest stations, itself among them.

    ``near`` is sorted by distance and key. The tiling holds ``locations`` with more
    than ``k`` positions per tile.
    """
    queries = tiling.points.select(
        F.col("loc").alias("qid"), F.col("x").alias("qx"), F.col("y").alias("qy"), F.col("tile").alias("batch")
    )
    found = candidates(queries, tiling, k + 1, metric).select(
        "qid", "qx", "qy", "d", "x", "y", F.explode("keys").alias("key")
    )
    rank = F.row_number().over(Window.partitionBy("qid").orderBy("d", "key"))
    return (
        found.withColumn("_i", rank)
        .filter(F.col("_i") <= k + 1)
        .groupBy("qid")
        .agg(
            F.first("qx").alias("qx"),
            F.first("qy").alias("qy"),
            F.sort_array(F.collect_list(F.struct("d", "key", "x", "y"))).alias("near"),
        )
    )


def knn_join(
    stations: DataFrame, k: int = 60, order_by: str = "degrees", max_rows: int | None = None
) -> DataFrame:
    """Each station's ``k`` nearest other stations, ties by key, with great-circle metres.

    ``order_by``: ``degrees`` ranks by planar lon/lat distance, ``metres`` by
    great-circle distance. Exact for any point distribution.
    """
    tiling = tile_points(locations(stations, k + 1), "loc", k + 1, max_rows)
    nearest = nearest_spots(tiling, k, METRICS[order_by]).drop("qid")
    mine = _placed(stations).select("station_key", F.col("lon").alias("qx"), F.col("lat").alias("qy"))
    others = F.slice(F.filter("near", lambda e: e["key"] != F.col("station_key")), 1, k)
    return (
        split_join(mine, nearest, ["qx", "qy"])
        .select("station_key", "qx", "qy", F.posexplode(others).alias("pos", "e"))
        .select(
            "station_key",
            F.col("e.key").alias("neighbour_key"),
            (F.col("pos") + 1).alias("rank"),
            distance_m(F.col("qx"), F.col("qy"), F.col("e.x"), F.col("e.y")).alias("meters"),
        )
    )


def within_radius(stations: DataFrame, lon: float, lat: float, metres: float) -> DataFrame:
    """Stations within ``metres`` of a point; the degree box comes first and can reach the scan."""
    hx, hy = degree_box(F.lit(lat), F.lit(float(metres)))
    x, y = F.col("lon"), F.col("lat")
    return stations.filter(
        x.between(F.lit(lon) - hx, F.lit(lon) + hx)
        & y.between(F.lit(lat) - hy, F.lit(lat) + hy)
        & (distance_m(F.lit(lon), F.lit(lat), x, y) <= metres)
    )


def agg_by_keys(status: DataFrame, keys: DataFrame) -> DataFrame:
    """Observations and average level of the stations in ``keys``.

    Facts shrink to one row per station and task before they meet the keys.
    """
    per_key = status.groupBy("station_key").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("num_bikes_available").alias("s"),
        F.count("num_bikes_available").alias("c"),
    )
    return per_key.join(keys.select("station_key"), "station_key", "left_semi").agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("observations"),
        ratio(F.sum("s"), F.sum("c"), 1).alias("avg_bikes"),
    )


def radius_agg(status: DataFrame, stations: DataFrame, lon: float, lat: float, metres: float) -> DataFrame:
    """Observations and average level of all stations within ``metres`` of a point."""
    return agg_by_keys(status, within_radius(stations, lon, lat, metres))


def flow_lines(od: DataFrame, stations: DataFrame) -> DataFrame:
    """Origin-destination pairs as straight lines with their length in kilometres."""
    placed = _placed(stations)

    def side(prefix: str, key: str) -> DataFrame:
        return placed.select(
            F.col("station_key").alias(key), F.col("name").alias(prefix + "_name"),
            F.col("lon").alias(prefix + "_lon"), F.col("lat").alias(prefix + "_lat"),
        )

    ends = [(F.col(p + "_lon"), F.col(p + "_lat")) for p in ("from", "to")]
    joined = od.join(side("from", "start_station_key"), "start_station_key").join(
        side("to", "end_station_key"), "end_station_key"
    )
    return joined.select(
        F.array(*[F.struct(lon.alias("lon"), lat.alias("lat")) for lon, lat in ends]).alias("line"),
        "start_station_key", "end_station_key", "from_name", "to_name", "trips",
        half_up(distance_m(*ends[0], *ends[1]) / 1000, 2).alias("km"),
    )


def _batches(polygons: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``polygon_id ring batch x0 x1 y0 y1`` (bounds): up to ``RINGS`` neighbours of about one size are a batch; written already."""
    bounds = [
        f(F.col("ring")[c]).alias(n + i)
        for c, n in (("lon", "x"), ("lat", "y")) for f, i in ((F.array_min, "0"), (F.array_max, "1"))
    ]
    rings = polygons.filter(F.size("ring") > 0).select("polygon_id", "ring", *bounds).filter(
        F.col("x0").isNotNull() & F.col("y0").isNotNull()
    )
    wide = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    kind = F.when(wide > 1e-6, F.floor(F.log2(wide))).otherwise(-20).cast("bigint")
    mid = [(F.col(n + "0") + F.col(n + "1")) / 2 for n in "xy"]
    seen = rings.agg(
        F.count(F.lit(1)).alias("n"), *[f(m).alias(i + n) for m, n in zip(mid, "xy") for f, i in ((F.min, "l"), (F.max, "h"))]
    ).first()
    span = max(seen["hx"] - seen["lx"], seen["hy"] - seen["ly"]) or 1.0 if seen["n"] else 1.0
    placed = spread(rings).withColumn("_kind", kind).withColumn("_z", curve(*mid, seen["lx"] or 0.0, seen["ly"] or 0.0, span))
    ranked = row_numbers(placed, ["_z", "polygon_id"], "_r", ["_kind"], max_rows, seen["n"])
    batch = F.struct("_kind", F.call_function("div", F.col("_r") - 1, F.lit(RINGS)).alias("i"))
    number = (batch["_kind"] + 2000) * F.lit(1 << 48) + batch["i"]
    return cut(ranked.withColumn("batch", number).select("polygon_id", "ring", "batch", "x0", "x1", "y0", "y1"))


def dealt_polygons(stations: DataFrame, polygons: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Rings and the points near them in groups ``batch piece``: ``kind`` 0 has ``polygon_id ring``, 1 ``station_key x y tile``.

    A point goes once to every batch whose bounds meet its tile, not once to every polygon, so what is dealt grows
    with the points and the polygons while the pairs grow with their product. A piece holds about ``MEET`` points of a batch.
    """
    points = _placed(stations).select("station_key", F.col("lon").alias("x"), F.col("lat").alias("y"))
    tiling = tile_points(points, "station_key", POINT_TILE, max_rows)
    rings = _batches(polygons, max_rows)
    edge = [F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1")]
    corner = [F.struct(F.col(x).alias("lon"), F.col(y).alias("lat")) for x, y in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"))]
    outline = rings.groupBy(F.col("batch").alias("polygon_id")).agg(*edge).select("polygon_id", F.array(*corner).alias("ring"))
    met = cover(outline, tiling).select(F.col("polygon_id").alias("batch"), "tile")
    so_far = F.sum("n").over(Window.partitionBy("batch").orderBy("tile"))
    pieces = cut(
        met.join(tiling.tiles.select(F.col("node").alias("tile"), "n"), "tile")
        .select("batch", "tile", F.call_function("div", so_far - 1, F.lit(polygon_parts.MEET)).alias("piece"))
    )
    near = pieces.join(tiling.points, "tile").select(
        "batch", "piece", F.lit(1).alias("kind"), "tile", "station_key", "x", "y"
    )
    held = rings.join(pieces.select("batch", "piece").distinct(), "batch").select(
        "batch", "piece", F.lit(0).alias("kind"), F.lit(-1).cast("bigint").alias("tile"), "polygon_id", "ring"
    )
    return held.unionByName(near, allowMissingColumns=True)


def points_in_polygons(
    stations: DataFrame, polygons: DataFrame, max_rows: int | None = None
) -> DataFrame:
    """``polygon_id`` and ``station_key`` for every station inside a polygon.

    ``polygons`` has ``polygon_id`` and ``ring`` (``array<struct<lon,lat>>``). Neighbouring polygons meet the equal-count tiles of
    points around them as a batch; only stations of tiles that a side of the ring touches are tested.
    """
    dealt = spread(dealt_polygons(stations, polygons, max_rows), "batch", "piece")
    kinds = T.StructType([T.StructField(c, dealt.schema[c].dataType) for c in ("polygon_id", "station_key")])
    return dealt.sortWithinPartitions("batch", "piece", "kind", "tile").mapInArrow(polygon_parts.points_in_rings, kinds)


def service_grid(stations: DataFrame, step: float = 0.005, max_rows: int | None = None) -> DataFrame:
    """Lattice cells of ``step`` degrees given to the nearest station, area in km² summed."""
    tiling = tile_points(locations(stations, 1), "loc", 16, max_rows)
    edge = _placed(stations).agg(
        F.min("lon").alias("lon0"), F.max("lon").alias("lon1"),
        F.min("lat").alias("lat0"), F.max("lat").alias("lat1"),
    )
    cells_x = F.greatest(F.ceil((F.col("lon1") - F.col("lon0")) / step), F.lit(1))
    cells_y = F.greatest(F.ceil((F.col("lat1") - F.col("lat0")) / step), F.lit(1))
    columns = edge.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), cells_x - 1)).alias("i"))
    lattice = (
        columns.repartition("i")
        .select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), cells_y - 1)).alias("j"))
        .select(
            F.struct("i", "j").alias("qid"),
            F.struct(F.floor(F.col("i") / BLOCK).alias("i"), F.floor(F.col("j") / BLOCK).alias("j")).alias("batch"),
            (F.col("lon0") + (F.col("i") + 0.5) * step).alias("qx"),
            (F.col("lat0") + (F.col("j") + 0.5) * step).alias("qy"),
        )
    )
    near = candidates(lattice, tiling, 1)
    owner = near.groupBy("qid", "qy").agg(F.min_by("loc", F.struct("d", "loc")).alias("station_key"))
    return owner.groupBy("station_key").agg(
        F.count(F.lit(1)).alias("cells"), F.sum(cell_km2(F.col("qy"), step)).alias("km2")
    )


def cell_km2(lat, step: float):
    """Area of a lattice cell of ``step`` degrees centred on ``lat``."""
    top, bottom = F.radians(lat + step / 2), F.radians(lat - step / 2)
    scale = F.radians(F.lit(step)) * F.lit(EARTH_RADIUS_M * EARTH_RADIUS_M / 1e6)
    return (F.sin(top) - F.sin(bottom)) * scale
