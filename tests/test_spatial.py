"""Spatial operators against brute force on a skewed fixture."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bikeflow.functions import geo, polygons
from bikeflow.functions.metrics import METRICS
from bikeflow.operators import allocation, clusters, proximity, regions
from bikeflow.plans import components as comp
from bikeflow.plans import runtime, segments, skew, tiles

RADIUS = 6371008.8


def haversine(a, b):
    lat1, lat2 = math.radians(a[1]), math.radians(b[1])
    h = math.sin((lat2 - lat1) / 2) ** 2
    h += math.cos(lat1) * math.cos(lat2) * math.sin(math.radians(b[0] - a[0]) / 2) ** 2
    return 2 * RADIUS * math.asin(math.sqrt(h))


def skewed_points(n=240, seed=5):
    """A third at one spot, a third inside a few metres, the rest across the city."""
    rng = random.Random(seed)
    out = {}
    for key in range(1, n + 1):
        if key % 3 == 0:
            out[key] = (-73.99, 40.72)
        elif key % 3 == 1:
            out[key] = (-73.97 + rng.random() * 1e-4, 40.70 + rng.random() * 1e-4)
        else:
            out[key] = (-74.05 + rng.random() * 0.2, 40.60 + rng.random() * 0.2)
    return out


@pytest.fixture
def points():
    return skewed_points()


@pytest.fixture
def stations(points, station_rows):
    return station_rows([(k, *p) for k, p in points.items()])


def brute_knn(points, k, distance):
    out = set()
    for a, p in points.items():
        near = sorted((distance(p, q), b) for b, q in points.items() if b != a)[:k]
        out |= {(a, b, i + 1) for i, (_, b) in enumerate(near)}
    return out


@pytest.mark.parametrize("k", [1, 7, 300])
def test_knn_degrees(points, stations, k):
    got = proximity.knn_join(stations, k, max_rows=40)
    want = brute_knn(points, k, lambda p, q: math.sqrt((p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2))
    assert {(r[0], r[1], r[2]) for r in got.collect()} == want


def test_knn_metres_differs_from_degrees(points, stations):
    got = proximity.knn_join(stations, 6, order_by="metres").collect()
    want = brute_knn(points, 6, haversine)
    # Near-equal distances may swap by rounding; the distances themselves must agree.
    for a in points:
        mine = [r["meters"] for r in sorted(got, key=lambda r: r["rank"]) if r["station_key"] == a]
        theirs = [haversine(points[a], points[b]) for _, b, _ in sorted((x for x in want if x[0] == a), key=lambda x: x[2])]
        assert mine == pytest.approx(theirs, abs=1e-6)
    planar = brute_knn(points, 6, lambda p, q: math.dist(p, q))
    assert planar != want


def test_every_tile_is_filled_evenly(stations):
    spots = proximity.locations(stations, 3)
    assert spots.select(F.max(F.size("keys"))).first()[0] == 3
    made = tiles.tile_points(spots, "loc", 10, max_rows=30)
    sizes = [r["n"] for r in made.tiles.collect()]
    assert min(sizes) >= 10 and max(sizes) < 20 and sum(sizes) == spots.count()


@pytest.mark.parametrize("metric", ["degrees", "metres"])
def test_candidates_hold_the_nearest_and_respect_the_radius(points, stations, metric):
    distance = math.dist if metric == "degrees" else haversine
    radius = 0.01 if metric == "degrees" else 1000.0
    distinct = {p: min(k for k, q in points.items() if q == p) for p in points.values()}
    made = tiles.tile_points(proximity.locations(stations, 1), "loc", 2)
    assert len(made.levels()) > 1
    rng = random.Random(9)
    asked = {i: (-74.1 + rng.random() * 0.3, 40.55 + rng.random() * 0.3) for i in range(60)}
    queries = stations.sparkSession.createDataFrame(
        [(i, x, y, i // 7) for i, (x, y) in asked.items()], "qid bigint, qx double, qy double, batch int"
    )
    open_, limited = (
        tiles.candidates(q, made, 2, METRICS[metric]).collect()
        for q in (queries, queries.withColumn("radius", F.lit(radius)))
    )
    for i, q in asked.items():
        order = sorted((distance(q, p), k) for p, k in distinct.items())
        found = {r["loc"] for r in open_ if r["qid"] == i}
        assert {k for _, k in order[:2]} <= found
        near = {r["loc"] for r in limited if r["qid"] == i}
        assert {k for d, k in order[:2] if d <= radius} <= near <= {k for d, k in order if d <= radius}


def test_nearest_to_skips_co_located(station_rows):
    st = station_rows([(1, -74.0, 40.7, 99), (2, -74.0, 40.7, 5), (3, -73.99, 40.7, None), (4, -73.9, 40.7, 7)])
    got = proximity.nearest_to(st).collect()
    assert [(r["busiest_station"], r["alternative"]) for r in got] == [("Station 1", "Station 3"), ("Station 1", "Station 4")]
    assert got[0]["metres"] == round(haversine((-74.0, 40.7), (-73.99, 40.7)))


def test_within_radius_edge(points, stations):
    centre = (-74.0, 40.7)
    got = {r["station_key"] for r in proximity.within_radius(stations, *centre, 3000).collect()}
    assert got == {k for k, p in points.items() if haversine(p, centre) <= 3000}
    assert proximity.within_radius(stations, 0.0, 89.9999, 5_000_000).count() == 0


def brute_dbscan(xy, eps, minpts):
    near = {a: [b for b, q in xy.items() if math.dist(p, q) <= eps] for a, p in xy.items()}
    core = {a for a in xy if len(near[a]) >= minpts}
    label = {}
    for a in sorted(core):
        if a in label:
            continue
        todo = [a]
        label[a] = a
        while todo:
            for b in near[todo.pop()]:
                if b in core and b not in label:
                    label[b] = a
                    todo.append(b)
    for a in xy:
        if a not in core:
            label[a] = min((label[b] for b in near[a] if b in core), default=None)
    return label


@pytest.mark.parametrize("pair_limit", [16384, 1])
@pytest.mark.parametrize("eps", [400.0, 1500.0])
def test_dbscan(points, stations, monkeypatch, pair_limit, eps):
    # A limit of one point pair forces the boxes to be split all the way.
    monkeypatch.setattr(clusters, "PAIR_LIMIT", pair_limit)
    merc = {
        k: (6378137.0 * math.radians(x), 6378137.0 * math.log(math.tan(math.pi / 4 + math.radians(y) / 2)))
        for k, (x, y) in points.items()
    }
    got = {r["station_key"]: r["cluster"] for r in clusters.dbscan(stations, eps).collect()}
    assert got == brute_dbscan(merc, eps, 5)
    sizes = clusters.cluster_sizes(clusters.dbscan(stations, eps), n=100)
    assert sum(r["stations"] for r in sizes.collect()) == len(points)


def plane(lon, lat):
    return lon, lat


def test_dbscan_border_point_takes_the_smaller_cluster(station_rows):
    left = [(10 + i, 0.1 * i, 0.0) for i in range(5)]
    right = [(1 + i, 2.3 + 0.1 * i, 0.0) for i in range(5)]
    st = station_rows([*left, *right, (99, 1.35, 0.0), (50, 9.0, 9.0)])
    got = {r[0]: r[1] for r in clusters.dbscan(st, 0.95, 5, project=plane).collect()}
    assert got[10] == 10 and got[1] == 1 and got[99] == 1 and got[50] is None


def test_dbscan_reach_is_inclusive(station_rows):
    st = station_rows([(k, 3.0 * k, 0.0) for k in range(1, 6)])
    assert {r[1] for r in clusters.dbscan(st, 3.0, 2, project=plane).collect()} == {1}
    assert {r[1] for r in clusters.dbscan(st, 2.999, 2, project=plane).collect()} == {None}


@pytest.mark.parametrize("hot", [10, 100_000])
def test_components(spark, monkeypatch, hot):
    monkeypatch.setattr(skew, "HOT_ROWS", hot)
    rng = random.Random(1)
    path = list(range(200))
    rng.shuffle(path)
    edges = list(zip(path, path[1:])) + [(300 + i, 300) for i in range(1, 50)] + [(400, 400)]
    nodes = spark.createDataFrame([(n,) for n in [*range(200), *range(300, 350), 400, 500]], "node bigint")
    got = dict(comp.components(nodes, spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {**{n: 0 for n in range(200)}, **{n: 300 for n in range(300, 350)}, 400: 400, 500: 500}


def ring_area(ring):
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1]))) / 2


def brute_cells(points):
    distinct = sorted(set(points.values()))
    outline = [tuple(p) for p in polygons.hull(np.array(distinct))]
    cells = {}
    for p in distinct:
        ring = outline
        for q in sorted(distinct, key=lambda q: math.dist(p, q)):
            if q != p and ring:
                ring = polygons.closer_part(ring, p, q)
        cells[p] = ring_area(ring)
    return cells, ring_area(outline)


def test_service_cells_match_clipping_by_every_station(points, stations, monkeypatch):
    monkeypatch.setattr(regions, "FIRST_NEIGHBOURS", 3)
    want, whole = brute_cells(points)
    rows = regions.service_cells(stations).collect()
    got = {(r["x"], r["y"]): ring_area([(p["lon"], p["lat"]) for p in r["ring"]]) for r in rows}
    assert got.keys() == want.keys()
    for p, area in want.items():
        assert got[p] == pytest.approx(area, rel=1e-6, abs=1e-12)
    assert sum(got.values()) == pytest.approx(whole, rel=1e-9)


def test_cells_deal_stations_to_groups_and_not_to_each_other(spark):
    """Disk of a service area: a station is sent to the groups of tiles around it, not with every station that it may be near to."""
    rng = random.Random(12)
    points = {k: (rng.random() ** 2, rng.random() ** 2) if k % 4 else (0.3 + rng.random() * 1e-4, 0.3 + rng.random() * 1e-4) for k in range(6000)}
    spots = spark.createDataFrame([(k, x, y) for k, (x, y) in points.items()], "loc bigint, x double, y double")
    tiling = tiles.tile_points(spots, "loc", 25)
    dealt = regions.dealt_spots(tiling, 25)
    rows = dealt.collect()
    owner = {r.loc: r.part for r in rows if r.own}
    assert sorted(r.loc for r in rows if r.own) == sorted(points)
    queries = tiling.points.select(F.col("loc").alias("qid"), F.col("x").alias("qx"), F.col("y").alias("qy"), F.col("tile").alias("batch"))
    assert len(rows) <= 6 * 6000 and 4 * len(rows) < tiles.candidates(queries, tiling, 25).count()
    held = {}
    for r in rows:
        held.setdefault(r.part, set()).add(r.loc)
    at = np.array([points[k] for k in range(6000)])
    for k in range(0, 6000, 50):
        assert set(np.argsort(((at - at[k]) ** 2).sum(axis=1))[:25].tolist()) <= held[owner[k]]


def test_first_cells_of_groups_that_cross_batches():
    import pyarrow as pa

    grid = [(float(i), float(j)) for i in range(5) for j in range(5)]
    table = {
        "part": [0] * 25 + [1] * 25, "tile": [0] * 25 + [0] * 25, "own": [True] * 25 + [x == y == 2.0 for x, y in grid],
        "loc": list(range(25)) * 2, "x": [x for x, _ in grid] * 2, "y": [y for _, y in grid] * 2,
    }
    outline = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    batches = pa.Table.from_pydict(table).to_batches(max_chunksize=7)
    out = [r for b in polygons.first_cells(outline, 25)(iter(batches)) for r in b.to_pylist()]
    assert [r["loc"] for r in out] == [*range(25), 12]
    for r in out:
        want = (0.5 if r["x"] in (0, 4) else 1) * (0.5 if r["y"] in (0, 4) else 1)
        assert ring_area([(p["lon"], p["lat"]) for p in r["ring"]]) == want and r["settled"] and r["others"] == []
    # With fewer stations than are asked for, all of them are at hand; corners farther off than a full tile stay open.
    (few,) = polygons.first_cells(outline, 99)(iter(pa.Table.from_pydict(table).slice(0, 25).to_batches()))
    assert set(few.column("sure").to_pylist()) == {math.inf}
    table = {"part": [0] * 3, "tile": [0, 0, 0], "own": [True] * 3, "loc": [1, 2, 3], "x": [0.0, 0.1, 0.1], "y": [0.0, 0.0, 0.1]}
    (far,) = polygons.first_cells(outline, 3)(iter(pa.Table.from_pydict(table).to_batches()))
    assert far.column("settled").to_pylist() == [False] * 3 and [len(o) for o in far.column("others")] == [2] * 3


def test_co_located_stations_share_a_service_area(station_rows):
    st = station_rows([(1, 0.1, 0.1), (2, 0.1, 0.1), (3, 0.9, 0.1), (4, 0.5, 0.9)])
    got = {r["station_key"]: r["km2"] for r in regions.service_areas(st, n=None).collect()}
    assert got[1] == got[2] and len(got) == 4


def test_hull_of_points_on_a_line_and_of_a_square(station_rows):
    square = [(1, 1.0, 1.0), (2, 2.0, 1.0), (3, 2.0, 2.0), (4, 1.0, 2.0), (5, 1.5, 1.5), (6, 1.5, 1.0)]
    ring = regions.convex_hull(station_rows(square)).first()["ring"]
    assert {(p["lon"], p["lat"]) for p in ring} == {(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0)}
    line = regions.network_density(station_rows([(k, 1.0 * k, 1.0 * k) for k in range(1, 5)])).first()
    assert line["network_km2"] == 0.0 and line["stations_per_km2"] is None


def test_hull_drops_nothing_that_is_needed():
    rng = np.random.default_rng(4)
    cloud = rng.normal(size=(3000, 2))
    ring = polygons.hull(cloud)
    for a, b in zip(ring, np.roll(ring, -1, axis=0)):
        assert ((b[0] - a[0]) * (cloud[:, 1] - a[1]) - (b[1] - a[1]) * (cloud[:, 0] - a[0]) >= -1e-9).all()
    assert len(polygons.hull(np.array([[0.0, 0.0], [0.0, 0.0]]))) == 1


def test_area_of_a_known_ring(spark):
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    df = spark.createDataFrame([([{"lon": x, "lat": y} for x, y in ring],)], "ring array<struct<lon:double,lat:double>>")
    got = df.select(geo.area_km2(F.col("ring"))).first()[0]
    exact = (RADIUS / 1000) ** 2 * math.radians(1) * math.sin(math.radians(1))
    assert got == pytest.approx(exact, rel=1e-4)
    assert df.select(geo.area_km2(F.slice("ring", 1, 2))).first()[0] == 0.0


def test_points_in_polygons(spark, points, stations):
    rng = random.Random(2)
    rings = {}
    for i in range(25):
        cx, cy = -74.05 + rng.random() * 0.2, 40.6 + rng.random() * 0.2
        angles = sorted(rng.random() * 2 * math.pi for _ in range(3 + i % 6))
        rings[i] = [(cx + 0.05 * rng.random() * math.cos(t), cy + 0.05 * rng.random() * math.sin(t)) for t in angles]
    polys = spark.createDataFrame(
        [(i, [{"lon": x, "lat": y} for x, y in r]) for i, r in rings.items()],
        "polygon_id bigint, ring array<struct<lon:double,lat:double>>",
    )

    def inside(p, ring):
        hit = False
        for a, b in zip(ring, ring[1:] + ring[:1]):
            if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0]:
                hit = not hit
        return hit

    got = {tuple(r) for r in proximity.points_in_polygons(stations, polys).collect()}
    assert got == {(i, k) for i, r in rings.items() for k, p in points.items() if inside(p, r)}


def test_polygons_deal_points_to_batches_and_not_to_each_of_them(spark):
    rng = random.Random(4)
    points = {k: (rng.random() ** 2, rng.random() ** 2) for k in range(4000)}
    rows = [(k, x, y) for k, (x, y) in points.items()]
    stations = spark.createDataFrame(rows, "station_key bigint, lon double, lat double")
    polys = stations.select(
        F.col("station_key").alias("polygon_id"),
        F.array(*[F.struct((F.col("lon") + a).alias("lon"), (F.col("lat") + b).alias("lat")) for a, b in ((0.1, 0), (0, 0.1), (-0.1, 0), (0, -0.1))]).alias("ring"),
    )
    found = proximity.points_in_polygons(stations, polys).groupBy("polygon_id").agg(F.count(F.lit(1)).alias("n"))
    at = np.array(list(points.values()))
    got = {r.polygon_id: r.n for r in found.collect()}
    for k in range(0, 4000, 100):
        assert got[k] == int((np.abs(at - at[k]).sum(axis=1) < 0.1).sum())
    # What is shuffled grows with points and polygons; pairs of a polygon and a tile were many times that.
    dealt = proximity.dealt_polygons(stations, polys).count()
    tiling = tiles.tile_points(stations.withColumnRenamed("lon", "x").withColumnRenamed("lat", "y"), "station_key", 64)
    pairs = tiles.cover(polys, tiling).count()
    assert dealt <= 4 * 4000 and 2 * dealt < pairs, (dealt, pairs)


def test_pairs_of_overlapping_polygons_repeat_the_same_stations_in_short_order():
    """A result of many pairs is small on disk if the rings that share stations follow each other, block of stations by block."""
    import io

    import pyarrow as pa
    import pyarrow.parquet as pq

    rng = random.Random(21)
    grid = sorted((i // 8, j // 8, i, j) for i in range(160) for j in range(160))    # tiles of 64, in rows
    keys = list(range(len(grid)))
    rng.shuffle(keys)
    at = {k: (i / 1000, j / 1000) for k, (_, _, i, j) in zip(keys, grid)}
    point = pa.RecordBatch.from_pydict({
        "batch": [0] * len(grid), "piece": [0] * len(grid), "kind": [1] * len(grid), "tile": [g[0] * 20 + g[1] for g in grid],
        "station_key": keys, "x": [at[k][0] for k in keys], "y": [at[k][1] for k in keys],
    })
    middle = {n: (0.08 + rng.random() * 0.01, 0.08 + rng.random() * 0.01) for n in range(100)}
    rings = [[{"lon": x + 0.07, "lat": y}, {"lon": x, "lat": y + 0.07}, {"lon": x - 0.07, "lat": y}, {"lon": x, "lat": y - 0.07}] for x, y in middle.values()]
    spot = pa.list_(pa.struct([("lon", pa.float64()), ("lat", pa.float64())]))
    held = pa.RecordBatch.from_pydict({
        "batch": [0] * 100, "piece": [0] * 100, "kind": [0] * 100, "tile": [-1] * 100,
        "polygon_id": pa.array([1000 + n for n in middle]), "ring": pa.array(rings, spot),
    })
    out = pa.Table.from_batches(list(polygons.points_in_rings([held, point])))
    spots = np.array([at[k] for k in keys])
    want = {(1000 + n, keys[p]) for n, c in middle.items() for p in np.flatnonzero(np.abs(spots - c).sum(axis=1) < 0.07)}
    got = list(zip(out.column("polygon_id").to_pylist(), out.column("station_key").to_pylist()))
    assert len(got) == len(want) > 900_000 and set(got) == want
    file = io.BytesIO()
    pq.write_table(out, file, compression="snappy", use_dictionary=["polygon_id"])
    assert len(file.getvalue()) < 1.2 * len(got)    # ring by ring it was 4 bytes a pair


def test_a_polygon_over_everything_is_many_small_pieces(spark):
    rng = random.Random(9)
    points = {k: (rng.random(), rng.random()) for k in range(6000)}
    rows = [(k, x, y) for k, (x, y) in points.items()]
    stations = spark.createDataFrame(rows, "station_key bigint, lon double, lat double")
    rings = {0: [(-1, -1), (2, -1), (2, 2), (-1, 2)], 1: [(-1, -1), (0.5, 0.25), (2, -1), (2, 2), (-1, 2)], 2: [(0.2, 0.2), (0.3, 0.2), (0.25, 0.3)],
             3: [(5, 5), (6, 5), (6, 6)], 4: [(0.1, 0.1), (0.9, 0.1), (0.9, 0.1), (0.5, 0.1)], 5: []}
    polys = spark.createDataFrame(
        [(i, [{"lon": float(x), "lat": float(y)} for x, y in r]) for i, r in rings.items()],
        "polygon_id bigint, ring array<struct<lon:double,lat:double>>",
    )
    got = {}
    for i, k in proximity.points_in_polygons(stations, polys).collect():
        got.setdefault(i, set()).add(k)
    assert got[0] == set(points)
    assert got[1] == {k for k, (x, y) in points.items() if y > (-1 + (x + 1) / 1.5 * 1.25 if x < 0.5 else 0.25 - (x - 0.5) / 1.5 * 1.25)}
    assert 0 < len(got[2]) < 60 and set(got) == {0, 1, 2}

    tiling = tiles.tile_points(stations.withColumnRenamed("lon", "x").withColumnRenamed("lat", "y"), "station_key", 64)
    met = tiles.cover(polys, tiling)
    of = {(r.polygon_id, r.sure): r.n for r in met.groupBy("polygon_id", "sure").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert of[0, True] == tiling.count and (0, False) not in of    # nothing of it is tested point by point
    assert of[1, True] > 3 * of[1, False] and (3, True) not in of
    # The tiles of one polygon are dealt over all tasks.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r.n for r in runtime.spread(met, "polygon_id", "tile").filter("polygon_id = 0").groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 4 and max(sizes) <= 2 * sorted(sizes)[1]


def test_components_of_one_task_equal_the_rounds(spark, rows):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    nodes = spark.range(500).toDF("node")
    want = rows(comp.components(nodes, df))
    assert rows(comp.components(nodes, df, in_one_task=1000)) == want and len(want) == 500
    assert rows(comp.components(nodes, df.limit(0), in_one_task=1000)) == [(i, i) for i in range(500)]


def test_service_grid_gives_every_cell_to_its_nearest(points, stations):
    step = 0.02
    got = {r["station_key"]: r["cells"] for r in proximity.service_grid(stations, step).collect()}
    x0, y0 = min(p[0] for p in points.values()), min(p[1] for p in points.values())
    nx = math.ceil((max(p[0] for p in points.values()) - x0) / step)
    ny = math.ceil((max(p[1] for p in points.values()) - y0) / step)
    want: dict = {}
    for i in range(nx):
        for j in range(ny):
            q = (x0 + (i + 0.5) * step, y0 + (j + 0.5) * step)
            owner = min((math.sqrt((p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2), k) for k, p in points.items())[1]
            want[owner] = want.get(owner, 0) + 1
    assert got == want


def test_pool_buckets_cover_the_unit_interval(stations):
    pool = allocation.decay_pool(stations, k=9).collect()
    by_start: dict = {}
    for r in pool:
        by_start.setdefault(r["start_station_key"], []).append((r["end_station_key"], r["w_lo"], r["w_hi"]))
    assert len(by_start) == 240
    for buckets in by_start.values():
        buckets.sort()
        assert len(buckets) == 9 and buckets[0][1] == 0.0 and buckets[-1][2] == 1.0
        assert all(a[2] == b[1] for a, b in zip(buckets, buckets[1:]))


@pytest.mark.parametrize("slices", [1, 3, 64])
def test_bucket_edges_belong_to_the_upper_bucket(spark, rows, slices):
    buckets = spark.createDataFrame([(1, 0.0, 0.25), (2, 0.25, 0.25), (3, 0.25, 0.5), (4, 0.5, 1.0)], "b int, w_lo double, w_hi double")
    draws = spark.createDataFrame([(0.0,), (0.25,), (0.4999,), (0.5,), (0.9999999999,)], "u double")
    got = allocation.bucket_join(draws, "u", buckets, slices=slices)
    assert rows(got, "u", "b") == [(0.0, 1), (0.25, 3), (0.4999, 3), (0.5, 4), (0.9999999999, 4)]


def test_bucket_join_by_key_keeps_every_draw(spark):
    buckets = spark.createDataFrame(
        [(k, i, i / 10, (i + 1) / 10) for k in (1, 2) for i in range(10)], "key int, b int, w_lo double, w_hi double"
    )
    draws = spark.range(1000).selectExpr("id", "cast(if(id % 3 = 0, 2, 1) as int) as k", "id / 1000 as u")
    got = allocation.bucket_join(draws, "u", buckets, ("k", "key"))
    assert got.count() == 1000
    assert got.filter("k <> key or u < w_lo or u >= w_hi").count() == 0


def test_bucket_join_splits_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(allocation, "SLICE_ROWS", 50)
    buckets = spark.createDataFrame(
        [(k, i, i / 10, (i + 1) / 10) for k in (1, 2) for i in range(10)], "key int, b int, w_lo double, w_hi double"
    )
    draws = spark.range(1000).selectExpr("id", "cast(if(id % 300 = 0, 2, 1) as int) as k", "id / 1000 as u").unionByName(
        spark.sql("select 1000L as id, 1 as k, 0.9999999999999999D as u")
    )
    got = allocation.bucket_join(draws, "u", buckets, ("k", "key"))
    assert sorted(got.columns) == ["b", "id", "k", "key", "u", "w_hi", "w_lo"]
    assert got.count() == 1001 and got.filter("k <> key or u < w_lo or u >= w_hi").count() == 0


def test_split_join_spreads_a_hot_key(spark):
    some = spark.range(3000).selectExpr("id", "if(id % 3 = 0, id, -1) as k")
    rows = some.unionByName(spark.sql("select 3000L as id, cast(null as bigint) as k"))
    side = spark.range(-1, 3000).selectExpr("id as k", "id * 2 as twice")
    got = skew.split_join(rows, side, ["k"], per_group=100)
    assert got.columns == ["k", "id", "twice"]
    assert got.count() == got.select("id").distinct().count() == 3000
    assert got.filter("twice <> 2 * k").count() == 0
    hot = skew.hot_keys(rows, ["k"], 100).collect()
    assert [tuple(r) for r in hot] == [(-1, 20)]
    group = F.pmod(F.xxhash64("id", "k"), F.lit(20))
    sizes = [r["count"] for r in rows.filter("k = -1").groupBy(group.alias("g")).count().collect()]
    assert len(sizes) == 20 and max(sizes) < 200


def test_spatial_joins_with_a_hot_spot_split(station_rows, monkeypatch):
    rng = random.Random(8)
    placed = [(k, 0.5, 0.5) if k % 3 == 0 else (k, rng.random(), rng.random()) for k in range(1, 61)]
    st = station_rows(placed)

    def all_results():
        near = sorted(tuple(r) for r in proximity.knn_join(st, 3).select("station_key", "rank", "neighbour_key").collect())
        groups = sorted(tuple(r) for r in clusters.dbscan(st, 0.15, 4, project=plane).collect())
        areas = {r["station_key"]: r["service_km2"] for r in regions.service_areas(st, n=None).collect()}
        return near, groups, areas

    whole = all_results()
    monkeypatch.setattr(skew, "HOT_ROWS", 4)
    assert all_results() == whole


def test_segments_beyond_a_thousand(spark):
    df = spark.range(6000).selectExpr("id", "0 as k", "1L as v")
    cut, was_cut = segments.add_segments(df, ["k"], ["id"], max_rows=3)
    assert was_cut and cut.select("_seg").distinct().count() > 1500
    out = segments.running_sum(df, ["k"], ["id"], "v", "s", max_rows=3)
    assert out.filter("s <> id + 1").count() == 0 and out.count() == 6000


def test_measured_profiles(spark):
    # Eastern time is 5 hours behind in January: Friday 12, Saturday 13 and, at 03:30 UTC, still Saturday.
    times = ["2024-01-12 13:10:00", "2024-01-12 13:50:00", "2024-01-12 23:00:00", "2024-01-13 15:00:00", "2024-01-14 03:30:00"]
    trips = spark.createDataFrame([(t,) for t in times], "t string").selectExpr("cast(t as timestamp) as started_at")
    shares = allocation.hour_profile(trips).collect()
    assert len(shares) == 48 and sum(r["share"] for r in shares) == pytest.approx(2.0)
    got = {(r["weekend"], r["h"]): r["share"] for r in shares if r["trips"]}
    assert got == {(False, 8): pytest.approx(2 / 3), (False, 18): pytest.approx(1 / 3), (True, 10): 0.5, (True, 22): 0.5}
    hours = allocation.apportion(trips).collect()
    assert len(hours) == 48 and sum(r["trips"] for r in hours) == 5
    # One day of each kind: season and class both count its size, 3 of 2.5 and 2 of 2.5.
    want = 2.5 * (3 / 2.5) ** 2 * 2 / 3
    assert [r["expected"] for r in hours if str(r["day"]) == "2024-01-12" and r["h"] == 8] == [pytest.approx(want)]


def dms(d, m, s):
    return math.copysign(abs(d) + m / 60 + s / 3600, d)


def test_geodesics_and_areas_on_the_spheroid(spark):
    known = [
        # Flinders Peak to Buninyong, the published example of the Australian geodetic manual (GRS 80)
        (dms(144, 25, 29.52440), dms(-37, 57, 3.72030), dms(143, 55, 35.38390), dms(-37, 39, 10.15610), 54972.271),
        (0.0, 0.0, 0.0, 90.0, 10001965.7293),       # a quarter of a meridian
        (10.0, 0.0, 11.0, 0.0, 111319.4908),        # a degree of the equator
        (179.5, 0.0, -179.5, 0.0, 111319.4908),     # across the date line
        (5.0, 50.0, 5.0, 50.0, 0.0),
    ]
    df = spark.createDataFrame([(*map(float, k),) for k in known], "a double, b double, c double, d double, want double")
    for r in df.select("want", geo.geodesic_m(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("got")).collect():
        assert abs(r.got - r.want) < 1e-3
    opposite = df.limit(1).select(geo.geodesic_m(F.lit(0.0), F.lit(0.0), F.lit(179.9), F.lit(0.1))).first()[0]
    assert opposite is None
    ring = "array<struct<lon:double,lat:double>>"
    globe = [(-180.0, -90.0), (180.0, -90.0), (180.0, 90.0), (-180.0, 90.0)]
    small = [(0.0, 45.0), (0.001, 45.0), (0.001, 45.001), (0.0, 45.001)]
    rows = [([{"lon": x, "lat": y} for x, y in r],) for r in (globe, small, small[:2], [])]
    got = [r[0] for r in spark.createDataFrame(rows, f"ring {ring}").select(geo.spheroid_km2(F.col("ring"))).collect()]
    assert abs(got[0] - 510065621.724) < 0.01      # surface of the WGS 84 spheroid
    # radii of curvature at 45 degrees
    e2 = geo.FLATTENING * (2 - geo.FLATTENING)
    s2 = math.sin(math.radians(45.0005)) ** 2
    north, east = geo.SEMI_MAJOR_M * (1 - e2) / (1 - e2 * s2) ** 1.5, geo.SEMI_MAJOR_M / math.sqrt(1 - e2 * s2)
    want = north * east * math.radians(0.001) ** 2 * math.cos(math.radians(45.0005)) / 1e6
    assert got[1] == pytest.approx(want, rel=1e-7) and got[2:] == [0.0, 0.0]


def test_cells_are_clipped_from_columns():
    """A batch passes as columns: a new cell starts from the outline, a held one from its ring, the rest stays as it is."""
    import pyarrow as pa

    spot = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))
    ring = pa.list_(pa.struct([("lon", pa.float64()), ("lat", pa.float64())]))
    square = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
    half = [{"lon": x, "lat": y} for x, y in [(0.0, 0.0), (1.0, 0.0), (1.0, 2.0), (0.0, 2.0)]]
    batch = pa.RecordBatch.from_pydict(
        {
            "loc": pa.array([7, 1, 2, 3]), "x": pa.array([0.5] * 4), "y": pa.array([0.5] * 4),
            "others": pa.array([[{"x": 9.0, "y": 9.0}]] * 4, spot),
            "todo": pa.array([[{"x": 8.0, "y": 8.0}], [{"x": 1.5, "y": 0.5}], [], [{"x": 0.5, "y": 1.5}]], spot),
            "ring": pa.array([None, None, None, half], ring),
        }
    ).slice(1)
    (out,) = regions._clip_step(square)(iter([batch]))
    assert out.drop_columns(["ring"]).equals(batch.drop_columns(["ring"]))
    rings = [{(p["lon"], p["lat"]) for p in r} for r in out.column("ring").to_pylist()]
    assert rings == [{(0, 0), (1, 0), (1, 2), (0, 2)}, set(square), {(0, 0), (1, 0), (1, 1), (0, 1)}]


def test_dbscan_starts_no_task_for_every_shuffle_partition(spark, station_rows):
    st = station_rows([(i, float(i // 6), 0.01 * (i % 6)) for i in range(30)] + [(30, 50.0, 0.0)])
    before, tracker = spark.conf.get("spark.sql.shuffle.partitions"), spark.sparkContext.statusTracker()
    spark.conf.set("spark.sql.shuffle.partitions", "97")
    spark.sparkContext.setJobGroup("one-dbscan", "")
    try:
        got = {r[0]: r[1] for r in clusters.dbscan(st, 0.15, 4, project=lambda lon, lat: (lon, lat)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("one-dbscan") for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(s.numTasks for s in stages if s) < 97
    assert got == {**{i: i // 6 * 6 for i in range(30)}, 30: None}
