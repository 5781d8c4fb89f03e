"""Geometry on plain lon/lat columns: distances, projections, areas, predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371008.8      # mean earth radius
MERCATOR_RADIUS_M = 6378137.0   # sphere of the web projection
# The WGS 84 spheroid (fixed values).
SEMI_MAJOR_M = 6378137.0
FLATTENING = 1 / 298.257223563
GEODESIC_ROUNDS = 16


def has_point(lon: Column, lat: Column) -> Column:
    """A usable coordinate pair: present, and neither part is exactly zero."""
    return lon.isNotNull() & lat.isNotNull() & (lon != 0) & (lat != 0)


def point(lon: Column, lat: Column) -> Column:
    return F.struct(lon.alias("lon"), lat.alias("lat"))


def distance_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres (haversine on the mean sphere)."""
    dlat = F.radians(lat2 - lat1) / F.lit(2.0)
    dlon = F.radians(lon2 - lon1) / F.lit(2.0)
    chord = F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.sin(dlon) * F.sin(dlon)
    return F.lit(2.0 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def geodesic_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Length in metres of the geodesic on the WGS 84 spheroid, to well under a millimetre.

    The longitude on the auxiliary sphere is iterated a fixed number of rounds (Vincenty's inverse formula). It settles unless
    the points are nearly opposite each other on the globe, where the result is null.
    """
    b, f = SEMI_MAJOR_M * (1 - FLATTENING), FLATTENING

    def reduced(lat: Column) -> Column:
        return F.atan(F.lit(1 - f) * F.tan(F.radians(lat)))

    def with_ends(ends: Column) -> Column:
        s1, c1, s2, c2, apart = (ends[k] for k in ("s1", "c1", "s2", "c2", "apart"))

        def arc(lam: Column, use) -> Column:
            """``use`` of the great circle that spans ``lam`` on the auxiliary sphere."""

            def sides(v: Column) -> Column:
                sine = F.hypot(c2 * v["sin"], c1 * s2 - s1 * c2 * v["cos"])
                return F.struct(sine.alias("s"), (s1 * s2 + c1 * c2 * v["cos"]).alias("c"), v["sin"].alias("lam_sin"))

            def angles(v: Column) -> Column:
                sin_a = F.coalesce(F.try_divide(c1 * c2 * v["lam_sin"], v["s"]), F.lit(0.0))
                return F.struct(v["s"], v["c"], F.atan2(v["s"], v["c"]).alias("sigma"), sin_a.alias("sin_a"), (1 - sin_a * sin_a).alias("cos2_a"))

            def middle(v: Column) -> Column:
                m = v["c"] - F.when(v["cos2_a"] > 1e-24, 2 * s1 * s2 / F.greatest(v["cos2_a"], F.lit(1e-24))).otherwise(0.0)
                return F.struct(v["s"], v["c"], v["sigma"], v["sin_a"], v["cos2_a"], m.alias("m"))

            first = F.struct(F.sin(lam).alias("sin"), F.cos(lam).alias("cos"))
            return _let(first, lambda v: _let(sides(v), lambda w: _let(angles(w), lambda x: _let(middle(x), use))))

        def better(v: Column) -> Column:
            c = F.lit(f / 16) * v["cos2_a"] * (4 + F.lit(f) * (4 - 3 * v["cos2_a"]))
            turn = v["m"] + c * v["c"] * (2 * v["m"] * v["m"] - 1)
            return apart + (1 - c) * F.lit(f) * v["sin_a"] * (v["sigma"] + c * v["s"] * turn)

        def length(v: Column) -> Column:
            u2 = v["cos2_a"] * F.lit((SEMI_MAJOR_M**2 - b**2) / b**2)
            scale = 1 + u2 / 16384 * (4096 + u2 * (u2 * (320 - 175 * u2) - 768))
            bend = u2 / 1024 * (256 + u2 * (u2 * (74 - 47 * u2) - 128))
            m2 = v["m"] * v["m"]
            inner = v["c"] * (2 * m2 - 1) - bend / 6 * v["m"] * (4 * v["s"] * v["s"] - 3) * (4 * m2 - 3)
            return F.lit(b) * scale * (v["sigma"] - bend * v["s"] * (v["m"] + bend / 4 * inner))

        def step(state: Column, _: Column) -> Column:
            return F.struct(arc(state["lam"], better).alias("lam"), state["lam"].alias("before"))

        start = F.struct(apart.alias("lam"), apart.alias("before"))
        rounds = F.sequence(F.lit(1), F.lit(GEODESIC_ROUNDS))
        found = F.aggregate(rounds, start, step, lambda v: v)
        return _let(found, lambda v: F.when(F.abs(v["lam"] - v["before"]) < 1e-11, arc(v["lam"], length)))

    # The longitudes' difference the short way round.
    turn = (F.pmod(lon2 - lon1 + 180.0, F.lit(360.0)) - 180.0)
    ends = F.struct(
        F.sin(reduced(lat1)).alias("s1"), F.cos(reduced(lat1)).alias("c1"),
        F.sin(reduced(lat2)).alias("s2"), F.cos(reduced(lat2)).alias("c2"), F.radians(turn).alias("apart"),
    )
    return _let(ends, with_ends)


def _authalic(lat: Column) -> Column:
    """Height of a parallel in the equal-area cylindrical projection of the spheroid, in units of the semi-major axis."""
    e2 = FLATTENING * (2 - FLATTENING)
    e = e2**0.5
    s = F.sin(F.radians(lat))
    return F.lit((1 - e2) / 2) * (s / (1 - F.lit(e2) * s * s) + F.log((1 + F.lit(e) * s) / (1 - F.lit(e) * s)) / F.lit(2 * e))


def degree_box(lat: Column, metres: Column) -> tuple[Column, Column]:
    """Half-widths (lon, lat) in degrees of a box that surely holds ``metres``."""
    half_lat = F.degrees(metres / F.lit(EARTH_RADIUS_M)) * F.lit(1.0 + 1e-9)
    cosine = F.cos(F.radians(F.least(F.abs(lat) + half_lat, F.lit(90.0))))
    sine = F.sin(F.least(metres / F.lit(2.0 * EARTH_RADIUS_M), F.lit(1.5707963)))
    narrow = F.degrees(F.lit(2.0) * F.asin(F.least(sine / cosine, F.lit(1.0))))
    half_lon = F.when(cosine > sine, narrow).otherwise(F.lit(360.0))
    return half_lon * F.lit(1.0 + 1e-9), half_lat


def snap(value: Column, step: float) -> Column:
    """Nearest multiple of ``step``, ties to even."""
    return F.rint(value / F.lit(step)) * F.lit(step)


def _plain_number(value: Column, digits: int) -> Column:
    fixed = F.format_string(f"%.{digits}f", value)
    return F.regexp_replace(F.regexp_replace(fixed, "(\\.[0-9]*?)0+$", "$1"), "\\.$", "")


def point_wkt(lon: Column, lat: Column, digits: int = 4) -> Column:
    """``POINT(lon lat)`` without trailing zeros."""
    return F.concat(
        F.lit("POINT("), _plain_number(lon, digits), F.lit(" "), _plain_number(lat, digits), F.lit(")")
    )


def local_metres(lat0: float):
    """Projector to metres around the parallel ``lat0``, for use in place of ``web_mercator``."""

    def project(lon: Column, lat: Column) -> tuple[Column, Column]:
        scale = F.cos(F.radians(F.lit(lat0))) * F.lit(EARTH_RADIUS_M)
        return F.radians(lon) * scale, F.radians(lat) * F.lit(EARTH_RADIUS_M)

    return project


def web_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Lon/lat degrees to spherical web-mercator units."""
    x = F.lit(MERCATOR_RADIUS_M) * F.radians(lon)
    y = F.lit(MERCATOR_RADIUS_M) * F.log(
        F.tan(F.lit(0.7853981633974483) + F.radians(lat) / F.lit(2.0))
    )
    return x, y


def _closed(ring: Column) -> Column:
    return F.concat(ring, F.slice(ring, 1, 1))


def spheroid_km2(ring: Column) -> Column:
    """Area on the WGS 84 spheroid of a ring, whose sides are straight in the equal-area cylindrical projection.

    Exact for sides along parallels and meridians; for others the error falls with the square of their length.
    """
    flat = F.transform(ring, lambda p: F.struct(F.radians(p["lon"]).alias("x"), _authalic(p["lat"]).alias("y")))
    terms = _let(
        _closed(flat),
        lambda loop: F.zip_with(
            F.slice(loop, 1, F.size(loop) - 1), F.slice(loop, 2, F.size(loop) - 1),
            lambda a, b: (b["x"] - a["x"]) * (a["y"] + b["y"]),
        ),
    )
    total = F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)
    return F.when(F.size(ring) >= 3, F.abs(total) * F.lit(SEMI_MAJOR_M**2 / 2e6)).otherwise(F.lit(0.0))


def area_km2(ring: Column) -> Column:
    """Area on the mean sphere of a ring: ``array<struct<lon,lat>>``, open or closed."""
    loop = _closed(ring)
    head = F.slice(loop, 1, F.size(ring))
    tail = F.slice(loop, 2, F.size(ring))
    terms = F.zip_with(
        head,
        tail,
        lambda a, b: F.radians(b["lon"] - a["lon"])
        * (F.lit(2.0) + F.sin(F.radians(a["lat"])) + F.sin(F.radians(b["lat"]))),
    )
    total = F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)
    area = F.abs(total) * F.lit(EARTH_RADIUS_M * EARTH_RADIUS_M / 2.0 / 1e6)
    return F.when(F.size(ring) >= 3, area).otherwise(F.lit(0.0))


def ring_edges(ring: Column) -> Column:
    """Edges of a ring that can cross a parallel: one struct per edge, ready for ``inside_edges``."""
    loop = _closed(ring)
    edges = F.zip_with(
        F.slice(loop, 1, F.size(ring)),
        F.slice(loop, 2, F.size(ring)),
        lambda a, b: F.struct(
            a["lon"].alias("x"),
            a["lat"].alias("y"),
            b["lat"].alias("to"),
            F.try_divide(b["lon"] - a["lon"], b["lat"] - a["lat"]).alias("slope"),
        ),
    )
    return F.filter(edges, lambda e: e["y"] != e["to"])


def inside_edges(lon: Column, lat: Column, edges: Column) -> Column:
    """Ray-casting test: an odd number of edges lies east of the point."""

    def crosses(e: Column) -> Column:
        straddles = (e["y"] > lat) != (e["to"] > lat)
        return straddles & (lon < e["slope"] * (lat - e["y"]) + e["x"])

    return F.size(F.filter(edges, crosses)) % F.lit(2) == 1


def in_ring(lon: Column, lat: Column, ring: Column) -> Column:
    """Whether a point lies inside a ring."""
    return inside_edges(lon, lat, ring_edges(ring))
