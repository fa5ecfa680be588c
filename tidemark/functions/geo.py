"""Distances and planar geometry as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.columns import let

EARTH_RADIUS_M = 6_371_000.0
METERS_PER_DEGREE = 111_320.0


def haversine_meters(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; the argument of the arc sine is clamped against rounding."""
    half_lat, half_lon = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.asin(F.least(F.sqrt(a), F.lit(1.0))) * (2 * EARTH_RADIUS_M)


def spread_meters(lat: Column, lon: Column) -> Column:
    """Aggregate: root of the summed population variances in metres; 0 for fewer than two rows."""
    north = F.stddev_pop(lat) * METERS_PER_DEGREE
    east = F.stddev_pop(lon) * METERS_PER_DEGREE * F.abs(F.cos(F.radians(F.avg(lat))))
    return F.when(F.count(lat) < 2, F.lit(0.0)).otherwise(F.sqrt(north * north + east * east))


def ring_centroid(ring: Column) -> Column:
    """Planar centroid ``struct<lon, lat>`` of a closed ring ``array<array<double>>``; of a ring without area, the mean point."""
    n = F.size(ring)
    pair = F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0)))
    x = lambda i: F.get(F.get(ring, i), F.lit(0))
    y = lambda i: F.get(F.get(ring, i), F.lit(1))
    cross = lambda i: x(i) * y(i + 1) - x(i + 1) * y(i)
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))
    step = lambda s, i: F.struct(
        (s["a"] + cross(i)).alias("a"),
        (s["x"] + (x(i) + x(i + 1)) * cross(i)).alias("x"),
        (s["y"] + (y(i) + y(i + 1)) * cross(i)).alias("y"),
        (s["mx"] + x(i)).alias("mx"),
        (s["my"] + y(i)).alias("my"),
    )
    done = lambda s: F.when(
        F.abs(s["a"]) > 0, F.struct((s["x"] / (3 * s["a"])).alias("lon"), (s["y"] / (3 * s["a"])).alias("lat"))
    ).otherwise(F.struct((s["mx"] / F.size(pair)).alias("lon"), (s["my"] / F.size(pair)).alias("lat")))
    return F.when(n > 0, F.aggregate(pair, zero, step, done))


def ring_area(ring: Column) -> Column:
    """Planar area of a closed ring, whichever way it runs."""
    at = lambda i, k: F.get(F.get(ring, i), F.lit(k))
    steps = F.sequence(F.lit(0), F.greatest(F.size(ring) - 2, F.lit(0)))
    step = lambda s, i: s + F.coalesce(at(i, 0) * at(i + 1, 1) - at(i + 1, 0) * at(i, 1), F.lit(0.0))
    return F.abs(F.aggregate(steps, F.lit(0.0), step)) / 2


def _added(parts: Column) -> Column:
    """The sums of ``struct<w, x, y>``."""
    zero = F.struct(*[F.lit(0.0).alias(k) for k in "wxy"])
    return F.aggregate(parts, zero, lambda s, p: F.struct(*[(s[k] + p[k]).alias(k) for k in "wxy"]))


def _line_sums(line: Column) -> Column:
    """Length of a line, and the sums of its segments' middles weighted by their lengths."""
    at = lambda p, k: F.get(p, F.lit(k))

    def segment(p: Column, q: Column) -> Column:
        dx, dy = at(q, 0) - at(p, 0), at(q, 1) - at(p, 1)
        w = F.sqrt(dx * dx + dy * dy)
        return F.struct(w.alias("w"), (w * (at(p, 0) + at(q, 0)) / 2).alias("x"), (w * (at(p, 1) + at(q, 1)) / 2).alias("y"))

    n = F.greatest(F.size(line) - 1, F.lit(0))
    return _added(F.zip_with(F.slice(line, F.lit(1), n), F.slice(line, F.lit(2), n), segment))


def _ring_sums(ring: Column, i: Column) -> Column:
    """Area of a polygon's ring, less than 0 for a hole, and its sums of places."""
    area = ring_area(ring) * F.when(i == 0, 1.0).otherwise(-1.0)
    return let(F.struct(area.alias("w"), ring_centroid(ring).alias("c")), lambda r: F.struct(r["w"].alias("w"), *[F.coalesce(r["w"] * r["c"][c], F.lit(0.0)).alias(k) for k, c in (("x", "lon"), ("y", "lat"))]))


#: Collections within collections are opened this many times.
NESTED = 4


def geometry_centroid(geojson: Column) -> Column:
    """Planar centroid ``struct<lon, lat>`` of a GeoJSON geometry's text; null for an empty one and for what is none.

    The parts of highest dimension that have any extent decide: polygons by their area; without area, lines and
    the outlines of polygons by their length; without length, points by their number.
    """
    read = lambda g, t: F.from_json(g, f"coordinates {t}")["coordinates"]
    kind = lambda g: F.get_json_object(g, "$.type")
    pt = "array<double>"
    none = lambda t: F.expr(f"cast(array() as array<{t}>)")

    def opened(parts: Column) -> Column:
        inner = lambda g: F.coalesce(F.from_json(g, "geometries array<string>")["geometries"], none("string"))
        return F.flatten(F.transform(parts, lambda g: F.when(kind(g) == "GeometryCollection", inner(g)).otherwise(F.array(g))))

    def of(parts: Column, one: str, several: str, item: str) -> Column:
        """The items of all parts of a kind, single and in sets."""
        each = lambda g: F.when(kind(g) == one, F.array(read(g, item))).when(kind(g) == several, read(g, f"array<{item}>"))
        found = F.flatten(F.transform(parts, lambda g: F.coalesce(each(g), none(item))))
        return F.filter(found, lambda x: x.isNotNull() & (F.size(x) > 0))

    def reduced(q: Column) -> Column:
        rings = F.flatten(F.transform(q["p"], lambda poly: F.transform(poly, lambda r, i: F.struct(r.alias("r"), i.alias("i")))))
        lines = F.concat(q["l"], F.flatten(q["p"]))
        points = F.concat(q["d"], F.transform(lines, lambda x: F.get(x, F.lit(0))))
        sums = F.struct(
            _added(F.transform(rings, lambda x: _ring_sums(x["r"], x["i"]))).alias("area"), _added(F.transform(lines, _line_sums)).alias("length"),
            _added(F.transform(points, lambda p: F.struct(F.lit(1.0).alias("w"), F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))).alias("n"),
        )
        mean = lambda s: F.struct((s["x"] / s["w"]).alias("lon"), (s["y"] / s["w"]).alias("lat"))
        return let(sums, lambda s: F.when(s["area"]["w"] > 0, mean(s["area"])).when(s["length"]["w"] > 0, mean(s["length"])).when(s["n"]["w"] > 0, mean(s["n"])))

    parts = F.array(geojson)
    for _ in range(NESTED):
        parts = let(parts, opened)
    kinds = lambda g: F.struct(
        of(g, "Polygon", "MultiPolygon", f"array<array<{pt}>>").alias("p"), of(g, "LineString", "MultiLineString", f"array<{pt}>").alias("l"), of(g, "Point", "MultiPoint", pt).alias("d")
    )
    return F.when(geojson.isNotNull(), let(let(parts, kinds), reduced))


def bounds(points: Column) -> Column:
    """``struct<min_lon, min_lat, max_lon, max_lat>`` of ``array<array<double>>``."""
    axis = lambda k: F.transform(points, lambda p: F.get(p, F.lit(k)))
    return F.struct(
        F.array_min(axis(0)).alias("min_lon"), F.array_min(axis(1)).alias("min_lat"),
        F.array_max(axis(0)).alias("max_lon"), F.array_max(axis(1)).alias("max_lat"),
    )
