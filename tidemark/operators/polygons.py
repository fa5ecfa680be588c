"""Outlines of cell sets.

An edge of a cell is on the outline if the cell across is not in the set.  Its two
corners are named by the three cells that meet there, so edges join up exactly,
without comparing coordinates.  Only the outline of one cluster at a time reaches
Python, to be strung into rings.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import grid


def outline_edges(clusters: DataFrame, resolution: int) -> DataFrame:
    """``cluster_id`` and one directed edge per row, the inside on its left."""
    cells = clusters.select("cluster_id", F.explode("h3_cells").alias("cell"))
    around = cells.select("cluster_id", "cell", grid.ring(F.col("cell"), resolution).alias("r"), grid.centre_point(F.col("cell")).alias("c"))
    around = around.select("cluster_id", "cell", "c", "r", F.posexplode_outer("r").alias("i", "m"))
    n = F.size("r")
    mate = lambda step: F.get("r", F.pmod(F.col("i") + step + n, n).cast("int"))

    def corner(a, b) -> Column:
        key = F.array_join(F.array_sort(F.array(F.col("cell"), a["cell"], b["cell"])), "|")
        axis = lambda k: F.col("c")[k] + a[k] + b[k]
        x, y, z = axis("x"), axis("y"), axis("z")
        lat = F.degrees(F.atan2(z, F.sqrt(x * x + y * y)))
        return F.struct(key.alias("key"), F.degrees(F.atan2(y, x)).alias("lon"), lat.alias("lat"))

    edges = around.select(
        "cluster_id", F.col("m.cell").alias("across"), corner(mate(-1), F.col("m")).alias("a"), corner(F.col("m"), mate(1)).alias("b")
    )
    own = cells.select(F.col("cluster_id").alias("own_id"), F.col("cell").alias("own_cell"))
    inside = (F.col("cluster_id") == F.col("own_id")) & (F.col("across") == F.col("own_cell"))
    return edges.join(own, inside, "left_anti").select("cluster_id", "a.*", F.col("b.key").alias("next"))


def rings(edges: list[tuple[str, float, float, str]]) -> list[list[tuple[float, float]]]:
    """Closed rings of (lon, lat) from directed edges (key, lon, lat, next key)."""
    at = {k: (lon, lat) for k, lon, lat, _ in edges}
    ahead: dict[str, list[str]] = {}
    for k, _, _, nxt in sorted(edges, key=lambda e: (e[0], e[3])):
        ahead.setdefault(k, []).append(nxt)
    out = []
    for first in sorted(ahead):
        while ahead[first]:
            walk, k = [first], ahead[first].pop(0)
            while k != first:
                walk.append(k)
                k = ahead[k].pop(0)
            out.append([at[x] for x in walk] + [at[first]])
    return out


def area(ring: list[tuple[float, float]]) -> float:
    """Signed, positive if counter-clockwise."""
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:], strict=False)) / 2


def _within(p: tuple[float, float], ring: list[tuple[float, float]]) -> bool:
    inside = False
    for a, b in zip(ring, ring[1:], strict=False):
        if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0]:
            inside = not inside
    return inside


def polygons(found: list[list[tuple[float, float]]]) -> list[list[list[tuple[float, float]]]]:
    """Rings as polygons: each hole goes with the smallest outer ring around it."""
    outer = sorted((r for r in found if area(r) > 0), key=area)
    made = [[r] for r in outer]
    for hole in (r for r in found if area(r) < 0):
        mid = ((hole[0][0] + hole[1][0]) / 2, (hole[0][1] + hole[1][1]) / 2)
        home = next((m for m in made if _within(mid, m[0])), None)
        if home:
            home.append(hole)
    return sorted(made, key=lambda m: m[0][0])


def wkt(made: list[list[list[tuple[float, float]]]]) -> str | None:
    if not made:
        return None
    ring = lambda r: "(" + ", ".join(f"{x:.10g} {y:.10g}" for x, y in r) + ")"
    body = ["(" + ", ".join(map(ring, p)) + ")" for p in made]
    return f"POLYGON {body[0]}" if len(body) == 1 else "MULTIPOLYGON (" + ", ".join(body) + ")"


def unrolled(found: list[list[tuple[float, float]]]) -> list[list[tuple[float, float]]]:
    """Rings with longitudes that run on over the antimeridian, all about as far east as the first.

    A ring that does not come back to its longitude goes round a pole: it is closed along the pole's
    parallel, so that what it encloses on the map is what it encloses on the globe.
    """
    out: list[list[tuple[float, float]]] = []
    for ring in found:
        line = [ring[0]]
        for lon, lat in ring[1:]:
            line.append((lon - 360 * round((lon - line[-1][0]) / 360), lat))
        if abs(line[-1][0] - line[0][0]) > 180:
            pole = 90.0 if sum(p[1] for p in line) > 0 else -90.0
            line += [(line[-1][0], pole), (line[0][0], pole), line[0]]
        middle = lambda r: sum(p[0] for p in r) / len(r)
        shift = 360 * round((middle(line) - middle(out[0])) / 360) if out else 0
        out.append([(lon - shift, lat) for lon, lat in line])
    return out


def _cut(ring: list[tuple[float, float]], at: float, side: int) -> list[tuple[float, float]]:
    """The part of a ring on one side of a meridian (1: east, -1: west), closed along it; empty if there is none."""
    out: list[tuple[float, float]] = []
    for a, b in zip(ring, ring[1:], strict=False):
        if (a[0] - at) * side >= 0:
            out.append(a)
        if (a[0] - at) * (b[0] - at) < 0:
            out.append((at, a[1] + (b[1] - a[1]) * (at - a[0]) / (b[0] - a[0])))
    out = [p for k, p in enumerate(out) if p != out[k - 1]]
    return [*out, out[0]] if len(out) > 2 and abs(area([*out, out[0]])) > 0 else []


def on_map(made: list[list[list[tuple[float, float]]]]) -> list[list[list[tuple[float, float]]]]:
    """Polygons cut at the antimeridian, each part with longitudes from -180 to 180."""
    out = []
    for polygon in made:
        lons = [p[0] for p in polygon[0]]
        for k in range(math.floor((min(lons) + 180) / 360), math.ceil((max(lons) + 180) / 360)):
            parts = [_cut(_cut(r, 360 * k - 180, 1), 360 * k + 180, -1) for r in polygon]
            parts = [[(lon - 360 * k, lat) for lon, lat in r] for r in parts if r]
            if parts:
                out.append(parts)
    return out


def shapes(edges: list[tuple[str, float, float, str]]) -> list[list[list[tuple[float, float]]]]:
    """Polygons of a set's outline; those that cross the antimeridian or hold a pole are cut."""
    found = rings(edges)
    if all(abs(a[0] - b[0]) <= 180 for r in found for a, b in zip(r, r[1:], strict=False)):
        return polygons(found)
    return on_map(polygons(unrolled(found)))


def add_polygons(clusters: DataFrame, resolution: int) -> DataFrame:
    """``clusters`` with ``geometry_wkt``; null where there are no cells."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        edges = [(r.key, float(r.lon), float(r.lat), r.next) for r in pdf.itertuples() if not math.isnan(r.lon)]
        return pd.DataFrame({"_id": [int(pdf["cluster_id"].iloc[0])], "geometry_wkt": [wkt(shapes(edges))]})

    made = outline_edges(clusters, resolution).groupBy("cluster_id").applyInPandas(one, "_id int, geometry_wkt string")
    return clusters.join(made, F.col("cluster_id") == F.col("_id"), "left").drop("_id")
