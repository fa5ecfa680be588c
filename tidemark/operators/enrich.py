"""Phase 4: outline, nearest city and country of each cluster."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.config import CellConfig, EnrichConfig
from tidemark.functions.columns import let
from tidemark.functions.geo import haversine_meters
from tidemark.operators.polygons import add_polygons
from tidemark.session import counted, materialise

#: Cubes of the first round have an edge of 2 / 2 ** FIRST earth radii (fewer than 400 of them meet the globe), those of the last of 6 m.
FIRST, LAST = 3, 21
#: A cube's places are compared with its cities one by one once it has no more of them than this.
CITIES = 96
#: Square of a distance in earth radii, far above what rounding can make of equal distances: whatever comes so close to the nearest is compared by its distance in metres.
SLACK = 1e-12
AXES = ("x", "y", "z")


def _located(df: DataFrame) -> DataFrame:
    """Rows whose ``lat`` and ``lon`` are numbers, with their place in space; the globe has radius 1."""
    lat, lon = F.radians("lat"), F.radians("lon")
    out = df.withColumns({"x": F.cos(lat) * F.cos(lon), "y": F.cos(lat) * F.sin(lon), "z": F.sin(lat)})
    return out.where("NOT isnan(x) AND NOT isnan(y) AND NOT isnan(z)")


def _cube(level: int) -> Column:
    """The number of the cube with edge ``2 / 2 ** level`` that holds ``x, y, z``."""
    n = 1 << level
    at = [F.least(F.floor((F.col(a) + 1.0) * (n / 2)), F.lit(n - 1)) for a in AXES]
    return (at[0] * n + at[1]) * n + at[2]


def _cubes(points: DataFrame, level: int, tag: str) -> DataFrame:
    """The cubes that hold points: number, the number of the one around, how many points, and the box that they fill."""
    box = [f(a).alias(f"{tag}_{name}_{a}") for a in AXES for f, name in ((F.min, "low"), (F.max, "high"))]
    return points.groupBy(_cube(level).alias(tag), _cube(level - 1).alias(f"{tag}_up")).agg(F.count("*").alias(f"{tag}_n"), *box)


def _reachable(pairs: DataFrame) -> DataFrame:
    """Pairs of a cube of places and one of cities that can hold the nearest city of one of the places; ``cities``: how many a cube of places has.

    No city of a cube is nearer than the gap between the boxes, none is farther than their
    far corners, and the least such far distance is one that every place has a city within.
    """
    p, c = (lambda name, a, t=t: F.col(f"{t}_{name}_{a}") for t in "pc")
    gaps = [F.greatest(c("low", a) - p("high", a), p("low", a) - c("high", a), F.lit(0.0)) for a in AXES]
    spans = [F.greatest(c("high", a) - p("low", a), p("high", a) - c("low", a)) for a in AXES]
    square = lambda v: reduce(lambda s, d: s + d, [d * d for d in v])
    mine = Window.partitionBy("p")
    kept = pairs.select("p", "c", "c_n", square(gaps).alias("gap"), F.min(square(spans)).over(mine).alias("far")).where(F.col("gap") <= F.col("far") + SLACK)
    return kept.select("p", "c", F.sum("c_n").over(mine).alias("cities"))


def _compared(places: DataFrame, cities: DataFrame, pairs: DataFrame, level: int) -> DataFrame:
    """For each place, the cities of its cube's partners that are nearest or so close to it that rounding decides."""
    near = pairs.join(cities.withColumn("c", _cube(level)), "c").groupBy("p").agg(F.collect_list(F.struct(*AXES, "lat", "lon")).alias("near"))
    # The greater the product of two places, the nearer they are: half their distance's square is missing to 1.
    product = lambda c: reduce(lambda s, d: s + d, [F.col(a) * c[a] for a in AXES])
    measured = F.transform("near", lambda c: F.struct(product(c).alias("dot"), c["lat"].alias("lat"), c["lon"].alias("lon")))
    best = lambda m: let(F.array_max(m["dot"]), lambda top: F.filter(m, lambda c: c["dot"] >= top - SLACK / 2))
    found = places.withColumn("p", _cube(level)).join(near, "p").select("lat", "lon", F.explode(let(measured, best)).alias("c"))
    return found.select("lat", "lon", F.col("c.lat").alias("c_lat"), F.col("c.lon").alias("c_lon"))


def nearest_city(places: DataFrame, cities: DataFrame, key: str, lat: str, lon: str) -> DataFrame:
    """The nearest of ``cities`` (``name, admin1, cc, lat, lon``) for every place with coordinates; ties go to the least name.

    Places and cities are put into cubes of space, which have neither poles nor a date
    line, and pairs of cubes that cannot hold a nearest city are dropped.  Cubes of
    places with many cities left are halved along each edge, and so are their partners,
    until few cities are left; only then are places and cities compared.  So a place
    meets some ``CITIES``, however many there are and however dense they lie.
    Equal places are one, and of cities at one place the least name stands for all.
    Where no distance is a number, all are taken as equal.  With an empty gazetteer, there are no rows.
    """
    want = places.select(F.col(key).alias("_key"), F.col(lat).alias("lat"), F.col(lon).alias("lon")).where("lat IS NOT NULL AND lon IS NOT NULL")
    known = cities.where("lat IS NOT NULL AND lon IS NOT NULL").groupBy("lat", "lon").agg(F.min(F.struct("name", "admin1", "cc")).alias("city"))
    spots = materialise(_located(want.select("lat", "lon").distinct()), "spots")
    known = materialise(known, "cities")
    towns = materialise(_located(known.select("lat", "lon")), "towns")
    pairs, found = _cubes(spots, FIRST, "p").crossJoin(F.broadcast(_cubes(towns, FIRST, "c"))), []
    for level in range(FIRST, LAST + 1):
        pairs, left = counted(_reachable(pairs), "reachable", total=f"count_if(cities > {CITIES})")
        done = pairs.where(F.col("cities") <= CITIES) if level < LAST else pairs
        if not left or not done.isEmpty():
            found.append(_compared(spots, towns, done.select("p", "c"), level))
        if not left or level == LAST:
            break
        up = pairs.where(F.col("cities") > CITIES).select(F.col("p").alias("p_up"), F.col("c").alias("c_up"))
        pairs = up.join(_cubes(towns, level + 1, "c"), "c_up").join(_cubes(spots, level + 1, "p"), "p_up")
    m = haversine_meters(F.col("lat"), F.col("lon"), F.col("c_lat"), F.col("c_lon"))
    named = known.select(F.col("lat").alias("c_lat"), F.col("lon").alias("c_lon"), "city")
    close = reduce(DataFrame.unionByName, found).withColumn("m", m).join(named, ["c_lat", "c_lon"])
    best = close.groupBy("lat", "lon").agg(F.min(F.struct("m", "city", "c_lat", "c_lon")).alias("b"))
    least = known.agg(F.min(F.struct(F.lit(float("nan")).alias("m"), "city", F.col("lat").alias("c_lat"), F.col("lon").alias("c_lon"))).alias("least")).where("least IS NOT NULL")
    all_ = want.join(best, ["lat", "lon"], "left").crossJoin(F.broadcast(least)).withColumn("b", F.coalesce("b", "least"))
    return all_.select(
        F.col("_key").alias(key),
        F.col("b.city.cc").alias("country_iso2"),
        F.col("b.city.name").alias("nearest_city"),
        F.col("b.c_lat").alias("nearest_city_lat"),
        F.col("b.c_lon").alias("nearest_city_lon"),
        (F.col("b.m") / 1000.0).alias("nearest_city_dist_km"),
        F.col("b.city.admin1").alias("admin1"),
    )


def country_name(df: DataFrame, countries: DataFrame, iso2: str = "country_iso2") -> DataFrame:
    """``df`` with ``country_name`` from ``countries`` (``iso2, name``): empty for an empty code, the code if unknown.

    Country codes are two letters, so the table has at most 676 rows to broadcast.
    """
    names = countries.where("length(iso2) = 2").groupBy("iso2").agg(F.min("name").alias("_name"))
    out = df.join(F.broadcast(names), F.col(iso2) == F.col("iso2"), "left").drop("iso2") if iso2 != "iso2" else df.join(F.broadcast(names), "iso2", "left")
    return out.withColumn("country_name", F.when(F.coalesce(iso2, F.lit("")) == "", "").otherwise(F.coalesce("_name", iso2))).drop("_name")


def enrich(clusters: DataFrame, cities: DataFrame, countries: DataFrame, cfg: EnrichConfig | None = None, grid_cfg: CellConfig | None = None) -> DataFrame:
    """Clusters in the 21 columns of the contract."""
    cfg, grid_cfg = cfg or EnrichConfig(), grid_cfg or CellConfig()
    if cfg.enforce_population and "population" in cities.columns:
        cities = cities.where(F.col("population") >= cfg.city_min_population)
    found = nearest_city(clusters, cities, "cluster_id", "centroid_lat", "centroid_lon")
    out = add_polygons(clusters, grid_cfg.h3_resolution).join(found, "cluster_id", "left")
    return schemas.conform(country_name(out, countries), schemas.ENRICHED)
