"""Cell addresses against published examples, and the grid against itself at pentagons and across faces."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import grid
from tidemark.operators.clusters import disks

#: Place, resolution and address, as remembered from public documentation of the index and of engines that offer it.
KNOWN = [
    (37.775938728915946, -122.41795063018799, 9, "8928308280fffff"), (37.3615593, -122.0553238, 7, "87283472bffffff"), (40.689167, -74.044444, 10, "8a2a1072b59ffff"),
    (-3.7038, 40.4168, 4, "847b59dffffffff"), (45.0, 100.0, 6, "86240610fffffff"), (52.516262, 13.377704, 8, "881f1d4887fffff"),
    (-57.9446762, -142.6384407, 5, "85e35e73fffffff"), (37.345793375368, -121.97637597255124, 5, "85283473fffffff"), (37.5012466151, -122.5003039349, 9, "8928342e20fffff"),
]
#: Centres, likewise.
CENTRES = {"85283473fffffff": (37.345793375368, -121.97637597255124), "8928342e20fffff": (37.5012466151, -122.5003039349)}


def cells_at(spark, points, res):
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "i int, lat double, lon double")
    return [r[0] for r in df.select("i", grid.cell_at(F.col("lat"), F.col("lon"), res).alias("c")).orderBy("i").select("c").collect()]


def vectors(lat, lon):
    la, lo = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(la) * np.cos(lo), np.cos(la) * np.sin(lo), np.sin(la)], axis=-1)


def test_published_addresses(spark):
    for lat, lon, res, address in KNOWN:
        assert cells_at(spark, [(lat, lon)], res) == [address]
    df = spark.createDataFrame([(a,) for *_, a in KNOWN] + [("x",), (None,), ("0" * 15,)], "a string")
    c = F.col("a")
    rows = df.select("a", grid.centre(c).alias("c"), grid.resolution(c).alias("r"), grid.parent(c, 4).alias("up"), grid.is_pentagon(c).alias("p")).collect()
    for r in rows[:-3]:
        assert r["r"] == int(r["a"][1], 16) and not r["p"]
        if r["a"] in CENTRES:
            assert np.allclose((r["c"]["lat"], r["c"]["lon"]), CENTRES[r["a"]], atol=1e-8)
    assert all(r["r"] is None and r["up"] is None for r in rows[-3:])
    ups = {r["a"]: r["up"] for r in rows[:-3]}
    assert ups["85283473fffffff"] == "8428347ffffffff" and ups["847b59dffffffff"] == "847b59dffffffff"
    coarse = spark.createDataFrame([("881f1d4887fffff",)], "a string").select(grid.parent(c, 7), grid.parent(c, 0), grid.parent(c, 9)).first()
    assert tuple(coarse) == (f"{608533319805566975:x}", "801ffffffffffff", None)


def test_the_definition_is_sound():
    assert len(grid.OWN) == 122 and grid.PENTAGONS == [4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117]
    # Base cells are numbered from north to south, and the faces make one icosahedron.
    assert (np.diff(grid.BASE_PLACES[:, 2]) < 1e-12).all()
    corners = np.array([grid.on_sphere(f, a, b) for f in range(20) for a, b in grid.CORNERS])
    assert np.allclose(np.sort(corners @ grid.VERTICES.T, axis=1)[:, -1], 1)
    assert all(sorted(grid.TABLES["next"][3 * f : 3 * f + 3]) == sorted(g for g in range(20) if f in grid.TABLES["next"][3 * g : 3 * g + 3]) for f in range(20))


@pytest.mark.parametrize("res", [0, 1, 4, 7, 11, 15])
def test_cells_and_centres_agree(spark, res):
    """The nearest centre is the cell's, also near pentagons and edges, and a centre lies in its own cell."""
    rng = np.random.default_rng(res)
    p = rng.normal(size=(500, 3))
    p[:200] = grid.VERTICES[rng.integers(12, size=200)] + rng.normal(size=(200, 3)) * 10.0 ** -rng.uniform(0, 6, (200, 1))
    p /= np.linalg.norm(p, axis=1, keepdims=True)
    df = spark.createDataFrame([(float(np.degrees(np.arcsin(z))), float(np.degrees(np.arctan2(y, x)))) for x, y, z in p], "lat double, lon double")
    got = df.select("lat", "lon", grid.cell_at(F.col("lat"), F.col("lon"), res).alias("a"))
    got = got.select("*", grid.centre(F.col("a")).alias("c")).select("*", grid.cell_at(F.col("c.lat"), F.col("c.lon"), res).alias("again")).collect()
    assert all(r["a"] == r["again"] for r in got)
    far = [float(np.linalg.norm(vectors(r["lat"], r["lon"]) - vectors(r["c"]["lat"], r["c"]["lon"]))) for r in got]
    assert max(far) < 0.75 * grid.UNIT * 7 ** (-res / 2)


def test_children_fill_their_parents(spark):
    base = spark.range(122).select(F.lower(F.hex(F.lit(1 << 59 | (1 << 45) - 1) + F.col("id") * F.lit(1 << 45))).alias("a"))
    one = base.select(F.col("a").alias("up"), F.explode(grid.children(F.col("a"))).alias("a"))
    two = one.select(F.col("a").alias("up"), F.explode(grid.children(F.col("a"))).alias("a"))
    for df, res, n in ((one, 1, 842), (two, 2, 5882)):
        c = F.col("a")
        rows = df.select("up", "a", grid.parent(c, res - 1).alias("p"), grid.centre(c).alias("c")).select("*", grid.cell_at(F.col("c.lat"), F.col("c.lon"), res).alias("again")).collect()
        assert len({r["a"] for r in rows}) == len(rows) == n
        assert all(r["p"] == r["up"] and r["again"] == r["a"] for r in rows)


def test_disks_across_faces_and_around_pentagons(spark):
    """Rings found at once are those found step by step; a pentagon's neighbours are five."""
    res, k = 6, 3
    places = [grid.VERTICES[0], grid.VERTICES[5], grid.on_sphere(4, 1, 1), grid.on_sphere(9, -1, 0), grid.on_sphere(2, 0.3, 0.1)]
    places += [v + 1e-3 * np.roll(v, 1) for v in places[:2]]
    points = [(np.degrees(np.arcsin(z / n)), np.degrees(np.arctan2(y, x))) for x, y, z in places for n in [np.sqrt(x * x + y * y + z * z)]]
    start = spark.createDataFrame([(c,) for c in cells_at(spark, points, res)], "h3_cell string")
    near: dict[str, set] = {}
    seen, todo = set(), {r[0] for r in start.collect()}
    for _ in range(k):
        step = spark.createDataFrame([(c,) for c in sorted(todo)], "h3_cell string")
        rows = step.select("h3_cell", grid.disk(F.col("h3_cell"), res, 1).alias("d"), grid.ring(F.col("h3_cell"), res).alias("r")).collect()
        for r in rows:
            near[r["h3_cell"]] = set(r["d"])
            assert set(r["d"]) == {r["h3_cell"], *(x["cell"] for x in r["r"])} and len(r["d"]) == len(r["r"]) + 1
            at = np.array([[x["x"], x["y"], x["z"]] for x in r["r"]])
            turn = np.cross(at, np.roll(at, -1, axis=0)) @ at.mean(axis=0)
            assert (turn > 0).all()  # counter-clockwise
        seen |= todo
        todo = set().union(*(near[c] for c in todo)) - seen
    assert {len(near[c]) for c in near} == {6, 7}
    assert all(a in near[b] for a in near for b in near[a] if b in near)
    got: dict[str, set] = {}
    for r in disks(start, res, k).collect():
        got.setdefault(r["h3_cell"], set()).add(r["near"])
    for c, found in got.items():
        want = {c}
        for _ in range(k):
            want = set().union(*(near[x] for x in want))
        assert found == want
    assert sorted(len(v) for v in got.values())[:2] == [31, 31]
