"""Hexagonal cells of the sphere with the addresses of the public aperture-7 index (H3), as Columns.

An address is a 64-bit number, written as 15 hexadecimal digits: a resolution, one of 122 base
cells, and a digit for each step of resolution, which says where a cell lies around the centre of its
parent (0: the middle; 1 to 6: around it).  A step of resolution makes cells a seventh as large and turns the
lattice by about 19 degrees, one way at odd resolutions and back at even ones.  So the parent is the same number
with fewer digits, and cells nest by their numbers.

The lattice lies on the faces of an icosahedron (Sahr, White and Kimerling 2003), projected from
the centre of the globe.  A lattice point of a face is ``(a, b)``: steps along the face's first axis
and along the one 120 degrees on.  Here a place becomes the nearest lattice point, that
becomes digits and a base cell by dividing by seven again and again, and the digits are turned from the
face's axes to those of the base cell's own face.  Twelve base cells, the pentagons, lie on corners of the icosahedron, where only five faces
meet: they lack the sixth around direction 1, and how far digits turn there depends on the first that is not 0.

Only what the definition fixes by choice is listed below: where the faces lie and the base cells' faces.
The other tables follow from these.  Every function is arithmetic over them, with intermediate
values bound once (see ``let``), so that plans stay small when Catalyst moves the expressions about.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.columns import let

# Fixed values of the public definition: each face's centre (latitude, longitude) and the azimuth of its first axis, in radians.
FACE_PLACES = (
    (0.803582649718989942, 1.248397419617396099, 5.619958268523939882),
    (1.307747883455638156, 2.536945009877921159, 5.760339081714187279),
    (1.054751253523952054, -1.347517358900396623, 0.780213654393430055),
    (0.600191595538186799, -0.450603909469755746, 0.430469363979999913),
    (0.491715428198773866, 0.401988202911306943, 6.130269123335111400),
    (0.172745327415618701, 1.678146885280433686, 2.692877706530642877),
    (0.605929321571350690, 2.953923329812411617, 2.982963003477243874),
    (0.427370518328979641, -1.888876200336285401, 3.532912002790141181),
    (-0.079066118549212831, -0.733429513380867741, 3.494305004259568154),
    (-0.230961644455383637, 0.506495587332349035, 3.003214169499538391),
    (0.079066118549212831, 2.408163140208925497, 5.930472956509811562),
    (0.230961644455383637, -2.635097066257444203, 0.138378484090254847),
    (-0.172745327415618701, -1.463445768309359553, 0.448714947059150361),
    (-0.605929321571350690, -0.187669323777381622, 0.158629650112549365),
    (-0.427370518328979641, 1.252716453253507838, 5.891865957979238535),
    (-0.600191595538186799, 2.690988744120037492, 2.711123289609793325),
    (-0.491715428198773866, -2.739604450678486295, 3.294508837434268316),
    (-0.803582649718989942, -1.893195233972397139, 3.804819692245439833),
    (-1.307747883455638156, -0.604647643711872080, 3.664438879055192436),
    (-1.054751253523952054, 1.794075294689396615, 2.361378999196363184),
)
# Fixed values of the public definition: the base cells 0 to 121 as own face and place on it (steps along its three axes).
BASE_CELLS = """
1:100 2:110 1:000 2:100 0:200 1:110 1:001 2:000 0:100 2:010 1:010 1:011 3:100 3:110 11:200 4:100 0:000 6:010 0:001 2:011
7:001 2:001 0:110 6:001 10:200 6:000 3:000 11:100 4:110 3:010 0:011 4:000 5:010 0:010 7:010 11:110 7:000 10:100 12:200 6:101
7:101 4:001 3:001 3:011 4:010 6:100 11:000 8:001 5:001 14:200 5:000 12:100 10:110 4:011 12:110 7:100 11:010 10:000 13:200 10:001
11:001 9:010 8:010 6:200 8:000 9:001 14:100 5:101 16:011 8:101 5:100 12:000 7:200 12:010 10:010 9:000 13:100 16:001 15:011 15:010
16:010 14:110 13:110 5:200 8:100 14:000 9:101 14:001 17:001 12:001 16:000 17:011 15:001 16:101 9:100 15:000 13:000 8:200 13:010 17:101
19:010 14:010 19:011 17:010 13:001 17:000 16:100 9:200 15:101 15:100 18:011 18:001 19:001 17:100 19:000 18:010 18:101 19:200 19:100 18:000
19:101 18:100
"""
# Fixed values of the public definition: the step that each digit stands for, and a base cell's width on a face's plane.
STEPS = ((0, 0), (-1, -1), (0, 1), (-1, 0), (1, 0), (0, -1), (1, 1))
UNIT = 0.38196601125010500003

#: Half the square root of 3, and by how much the lattice turns at odd resolutions.
H = 3**0.5 / 2
TURN = float(np.arcsin((3 / 28) ** 0.5))


def _sphere(lat, lon):
    return np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat) + 0 * lon], axis=-1)


_LAT, _LON, _AZ = np.array(FACE_PLACES).T
#: Of each face: its centre, and the directions of x (its first axis) and y on its plane.
CENTRES = _sphere(_LAT, _LON)
_NORTH, _EAST = _sphere(_LAT + np.pi / 2, _LON), _sphere(0 * _LAT, _LON + np.pi / 2)
AXIS_X = np.cos(_AZ)[:, None] * _NORTH + np.sin(_AZ)[:, None] * _EAST
AXIS_Y = np.sin(_AZ)[:, None] * _NORTH - np.cos(_AZ)[:, None] * _EAST
OWN = [(int(face), *(int(s[0]) - int(s[2]), int(s[1]) - int(s[2]))) for face, s in (x.split(":") for x in BASE_CELLS.split())]
PENTAGONS = [c for c, (_, a, b) in enumerate(OWN) if (a, b) == (2, 0)]
#: The face's corners lie two steps along its three axes.
CORNERS = ((2, 0), (0, 2), (-2, -2))


def on_sphere(face: int, a: float, b: float) -> np.ndarray:
    """The unit vector of a lattice point of resolution 0."""
    v = CENTRES[face] + UNIT * ((a - b / 2) * AXIS_X[face] + b * H * AXIS_Y[face])
    return v / np.linalg.norm(v)


BASE_PLACES = np.array([on_sphere(*own) for own in OWN])
VERTICES = BASE_PLACES[PENTAGONS]


def _angle(face: int, a: float, b: float, at: np.ndarray) -> float:
    """Where the face's first axis points at a lattice point, in sixths of a circle against north at ``at``."""
    d = on_sphere(face, a + 1e-4, b) - on_sphere(face, a, b)
    east = np.cross([0, 0, 1], at)
    return float(np.arctan2(d @ np.cross(at, east), d @ east) * 3 / np.pi)


#: Where each digit points, in sixths of a circle from the first axis.
POINTS = (0, 4, 2, 3, 0, 5, 1)
_AT = {p: d for d, p in enumerate(POINTS) if d}
#: Where a face lies as seen from its three corners, in sixths of a circle from its first axis.
_MIDDLE = (3, 5, 1)


def _turned(digit: int, sixths: int) -> int:
    """A digit's direction, turned counter-clockwise."""
    return _AT[(POINTS[digit] + sixths) % 6] if digit else 0


def _around(at: np.ndarray, face: int) -> float:
    """Where a face's centre lies as seen from one of its corners, in radians."""
    east = np.cross([0, 0, 1], at)
    return float(np.arctan2(CENTRES[face] @ np.cross(at, east), CENTRES[face] @ east))


def _tables() -> dict[str, list[int]]:
    """Tables of whole numbers that follow from the fixed values.

    ``base, turn``: the base cell at a place of a face (``face * 27 + 9 i + 3 j + k``), and the turn from the face's axes to the
    base cell's own.  ``pent``: that turn at the face's corners (``face * 3 + corner``) for each first digit that is not 0.
    ``face, a, b, back``: by base cell and first digit, the face on which to look for a cell, the base cell's place there, and
    the turn of its digits.  ``next, bend``: the face beyond the edge across from a corner, and the turn to its axes.

    Seen from a pentagon, clockwise from its own face, its five faces lie at sixths 3, 2, 1, 0 and 5 of the lattice.  Sixth 4
    (direction 1) is cut out; what would fall into it belongs beyond the cut, on the other side of it.
    """
    t: dict[str, list[int]] = {k: [] for k in ("base", "turn", "pent", "face", "a", "b", "back", "next", "bend")}
    for face in range(20):
        for i, j, k in np.ndindex(3, 3, 3):
            at = on_sphere(face, i - k, j - k)
            base = int(np.argmax(BASE_PLACES @ at))
            t["base"].append(base)
            t["turn"].append(round(_angle(face, i - k, j - k, BASE_PLACES[base]) - _angle(*OWN[base], BASE_PLACES[base])) % 6)
    seats = {base: {} for base in PENTAGONS}  # of each pentagon: sixth to (face, corner)
    for face in range(20):
        for corner, (a, b) in enumerate(CORNERS):
            base = int(np.argmax(BASE_PLACES @ on_sphere(face, a, b)))
            steps = round((_around(BASE_PLACES[base], OWN[base][0]) - _around(BASE_PLACES[base], face)) / (0.4 * np.pi)) % 5
            seats[base][(3 - steps) % 6] = face, corner
            t["pent"].append(0)
            for digit in range(1, 7):
                home = (3 - steps + (POINTS[digit] - _MIDDLE[corner] + 2) % 6 - 2) % 6
                if home == 4:
                    home = 5 if steps == 0 else 3
                t["pent"].append((home - POINTS[digit]) % 6)
    for base, own in enumerate(OWN):
        for digit in range(7):
            face, corner = seats[base].get(POINTS[digit] if digit else 3, seats[base][3]) if base in seats else (own[0], None)
            a, b = CORNERS[corner] if base in seats else own[1:]
            back = (_MIDDLE[corner] - POINTS[digit]) % 6 if base in seats and digit else 0
            for name, value in (("face", face), ("a", a), ("b", b), ("back", back)):
                t[name].append(value)
    for face in range(20):
        for corner, (a, b) in enumerate(CORNERS):
            edge = on_sphere(face, -a / 2, -b / 2)
            near = [int(x) for x in np.argsort(-(CENTRES @ edge))[:2]]
            beyond = near[0] if near[1] == face else near[1]
            t["next"].append(beyond)
            own = next((x, y) for x, y in ((-1, 0), (0, -1), (1, 1)) if on_sphere(beyond, x, y) @ edge > 1 - 1e-9)
            t["bend"].append(round(_angle(face, -a / 2, -b / 2, edge) - _angle(beyond, *own, edge)) % 6)
    return t


TABLES = _tables()

# Rows of the face tables as Columns.


def _array(items) -> Column:
    """An array of SQL literals: one call to the JVM, however many they are."""
    return F.expr(f"array({', '.join(items)})")


def _struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


def _double(v: float) -> str:
    return f"{float(v)!r}D"


def _whole(values, at: Column) -> Column:
    """The item of some whole numbers at a place, from 0."""
    return F.get(_array(map(str, values)), at.cast("int"))


def _vector(x: Column, y: Column, z: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), z.alias("z"))


def _unit(v: Column) -> Column:
    size = F.sqrt(v["x"] * v["x"] + v["y"] * v["y"] + v["z"] * v["z"])
    return let(size, lambda s: _vector(v["x"] / s, v["y"] / s, v["z"] / s))


def face_row(face: int) -> dict[str, float]:
    """A face's centre ``c`` and its plane's directions ``u`` and ``v``, for tables."""
    return {f"{n}{k}": v for n, t in (("c", CENTRES), ("u", AXIS_X), ("v", AXIS_Y)) for k, v in zip("xyz", t[face], strict=True)}


def _faces() -> Column:
    return _array(_struct(**{k: _double(v) for k, v in face_row(f).items()}) for f in range(20))


def turn_of(res: int) -> tuple[float, float]:
    """Cosine and sine of how far the lattice of a resolution is turned."""
    return (float(np.cos(TURN)), float(np.sin(TURN))) if res % 2 else (1.0, 0.0)


def point(lat: Column, lon: Column) -> Column:
    """The unit vector of a place."""
    la, lo = F.radians(lat), F.radians(lon)
    return _vector(F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la))


def _located(p: Column, res: int) -> Column:
    """``struct<face, a, b>``: the face of ``p`` (from 0) and the lattice point next to it there."""
    faces, (c, s), size = _faces(), turn_of(res), 7.0 ** (res / 2) / UNIT
    dot = lambda f, n: p["x"] * f[f"{n}x"] + p["y"] * f[f"{n}y"] + p["z"] * f[f"{n}z"]

    def on_plane(f: Column) -> Column:
        def turned(q: Column) -> Column:
            x, y = q["x"] / q["d"] * F.lit(size), q["y"] / q["d"] * F.lit(size)
            b = (y * F.lit(c) - x * F.lit(s)) / F.lit(H)
            return let(F.struct((x * F.lit(c) + y * F.lit(s)).alias("x"), b.alias("b")), lambda r: F.struct((r["x"] - r["b"] / 2).alias("q"), r["b"].alias("r")))

        return let(F.struct(dot(f, "u").alias("x"), dot(f, "v").alias("y"), dot(f, "c").alias("d")), turned)

    def rounded(face: Column, q: Column) -> Column:
        """The nearest point: of three rounded numbers that must add up to 0, the one that is farthest off gives way."""
        near = F.struct(F.rint(q["q"]).alias("q"), F.rint(q["r"]).alias("r"), F.rint(-q["q"] - q["r"]).alias("s"))

        def mended(n: Column) -> Column:
            dq, dr, ds = F.abs(n["q"] - q["q"]), F.abs(n["r"] - q["r"]), F.abs(n["s"] + q["q"] + q["r"])
            first, second = (dq > dr) & (dq > ds), dr > ds
            x = F.when(first, -n["r"] - n["s"]).otherwise(n["q"])
            y = F.when(~first & second, -n["q"] - n["s"]).otherwise(n["r"])
            return F.struct(face.alias("face"), (x + y).cast("long").alias("a"), y.cast("long").alias("b"))

        return let(near, mended)

    best = let(F.transform(faces, lambda f: dot(f, "c")), lambda d: F.array_position(d, F.array_max(d)).cast("int") - 1)
    return let(best, lambda face: let(let(F.get(faces, face), on_plane), lambda q: rounded(face, q)))


def _levels(first: int, last: int) -> Column:
    return _array(map(str, range(first, last + 1)))


#: By parity of a resolution: the rows of the matrix that leads from a cell to the middle of its child, and of 7 times its inverse.
_DOWN = (((3, -1), (1, 2)), ((2, 1), (-1, 3)))
_UP = (((2, 1), (-1, 3)), ((3, -1), (1, 2)))


def _steps(levels) -> Column:
    """A row per level: its matrices ``d`` and ``u``, and the bits behind its digit."""
    rows = ({"k": str(3 * (15 - r)), "w": f"{1 << 3 * (15 - r)}L"} | {f"{n}{i}{j}": f"{m[r % 2][i][j]}L" for n, m in (("d", _DOWN), ("u", _UP)) for i in (0, 1) for j in (0, 1)} for r in levels)
    return _array(_struct(**r) for r in rows)


def _address(at: Column, res: int) -> Column:
    """The address of a lattice point: the digits from the last to the first, each what is left when a point is divided by seven."""

    def divided(s: Column, level: Column) -> Column:
        part = lambda i: F.floor((level[f"u{i}0"] * s["a"] + level[f"u{i}1"] * s["b"] + 3.5) / 7.0)

        def below(up: Column) -> Column:
            da = s["a"] - level["d00"] * up["a"] - level["d01"] * up["b"]
            db = s["b"] - level["d10"] * up["a"] - level["d11"] * up["b"]
            # The digit's three bits are steps along the three axes, none of them negative.
            digit = 4 * da + 2 * db - 7 * F.least(da, db, F.lit(0).cast("long"))
            return F.struct(up["a"].alias("a"), up["b"].alias("b"), (s["n"] + digit * level["w"]).alias("n"))

        return let(F.struct(part(0).alias("a"), part(1).alias("b")), below)

    def named(s: Column) -> Column:
        low = F.least(s["a"], s["b"], F.lit(0))
        place = at["face"] * 27 + (s["a"] - low) * 9 + (s["b"] - low) * 3 - low
        corner = F.when(s["a"] - low == 2, 0).when(s["b"] - low == 2, 1).otherwise(2)

        def turned(row: Column) -> Column:
            base, turn = F.shiftright(row, 3), row.bitwiseAND(7)
            turn = F.when(turn == 7, _whole(TABLES["pent"], (at["face"] * 3 + corner) * 7 + _lead(s["n"], res))).otherwise(turn)
            head = F.lit(1 << 59 | res << 52 | (1 << 3 * (15 - res)) - 1) + base.cast("long") * F.lit(1 << 45)
            return F.lower(F.hex((head + let(turn, lambda t: _turned_digits(s["n"], t, res))).cast("long")))

        rows = [base << 3 | (7 if base in PENTAGONS else turn) for base, turn in zip(TABLES["base"], TABLES["turn"], strict=True)]
        return let(_whole(rows, place), turned)

    start = F.struct(at["a"].alias("a"), at["b"].alias("b"), F.lit(0).cast("long").alias("n"))
    return let(F.aggregate(_steps(range(res, 0, -1)), start, divided) if res else start, named)


def _lead(n: Column, res: int = 15) -> Column:
    """The first digit that is not 0 of an address, of which those up to ``res`` are filled in; 0 if there is none."""
    if not res:
        return F.lit(0)
    digits = F.transform(_array(str(3 * (15 - r)) for r in range(1, res + 1)), lambda k: _digit(n, k))
    return F.coalesce(F.get(F.filter(digits, lambda d: d.between(1, 6)), F.lit(0)), F.lit(0))


def _digit(n: Column, shift: Column) -> Column:
    return F.call_function("shiftright", n, shift).bitwiseAND(F.lit(7).cast("long")).cast("int")


def _turned_digits(n: Column, turn: Column, res: int) -> Column:
    """The digits up to ``res``, all turned."""
    table = [_turned(x, t) for t in range(6) for x in range(7)]
    step = lambda m, x: m + _whole(table, turn * 7 + _digit(n, x["k"])) * x["w"]
    return F.when(turn == 0, n).otherwise(F.aggregate(_steps(range(1, res + 1)), F.lit(0).cast("long"), step)) if res else n


def cell_at(lat: Column, lon: Column, resolution: int) -> Column:
    """The cell of a place, or null."""
    made = let(point(lat, lon), lambda p: let(_located(p, resolution), lambda at: _address(at, resolution)))
    return F.when(lat.isNotNull() & lon.isNotNull(), made)


def number(cell: Column) -> Column:
    """An address as a number; null for what is none."""
    return F.when(cell.rlike("^8[0-9a-f]{14}$"), F.conv(cell, 16, 10).cast("long"))


def _bits(n: Column, shift: int, width: int) -> Column:
    return F.shiftright(n, shift).bitwiseAND(F.lit((1 << width) - 1)).cast("int")


def resolution(cell: Column) -> Column:
    return _bits(number(cell), 52, 4)


def base_cell(cell: Column) -> Column:
    return _bits(number(cell), 45, 7)


def is_pentagon(cell: Column) -> Column:
    """Whether a cell has five neighbours only."""
    return let(number(cell), lambda n: _bits(n, 45, 7).isin(*PENTAGONS) & (_lead(n) == 0))


def parent(cell: Column, coarser: int) -> Column:
    """The cell of a coarser resolution whose address begins like ``cell``'s; null if ``cell`` is coarser already."""

    def cut(n: Column) -> Column:
        kept = n.bitwiseAND(F.lit(~(15 << 52) & (1 << 63) - 1).cast("long")).bitwiseOR(F.lit((1 << 3 * (15 - coarser)) - 1).cast("long"))
        return F.when(_bits(n, 52, 4) >= coarser, F.lower(F.hex(kept.bitwiseOR(F.lit(coarser << 52).cast("long")))))

    return let(number(cell), cut)


def children(cell: Column) -> Column:
    """The cells one resolution finer that have ``cell`` as parent: seven, six of a pentagon."""

    def made(n: Column) -> Column:
        res = _bits(n, 52, 4)
        step = F.element_at(_array(f"{1 << 3 * (14 - r)}L" for r in range(15)), res + 1)
        first = n + F.lit(1 << 52).cast("long") - step * 7
        pent = _bits(n, 45, 7).isin(*PENTAGONS) & (_lead(n) == 0)
        digits = F.filter(_levels(0, 6), lambda d: ~(pent & (d == 1)))
        return F.when(res < 15, F.transform(digits, lambda d: F.lower(F.hex(first + step * d))))

    return let(number(cell), made)


def _seat(n: Column) -> Column:
    """``struct<res, face, a, b>``: the lattice point of a cell's centre, on a face that may end before it."""

    def down(turn: Column | None):
        def one(s: Column, x: Column) -> Column:
            digit = _digit(n, x["k"]) if turn is None else _whole([_turned(d, t) for t in range(6) for d in range(7)], turn * 7 + _digit(n, x["k"]))

            def moved(d: Column) -> Column:
                k = d.bitwiseAND(1)
                a = x["d00"] * s["a"] + x["d01"] * s["b"] + F.shiftright(d, 2) - k
                b = x["d10"] * s["a"] + x["d11"] * s["b"] + F.shiftright(d, 1).bitwiseAND(1) - k
                return F.struct(a.alias("a"), b.alias("b"))

            return let(digit, moved)

        return one

    def from_base(at: Column) -> Column:
        row = lambda k: _whole(TABLES[k], at)
        levels = F.slice(_steps(range(1, 16)), F.lit(1), _bits(n, 52, 4))
        start = F.struct(row("a").cast("long").alias("a"), row("b").cast("long").alias("b"))
        done = let(row("back"), lambda t: F.when(t == 0, F.aggregate(levels, start, down(None))).otherwise(F.aggregate(levels, start, down(t))))
        return let(done, lambda s: F.struct(_bits(n, 52, 4).alias("res"), row("face").alias("face"), s["a"].alias("a"), s["b"].alias("b")))

    base = _bits(n, 45, 7)
    return let(base * 7 + F.when(base.isin(*PENTAGONS), _lead(n)).otherwise(0), from_base)


def _on_sphere(face: Column, x: Column, y: Column) -> Column:
    """The unit vector of a place on a face's plane, which may lie beyond an edge: then on the next face."""
    far = [(-x * F.lit(ux) - y * F.lit(uy)) for ux, uy in _THIRDS]
    corner = F.when((far[0] >= far[1]) & (far[0] >= far[2]), 0).when(far[1] >= far[2], 1).otherwise(2)

    def hop(m: Column) -> Column:
        get = lambda values: F.get(_array(map(_double, values)), m)
        bend, face2 = _whole(TABLES["bend"], face * 3 + m), _whole(TABLES["next"], face * 3 + m)
        cos, sin = ([float(f(n * np.pi / 3)) for n in range(6)] for f in (np.cos, np.sin))
        px, py = x + 2 * get([u for u, _ in _THIRDS]), y + 2 * get([v for _, v in _THIRDS])
        c, s = (F.get(_array(map(_double, v)), bend) for v in (cos, sin))
        return F.struct(face2.alias("face"), (px * c - py * s).alias("x"), (px * s + py * c).alias("y"))

    here = F.struct(face.alias("face"), x.alias("x"), y.alias("y"))
    at = F.when(F.greatest(*far) > 1 + 1e-9, let(corner, hop)).otherwise(here)

    def raised(q: Column) -> Column:
        sum_ = lambda f, k: f[f"c{k}"] + F.lit(UNIT) * (q["x"] * f[f"u{k}"] + q["y"] * f[f"v{k}"])
        return let(F.get(_faces(), q["face"]), lambda f: let(_vector(*[sum_(f, k) for k in "xyz"]), _unit))

    return let(at, raised)


#: Unit vectors of a face's three axes on its plane.
_THIRDS = ((1.0, 0.0), (-0.5, H), (-0.5, -H))


def _flat(seat: Column, da: Column | int = 0, db: Column | int = 0) -> Column:
    """``struct<x, y>``: a lattice point near a cell's centre, on the plane of its face."""

    def turned(q: Column) -> Column:
        c, s = (F.when(seat["res"] % 2 == 1, F.lit(t)).otherwise(F.lit(f)) for t, f in zip(turn_of(1), turn_of(0), strict=True))
        size = F.element_at(_array(_double(7.0 ** (-r / 2)) for r in range(16)), seat["res"] + 1)
        return F.struct(((q["x"] * c - q["y"] * s) * size).alias("x"), ((q["x"] * s + q["y"] * c) * size).alias("y"))

    a, b = (seat["a"] + da).cast("double"), (seat["b"] + db).cast("double")
    return let(F.struct((a - b / 2).alias("x"), (b * F.lit(H)).alias("y")), turned)


def _raised(seat: Column, da: Column | int = 0, db: Column | int = 0) -> Column:
    """The unit vector of a lattice point near a cell's centre."""
    return let(_flat(seat, da, db), lambda q: _on_sphere(seat["face"], q["x"], q["y"]))


def _neighbour(seat: Column, da: Column, db: Column, res: int) -> Column:
    """The address of a lattice point near a cell's centre: from its place on the face, or beyond its edges from its place on the globe."""
    here = F.struct(seat["face"].alias("face"), (seat["a"] + da).alias("a"), (seat["b"] + db).alias("b"))

    def named(q: Column) -> Column:
        within = F.greatest(*[-q["x"] * F.lit(u) - q["y"] * F.lit(v) for u, v in _THIRDS]) < 1 - 1e-9
        away = let(_on_sphere(seat["face"], q["x"], q["y"]), lambda p: _located(p, res))
        return let(F.when(within, here).otherwise(away), lambda at: _address(at, res))

    return let(_flat(seat, da, db), named)


def centre_point(cell: Column) -> Column:
    """The unit vector of a cell's centre; null for what is no address."""
    made = let(number(cell), lambda n: let(_seat(n), lambda s: _raised(s)))
    return F.when(number(cell).isNotNull(), made)


def centre(cell: Column) -> Column:
    """``struct<lat, lon>`` of a cell's centre."""
    return let(centre_point(cell), lambda p: F.struct(F.degrees(F.asin(p["z"])).alias("lat"), F.degrees(F.atan2(p["y"], p["x"])).alias("lon")))


def _moved(cell: Column, moves, made) -> Column:
    """``made(seat, move)`` of the moves, which have ``a``, ``b`` and their number ``i``."""
    rows = _array(_struct(a=str(a), b=str(b), i=str(i)) for i, (a, b) in enumerate(moves))
    return let(number(cell), lambda n: let(_seat(n), lambda seat: F.transform(rows, lambda m: made(seat, m))))


#: Moves to the neighbours, counter-clockwise.
RING = ((1, 0), (1, 1), (0, 1), (-1, 0), (-1, -1), (0, -1))


def disk_moves(k: int) -> list[tuple[int, int]]:
    return [(a, b) for a in range(-k, k + 1) for b in range(-k, k + 1) if abs(a - b) <= k]


def disk(cell: Column, resolution: int, k: int) -> Column:
    """The cells within ``k`` rings, the cell itself included; ``cell`` must be of that resolution.

    Away from the twelve pentagons these are 1 + 3k(k + 1).  From the second ring on, steps around a pentagon
    depend on the way taken: where :func:`near_pentagon` is true, grow the disk ring by ring.
    """
    found = _moved(cell, disk_moves(k), lambda seat, m: _neighbour(seat, m["a"], m["b"], resolution))
    return F.when(cell.isNotNull(), F.array_distinct(found))


def near_pentagon(cell: Column, resolution: int, k: int) -> Column:
    """Whether a pentagon lies about as near as ``k`` rings."""
    corners = _array(_struct(**{n: _double(v) for n, v in zip("xyz", p, strict=True)}) for p in VERTICES)
    reach = float(np.cos(min(np.pi, 1.5 * (k + 1) * UNIT * 7 ** (-resolution / 2))))
    return let(centre_point(cell), lambda p: F.exists(corners, lambda v: p["x"] * v["x"] + p["y"] * v["y"] + p["z"] * v["z"] > F.lit(reach)))


def ring(cell: Column, resolution: int) -> Column:
    """The neighbours, counter-clockwise: ``array<struct<i, cell, x, y, z>>`` with the centres' unit vectors."""

    def one(seat: Column, m: Column) -> Column:
        return F.struct(m["i"].alias("i"), _neighbour(seat, m["a"], m["b"], resolution).alias("cell"))

    def once(found: Column) -> Column:
        names = F.transform(found, lambda r: r["cell"])
        return F.filter(found, lambda r, i: (r["cell"] != cell) & (F.array_position(names, r["cell"]) == i + 1))

    def centred(found: Column) -> Column:
        return F.transform(found, lambda r: let(centre_point(r["cell"]), lambda p: F.struct(r["i"], r["cell"], p["x"].alias("x"), p["y"].alias("y"), p["z"].alias("z"))))

    return let(let(_moved(cell, RING, one), once), centred)
