"""DuckDB SQL with the same results as the queries, as chains of common table expressions."""

from __future__ import annotations

from tidemark.functions import grid
from tidemark.functions.vessels import NAMESPACE, SHIP_CLASSES
from tidemark.plans.adapter import CITIES_SQL, CONFIG, COUNTRIES_SQL, EXISTING_SQL, MESSAGES_SQL
from tidemark.plans.shapes import SHAPES, TEXTS

S, RES, K = CONFIG.stops, CONFIG.cells.h3_resolution, CONFIG.clusters.cluster_ring_size
MIN = 60_000_000


def _d(x: float) -> str:
    """A literal that is read as a double."""
    return f"{float(x)!r}" if "e" in repr(float(x)) else f"{float(x)!r}e0"


_ROWS = ",\n  ".join("(" + ", ".join([str(f), *map(_d, grid.face_row(f).values())]) + ")" for f in range(20))
_TURNED = [grid._turned(d, n) for n in range(6) for d in range(7)]
#: The icosahedron's faces, and the grid's tables of whole numbers as lists in one row.
FACES = (
    "faces(face, " + ", ".join(grid.face_row(0)) + f") AS (VALUES\n  {_ROWS}),\ntabs AS (SELECT "
    + ", ".join(f"{list(v)} AS t_{k}" for k, v in (*grid.TABLES.items(), ("turned", _TURNED))) + ")"
)


def _shift(r: int) -> int:
    return 3 * (15 - r)


def _lead(n: str, res: int) -> str:
    return "CASE " + " ".join(f"WHEN ({n} >> {_shift(r)}) & 7 > 0 THEN ({n} >> {_shift(r)}) & 7" for r in range(1, res + 1)) + " ELSE 0 END"


def located(name: str, src: str, res: int) -> str:
    """CTEs: ``src`` has ``id, x, y, z``; ``name`` has ``id, cell``, the lattice point ``face, fa, fb`` and the face's columns."""
    (c, t), size = grid.turn_of(res), 7.0 ** (res / 2) / grid.UNIT
    dot = lambda k: " + ".join(f"{x} * {k}{x}" for x in "xyz")
    out = f"""{name}_f AS (
  SELECT * FROM (SELECT s.*, f.*, row_number() OVER (PARTITION BY id ORDER BY {dot("c")} DESC, face) AS k FROM {src} s, faces f) WHERE k = 1
), {name}_x AS (SELECT *, ({dot("u")}) / ({dot("c")}) * {_d(size)} AS px, ({dot("v")}) / ({dot("c")}) * {_d(size)} AS py FROM {name}_f
), {name}_y AS (SELECT *, px * {_d(c)} + py * {_d(t)} AS hx, (py * {_d(c)} - px * {_d(t)}) / {_d(grid.H)} AS hr FROM {name}_x
), {name}_q AS (SELECT *, hx - hr / 2 AS hq, round_even(hx - hr / 2, 0) AS rq, round_even(hr, 0) AS rr, round_even(-(hx - hr / 2) - hr, 0) AS rs FROM {name}_y
), {name}_d AS (SELECT *, abs(rq - hq) > abs(rr - hr) AND abs(rq - hq) > abs(rs + hq + hr) AS p, abs(rr - hr) > abs(rs + hq + hr) AS o FROM {name}_q
), {name}_e AS (SELECT *, CASE WHEN p THEN -rr - rs ELSE rq END AS eq, CASE WHEN NOT p AND o THEN -rq - rs ELSE rr END AS er FROM {name}_d
), {name}_l{res} AS (SELECT *, CAST(eq + er AS BIGINT) AS fa, CAST(er AS BIGINT) AS fb, CAST(eq + er AS BIGINT) AS a, CAST(er AS BIGINT) AS b, 0::BIGINT AS n FROM {name}_e
)"""
    for r in range(res, 0, -1):
        (u, v), (d, e) = grid._UP[r % 2], grid._DOWN[r % 2]
        out += f""", {name}_m{r} AS (SELECT *, CAST(floor(({u[0]} * a + {u[1]} * b + 3.5e0) / 7e0) AS BIGINT) AS ma, CAST(floor(({v[0]} * a + {v[1]} * b + 3.5e0) / 7e0) AS BIGINT) AS mb FROM {name}_l{r}
), {name}_s{r} AS (SELECT *, a - ({d[0]}) * ma - ({d[1]}) * mb AS da, b - ({e[0]}) * ma - ({e[1]}) * mb AS db FROM {name}_m{r}
), {name}_l{r - 1} AS (SELECT * EXCLUDE (ma, mb, da, db) REPLACE (ma AS a, mb AS b, n + (4 * da + 2 * db - 7 * least(da, db, 0)) * {1 << _shift(r)}::BIGINT AS n) FROM {name}_s{r}
)"""
    digits = " + ".join(f"t_turned[turn * 7 + ((n >> {_shift(r)}) & 7) + 1] * {1 << _shift(r)}::BIGINT" for r in range(1, res + 1))
    return out + f""", {name}_v AS (
  SELECT *, face * 27 + (a - least(a, b, 0)) * 9 + (b - least(a, b, 0)) * 3 - least(a, b, 0) AS place, CASE WHEN a - least(a, b, 0) = 2 THEN 0 WHEN b - least(a, b, 0) = 2 THEN 1 ELSE 2 END AS corner,
    {_lead("n", res)} AS lead FROM {name}_l0, tabs
), {name}_t AS (
  SELECT *, t_base[place + 1] AS base, CASE WHEN t_base[place + 1] IN {tuple(grid.PENTAGONS)} THEN t_pent[(face * 3 + corner) * 7 + lead + 1] ELSE t_turn[place + 1] END AS turn FROM {name}_v
), {name} AS (
  SELECT * EXCLUDE ({", ".join(f"t_{k}" for k in (*grid.TABLES, "turned"))}), lower(to_hex({1 << 59 | res << 52 | (1 << _shift(res)) - 1} + base * {1 << 45}::BIGINT + {digits})) AS cell FROM {name}_t
)"""


def placed(a: str, b: str, res: int) -> str:
    """``sx, sy, sz``: where a lattice point of a face lies on its plane."""
    (c, t), size = grid.turn_of(res), 7.0 ** (-res / 2)
    x, y = f"(({a}) - ({b}) / 2e0)", f"(({b}) * {_d(grid.H)})"
    px, py = f"(({x} * {_d(c)} - {y} * {_d(t)}) * {_d(size)})", f"(({x} * {_d(t)} + {y} * {_d(c)}) * {_d(size)})"
    return ", ".join(f"c{k} + {_d(grid.UNIT)} * ({px} * u{k} + {py} * v{k}) AS s{k}" for k in "xyz")


def points(name: str, src: str, key: str, lat: str, lon: str) -> str:
    return (
        f"{name} AS (SELECT {key} AS id, cos(radians({lat})) * cos(radians({lon})) AS x, cos(radians({lat})) * sin(radians({lon})) AS y, "
        f"sin(radians({lat})) AS z FROM {src})"
    )


def centres(name: str, src: str, res: int) -> str:
    """CTEs: ``src`` has ``cell``; ``name`` has ``id`` (the cell) and its centre ``x, y, z``."""
    (c, t), size = grid.turn_of(res), 7.0 ** (-res / 2)
    out = f"""{name}_n AS (SELECT DISTINCT cell, CAST('0x' || cell AS BIGINT) AS n FROM {src}
), {name}_b AS (SELECT cell, n, ((n >> 45) & 127) * 7 + {_lead("n", res)} AS seat FROM {name}_n
), {name}_0 AS (SELECT cell, n, t_face[seat + 1] AS face, t_a[seat + 1] AS a, t_b[seat + 1] AS b, t_back[seat + 1] AS back, t_turned, t_next, t_bend FROM {name}_b, tabs
)"""
    for r in range(1, res + 1):
        d, e = grid._DOWN[r % 2]
        out += f""", {name}_g{r} AS (SELECT *, t_turned[back * 7 + ((n >> {_shift(r)}) & 7) + 1] AS g FROM {name}_{r - 1}
), {name}_{r} AS (SELECT * EXCLUDE (g) REPLACE (({d[0]}) * a + ({d[1]}) * b + (g >> 2) - (g & 1) AS a, ({e[0]}) * a + ({e[1]}) * b + ((g >> 1) & 1) - (g & 1) AS b) FROM {name}_g{r}
)"""
    far = [f"(-(fx) * {_d(u)} - (fy) * {_d(v)})" for u, v in grid._THIRDS]
    pick = lambda k: "CASE m WHEN 0 THEN " + f"{_d(grid._THIRDS[0][k])} WHEN 1 THEN {_d(grid._THIRDS[1][k])} ELSE {_d(grid._THIRDS[2][k])} END"
    return out + f""", {name}_x AS (SELECT *, a - b / 2e0 AS hx, b * {_d(grid.H)} AS hy FROM {name}_{res}
), {name}_y AS (SELECT *, (hx * {_d(c)} - hy * {_d(t)}) * {_d(size)} AS fx, (hx * {_d(t)} + hy * {_d(c)}) * {_d(size)} AS fy FROM {name}_x
), {name}_o AS (SELECT *, greatest({", ".join(far)}) > 1 + 1e-9 AS beyond, CASE WHEN {far[0]} >= {far[1]} AND {far[0]} >= {far[2]} THEN 0 WHEN {far[1]} >= {far[2]} THEN 1 ELSE 2 END AS m FROM {name}_y
), {name}_h AS (SELECT *, fx + 2 * {pick(0)} AS qx, fy + 2 * {pick(1)} AS qy, radians(60e0 * t_bend[face * 3 + m + 1]) AS turn, t_next[face * 3 + m + 1] AS other FROM {name}_o
), {name}_z AS (SELECT cell, CASE WHEN beyond THEN other ELSE face END AS face, CASE WHEN beyond THEN qx * cos(turn) - qy * sin(turn) ELSE fx END AS zx, CASE WHEN beyond THEN qx * sin(turn) + qy * cos(turn) ELSE fy END AS zy FROM {name}_h
), {name}_s AS (SELECT cell AS id, {", ".join(f"c{k} + {_d(grid.UNIT)} * (zx * u{k} + zy * v{k}) AS s{k}" for k in "xyz")} FROM {name}_z JOIN faces USING (face)
), {name} AS (SELECT id, sx / sqrt(sx * sx + sy * sy + sz * sz) AS x, sy / sqrt(sx * sx + sy * sy + sz * sz) AS y, sz / sqrt(sx * sx + sy * sy + sz * sz) AS z FROM {name}_s)"""


def hav(a: str, b: str, c: str, d: str) -> str:
    a, b, c, d = (f"({x})" for x in (a, b, c, d))
    h = f"sin(radians({c} - {a}) / 2)", f"sin(radians({d} - {b}) / 2)"
    return f"(asin(least(sqrt({h[0]} * {h[0]} + cos(radians({a})) * cos(radians({c})) * {h[1]} * {h[1]}), 1e0)) * {_d(2 * 6371000.0)})"


_CLASS = "CASE WHEN ship_type IS NULL THEN 'unknown' " + " ".join(f"WHEN ship_type BETWEEN {a} AND {b} THEN '{n}'" for n, a, b in SHIP_CLASSES) + " ELSE 'other' END"
_LOC = "[A-Z]{2}[A-Z2-9]{3}"


def locode(x: str) -> str:
    up = f"upper(trim({x}))"
    return (
        f"CASE WHEN regexp_full_match({up}, '{_LOC}') THEN {up} WHEN regexp_full_match(replace({up}, ' ', ''), '{_LOC}') THEN replace({up}, ' ', '') "
        f"ELSE list_extract(regexp_extract_all({up}, '\\b({_LOC})\\b', 1), -1) END"
    )


SPREAD = "CASE WHEN count(*) < 2 THEN 0e0 ELSE sqrt(pow(stddev_pop(lat) * 111320e0, 2) + pow(stddev_pop(lon) * 111320e0 * abs(cos(radians(avg(lat)))), 2)) END"
_GAP, _TOL = int(S.max_gap_minutes * MIN), int(S.draught_lookup_hours * 60 * MIN)

STEPS: dict[str, tuple[tuple[str, ...], str]] = {
    "ais": ((), MESSAGES_SQL),
    "cand": (("ais",), f"cand AS (SELECT * FROM ais WHERE (sog < {_d(S.sog_threshold_knots)} OR nav_status IN (1, 5)) AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 AND mmsi BETWEEN {S.mmsi_min} AND {S.mmsi_max})"),
    "t5": (("ais",), "t5 AS (SELECT mmsi, t, draught, destination, ship_type FROM ais WHERE msg_type = 5)"),
    "sess": (
        ("cand",),
        f"sess0 AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY mmsi ORDER BY t) > {_GAP} THEN 1 ELSE 0 END AS nw FROM cand), "
        "sess AS (SELECT *, sum(nw) OVER (PARTITION BY mmsi ORDER BY t ROWS UNBOUNDED PRECEDING) AS segment FROM sess0)",
    ),
    "seg": (
        ("sess",),
        f"""navs AS (
  SELECT mmsi, segment, nav_status, row_number() OVER (PARTITION BY mmsi, segment ORDER BY count(*) DESC, nav_status) AS k
  FROM sess WHERE nav_status IS NOT NULL GROUP BY mmsi, segment, nav_status
), seg0 AS (
  SELECT mmsi, segment, avg(lat) AS lat, avg(lon) AS lon, min(t) AS s, max(t) AS e, (max(t) - min(t)) / {MIN}e0 AS minutes, count(*) AS n, {SPREAD} AS spread
  FROM sess GROUP BY mmsi, segment
), seg AS (
  SELECT seg0.*, nav_status, row_number() OVER (ORDER BY seg0.mmsi, s) AS id FROM seg0 LEFT JOIN navs ON navs.mmsi = seg0.mmsi AND navs.segment = seg0.segment AND k = 1
  WHERE n >= {S.min_messages_per_stop} AND minutes >= {S.min_stop_duration_minutes} AND spread <= {S.positional_variance_max_meters}
)""",
    ),
    "mode": (
        ("t5",),
        "types AS (SELECT mmsi, ship_type FROM (SELECT mmsi, ship_type, row_number() OVER (PARTITION BY mmsi ORDER BY count(*) DESC, ship_type) AS k "
        "FROM t5 WHERE ship_type > 0 GROUP BY mmsi, ship_type) WHERE k = 1)",
    ),
    "stops": (
        ("seg", "mode"),
        f"""arr AS (
  SELECT id, draught, destination FROM (SELECT id, draught, destination, row_number() OVER (PARTITION BY id ORDER BY t DESC, draught DESC NULLS LAST, destination DESC NULLS LAST) AS k
  FROM seg JOIN t5 ON t5.mmsi = seg.mmsi AND t BETWEEN s - {_TOL} AND s) WHERE k = 1
), dep AS (
  SELECT id, draught FROM (SELECT id, draught, row_number() OVER (PARTITION BY id ORDER BY t, draught NULLS FIRST, destination NULLS FIRST) AS k
  FROM seg JOIN t5 ON t5.mmsi = seg.mmsi AND t BETWEEN e AND e + {_TOL}) WHERE k = 1
), stops AS (
  SELECT seg.*, CASE WHEN arr.draught > 0 THEN arr.draught END AS da, CASE WHEN dep.draught > 0 THEN dep.draught END AS dd,
    arr.destination AS destination_raw, {locode("arr.destination")} AS locode, ship_type,
    CASE WHEN nav_status IN (1, 5) THEN 'nav_status' ELSE 'sustained_speed' END AS method
  FROM seg LEFT JOIN arr USING (id) LEFT JOIN dep USING (id) LEFT JOIN types USING (mmsi)
)""",
    ),
    "faces": ((), FACES),
    "placed": (("stops", "faces"), points("placed_p", "stops", "id", "lat", "lon") + ", " + located("placed", "placed_p", RES)),
    "cells": (
        ("placed",),
        f"""visit AS (
  SELECT cell, stops.*, {_CLASS} AS cls, coalesce(abs(CAST(dd - da AS FLOAT)) >= CAST({CONFIG.cells.draught_change_threshold_m} AS FLOAT), false) AS changed
  FROM placed JOIN stops USING (id)
), pv AS (SELECT cell, mmsi, count(*) AS v FROM visit GROUP BY cell, mmsi
), pc AS (SELECT cell, max(v) AS most, avg(v) AS mean FROM pv GROUP BY cell
), tl AS (
  SELECT cell, locode AS top FROM (SELECT cell, locode, row_number() OVER (PARTITION BY cell ORDER BY count(*) DESC, locode) AS k
  FROM visit WHERE locode <> '' GROUP BY cell, locode) WHERE k = 1
), {centres("mid", "placed", RES)}, cells AS (
  SELECT cell, count(DISTINCT mmsi) AS n_unique_mmsi, count(mmsi) AS n_events, sum(CAST(CAST(minutes AS FLOAT) AS DOUBLE)) AS total, sum(CAST(CAST(minutes AS FLOAT) AS DOUBLE)) / count(minutes) AS mean_minutes,
    count(*) FILTER (WHERE changed) AS n_draught_changes, {", ".join(f"count(*) FILTER (WHERE cls = '{n}') AS n_{n}" for n, _, _ in SHIP_CLASSES)}
  FROM visit GROUP BY cell
), full_cells AS (
  SELECT cells.*, most, mean, top, degrees(asin(z)) AS cell_lat, degrees(atan2(y, x)) AS cell_lon
  FROM cells JOIN pc USING (cell) LEFT JOIN tl USING (cell) JOIN mid ON mid.id = cell
), hot AS (SELECT * FROM full_cells WHERE n_unique_mmsi >= {CONFIG.cells.min_unique_mmsi})""",
    ),
    "disk": (
        ("cells",),
        centres("hm", "hot", RES) + ", " + located("hl", "hm", RES) + f""", moves(mi, mj) AS (VALUES {", ".join(f"({i}, {j})" for i, j in grid.disk_moves(K))}
), mv0 AS (SELECT hl.id AS src, id || '/' || mi || '/' || mj AS id, {placed("fa + mi", "fb + mj", RES)} FROM hl, moves
), mv AS (
  SELECT src, id, sx / sqrt(sx * sx + sy * sy + sz * sz) AS x, sy / sqrt(sx * sx + sy * sy + sz * sz) AS y, sz / sqrt(sx * sx + sy * sy + sz * sz) AS z FROM mv0
), {located("nl", "mv", RES)}, disk AS (SELECT DISTINCT src, cell AS near FROM nl)""",
    ),
    "comp": (
        ("disk",),
        """adj AS (SELECT src, near AS dst FROM disk JOIN hot ON hot.cell = near WHERE src <> near
), reach AS (SELECT cell AS a, cell AS b FROM hot UNION SELECT a, dst FROM reach JOIN adj ON b = src
), comp AS (SELECT a AS cell, min(b) AS component FROM reach GROUP BY a)""",
    ),
    "clusters": (
        ("comp",),
        f"""stats AS (
  SELECT component, list(cell ORDER BY cell) AS h3_cells, count(*) AS n_cells, CAST(sum(n_events) AS BIGINT) AS n_events, CAST(sum(n_unique_mmsi) AS BIGINT) AS n_unique_mmsi_approx,
    CAST(sum(n_draught_changes) AS BIGINT) AS n_draught_changes, sum(cell_lat * n_events) / (CASE WHEN sum(n_events) = 0 THEN 1 ELSE sum(n_events) END) AS centroid_lat,
    sum(cell_lon * n_events) / (CASE WHEN sum(n_events) = 0 THEN 1 ELSE sum(n_events) END) AS centroid_lon, min(cell_lat) AS bbox_min_lat, max(cell_lat) AS bbox_max_lat,
    min(cell_lon) AS bbox_min_lon, max(cell_lon) AS bbox_max_lon
  FROM hot JOIN comp USING (cell) GROUP BY component
), clusters AS (
  SELECT row_number() OVER (ORDER BY component) - 1 AS cluster_id, * FROM stats
  WHERE n_cells >= {CONFIG.clusters.min_cells_per_cluster} AND n_events >= {CONFIG.clusters.min_events_per_cluster}
)""",
    ),
    "cities": ((), CITIES_SQL),
    "countries": ((), COUNTRIES_SQL),
    "existing": (("clusters",), EXISTING_SQL),
    "bycell": (
        ("existing",),
        f"""owner AS (SELECT cell, arg_max(harbour_id, ordinal) AS hid FROM (SELECT ordinal, harbour_id, unnest(h3_cells) AS cell FROM existing) GROUP BY cell
), rec AS (SELECT harbour_id, ordinal, coalesce(h3_cells, []) AS h FROM (SELECT *, row_number() OVER (PARTITION BY harbour_id ORDER BY ordinal) AS k FROM existing) WHERE k = 1
), vote AS (SELECT cluster_id, hid, count(*) AS n FROM (SELECT cluster_id, unnest(h3_cells) AS cell FROM clusters) JOIN owner USING (cell) GROUP BY ALL
), best AS (SELECT cluster_id, hid FROM (SELECT cluster_id, hid, row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, ordinal) AS k FROM vote JOIN rec ON harbour_id = hid) WHERE k = 1
), bycell AS (
  SELECT cluster_id, hid AS harbour_id FROM best JOIN rec ON harbour_id = hid JOIN clusters USING (cluster_id)
  WHERE len(h) > 0 AND len(list_intersect(h, h3_cells)) / len(list_distinct(list_concat(h, h3_cells))) >= {_d(CONFIG.match.h3_jaccard_threshold)}
)""",
    ),
    "bydist": (
        ("existing",),
        f"""bydist AS (
  SELECT cluster_id, arg_min(harbour_id, ordinal) AS harbour_id FROM clusters JOIN existing
    ON lat IS NOT NULL AND lon IS NOT NULL AND {hav("centroid_lat", "centroid_lon", "lat", "lon")} <= {_d(CONFIG.match.centroid_match_distance_meters)}
  GROUP BY cluster_id
)""",
    ),
    "ports": (
        ("bycell", "bydist", "cities", "countries"),
        f"""geo AS (
  SELECT cluster_id, cc, city, admin1, km FROM (SELECT cluster_id, cc, cities.name AS city, admin1, {hav("centroid_lat", "centroid_lon", "lat", "lon")} / 1000e0 AS km,
    row_number() OVER (PARTITION BY cluster_id ORDER BY {hav("centroid_lat", "centroid_lon", "lat", "lon")}, cities.name) AS k FROM clusters, cities) WHERE k = 1
), ports AS (
  SELECT clusters.*, coalesce(a.harbour_id, b.harbour_id) AS matched_id, coalesce(a.harbour_id, b.harbour_id) IS NOT NULL AS matched_existing,
    cc AS country_iso2, coalesce(c.name, cc) AS country_name, geo.city, geo.admin1, km
  FROM clusters LEFT JOIN bycell a USING (cluster_id) LEFT JOIN bydist b USING (cluster_id) LEFT JOIN geo USING (cluster_id) LEFT JOIN countries c ON c.iso2 = cc
)""",
    ),
    "outline": (
        ("clusters",),
        f"""round_moves(i, mi, mj) AS (VALUES {", ".join(f"({i}, {m[0]}, {m[1]})" for i, m in enumerate(grid.RING))}
), rm0 AS (SELECT hl.id AS src, i AS o, hl.id || '/' || i AS id, {placed("fa + mi", "fb + mj", RES)} FROM hl, round_moves
), rm AS (
  SELECT src, o, id, sx / sqrt(sx * sx + sy * sy + sz * sz) AS x, sy / sqrt(sx * sx + sy * sy + sz * sz) AS y, sz / sqrt(sx * sx + sy * sy + sz * sz) AS z FROM rm0
), {located("rl", "rm", RES)}, around AS (
  SELECT src, cell, x, y, z, row_number() OVER (PARTITION BY src ORDER BY o) AS k, count(*) OVER (PARTITION BY src) AS n FROM rl WHERE cell <> src
), member AS (SELECT cluster_id, unnest(h3_cells) AS cell FROM clusters
), edges0 AS (
  SELECT c.cluster_id, list_sort([c.cell, p.cell, m.cell]) AS ka, list_sort([c.cell, m.cell, q.cell]) AS kb, hm.x + p.x + m.x AS ax, hm.y + p.y + m.y AS ay,
    hm.z + p.z + m.z AS az, hm.x + m.x + q.x AS bx, hm.y + m.y + q.y AS by_, hm.z + m.z + q.z AS bz
  FROM member c JOIN hm ON hm.id = c.cell JOIN around m ON m.src = c.cell JOIN around p ON p.src = c.cell AND p.k = (m.k - 2 + m.n) % m.n + 1
    JOIN around q ON q.src = c.cell AND q.k = m.k % m.n + 1
  WHERE NOT EXISTS (SELECT 1 FROM member o WHERE o.cluster_id = c.cluster_id AND o.cell = m.cell)
), edges AS (
  SELECT cluster_id, array_to_string(ka, '|') AS key, array_to_string(kb, '|') AS next, degrees(atan2(ay, ax)) AS lon, degrees(atan2(az, sqrt(ax * ax + ay * ay))) AS lat,
    degrees(atan2(by_, bx)) AS lon2, degrees(atan2(bz, sqrt(bx * bx + by_ * by_))) AS lat2 FROM edges0
)""",
    ),
}


def chain(*need: str) -> str:
    """The steps named and all they rest on, in order."""
    done: list[str] = []

    def add(name: str) -> None:
        for x in STEPS[name][0]:
            add(x)
        if name not in done:
            done.append(name)

    for name in need:
        add(name)
    return "WITH RECURSIVE " + ",\n".join(STEPS[x][1] for x in done) + "\n"


SEGMENTS = chain("seg") + (
    "SELECT mmsi, s AS start_us, e AS end_us, n AS n_messages, round(minutes, 3) AS duration_minutes, round(spread, 3) AS spread_m, "
    "round(lat, 3) AS lat, round(lon, 3) AS lon, CAST(nav_status AS INTEGER) AS nav_status FROM seg"
)
_NS = NAMESPACE.replace("-", "")
#: The final ports and, in ``hc``, the coarse cells that new ids are made of.
FINAL = chain("ports", "faces")[:-1] + ",\n" + points("hp", "clusters", "cluster_id", "centroid_lat", "centroid_lon") + ", " + located("hc", "hp", RES - 3) + "\n"
FRESH = f"coalesce(nullif(country_iso2, ''), 'ZZ') || '-' || substr(sha1(from_hex('{_NS}') || encode(hc.cell)), 1, 8)"


def _shown(harbour_id: str, matched: str) -> str:
    return (
        f"SELECT cluster_id, n_cells, n_events, n_unique_mmsi_approx, n_draught_changes, {harbour_id} AS harbour_id, {matched} AS matched_existing, country_iso2, country_name, "
        "city AS nearest_city, admin1, array_to_string(h3_cells, ',') AS cells, round(centroid_lat, 3) AS lat, round(centroid_lon, 3) AS lon, "
        "round(CAST(CAST(km AS FLOAT) AS DOUBLE), 1) AS km FROM ports JOIN hc ON hc.id = cluster_id"
    )


ORACLE = {
    "candidates": chain("cand") + "SELECT mmsi, t, round(lat, 3) AS lat, round(lon, 3) AS lon, sog, CAST(nav_status AS INTEGER) AS nav_status FROM cand",
    "type5": chain("t5") + "SELECT mmsi, t, draught, destination, ship_type FROM t5",
    "rejected_messages": chain("ais") + "SELECT mmsi, 'mmsi' AS reasons, count(*) AS n FROM ais WHERE mmsi NOT BETWEEN 100000005 AND 100000100 GROUP BY mmsi",
    "stop_sessions": chain("sess") + "SELECT mmsi, CAST(segment AS BIGINT) AS segment, count(*) AS n FROM sess GROUP BY ALL",
    "stop_segments": SEGMENTS,
    "session_window_segments": SEGMENTS,
    "detection_method": chain("stops") + "SELECT mmsi, s AS start_us, method AS detection_method FROM stops",
    "asof_draught": chain("stops") + "SELECT mmsi, s AS start_us, e AS end_us, round(CAST(CAST(da AS FLOAT) AS DOUBLE), 3) AS draught_arrival, round(CAST(CAST(dd AS FLOAT) AS DOUBLE), 3) AS draught_departure, "
    "round(CAST(CAST(dd - da AS FLOAT) AS DOUBLE), 3) AS draught_delta, destination_raw, locode AS destination_locode, ship_type, method AS detection_method FROM stops",
    "ship_type_mode": chain("mode") + "SELECT mmsi, ship_type FROM (SELECT DISTINCT mmsi FROM t5) LEFT JOIN types USING (mmsi)",
    "parse_locode": chain("ais") + f"SELECT destination, {locode('destination')} AS locode, count(*) AS n FROM ais GROUP BY ALL",
    "classify_ship_type": chain("ais") + f"SELECT ship_type, {_CLASS} AS ship_class, count(*) AS n FROM ais GROUP BY ALL",
    "positional_spread": chain("ais") + f"SELECT mmsi, round({SPREAD}, 3) AS spread_m FROM ais GROUP BY mmsi",
    "haversine": chain("cities") + f"SELECT name, round({hav('53.54e0', '9.97e0', 'lat', 'lon')} / 1000, 3) AS km FROM cities",
    "cell_assign": chain("ais", "faces")[:-1] + ",\n" + "msg AS (SELECT *, row_number() OVER () AS id FROM ais), " + points("mp", "msg", "id", "lat", "lon") + ", "
    + located("fine", "mp", RES) + ", " + located("coarse", "mp", RES - 3)
    + "\nSELECT fine.cell AS h3_cell, coarse.cell AS coarse, count(*) AS n FROM fine JOIN coarse USING (id) GROUP BY ALL",
    "cell_parents": chain("ais", "faces")[:-1] + ",\n" + "msg AS (SELECT *, row_number() OVER () AS id FROM ais), " + points("mp", "msg", "id", "lat", "lon") + ", " + located("fine", "mp", RES)
    + ", cells AS (SELECT CAST('0x' || cell AS BIGINT) AS c, count(*) AS n FROM fine GROUP BY 1)"
    + "\nSELECT r AS resolution, lower(to_hex((c & ~(15::BIGINT << 52)) | (r::BIGINT << 52) | ((1::BIGINT << (3 * (15 - r))) - 1))) AS cell, CAST(sum(n) AS BIGINT) AS n, count(*) AS n_cells "
    "FROM cells, (VALUES (8), (5), (0)) k(r) GROUP BY ALL",
    "cell_centre": chain("cities", "faces")[:-1] + ",\n" + points("cp", "cities", "name", "lat", "lon") + ", " + located("cl", "cp", RES) + ", " + centres("cm", "cl", RES)
    + "\nSELECT id AS h3_cell, round(degrees(asin(z)), 6) AS lat, round(degrees(atan2(y, x)), 6) AS lon FROM cm",
    "grid_disk": chain("disk") + "SELECT src AS h3_cell, near FROM disk",
    "cell_counts": chain("cells") + "SELECT cell AS h3_cell, n_unique_mmsi, n_events, n_draught_changes, " + ", ".join(f"n_{n}" for n, _, _ in SHIP_CLASSES)
    + ", round(CAST(CAST(total AS FLOAT) AS DOUBLE), 3) AS total_duration_minutes, round(CAST(CAST(mean_minutes AS FLOAT) AS DOUBLE), 3) AS mean_duration_minutes, "
    "round(cell_lat, 3) AS cell_lat, round(cell_lon, 3) AS cell_lon FROM full_cells",
    "cell_visits": chain("cells") + "SELECT cell AS h3_cell, most, round(CAST(CAST(mean AS FLOAT) AS DOUBLE), 3) AS mean FROM full_cells",
    "top_locode": chain("cells") + "SELECT cell AS h3_cell, top AS top_destination_locode FROM full_cells",
    "hot_cells": chain("cells") + "SELECT cell AS h3_cell, n_unique_mmsi FROM hot",
    "adjacency": chain("comp") + "SELECT src, dst FROM adj",
    "components": chain("comp") + "SELECT cell AS h3_cell, component FROM comp",
    "connected_parts": "SELECT p_partkey AS node, p_partkey - p_partkey % 10 AS component FROM part "
    "UNION SELECT p_partkey - p_partkey % 10, p_partkey - p_partkey % 10 FROM part",
    "cluster_stats": chain("clusters") + "SELECT cluster_id, n_cells, n_events, n_unique_mmsi_approx, n_draught_changes, array_to_string(h3_cells, ',') AS cells, "
    + ", ".join(f"round({x}, 3) AS {x}" for x in ("centroid_lat", "centroid_lon", "bbox_min_lat", "bbox_max_lat", "bbox_min_lon", "bbox_max_lon")) + " FROM clusters",
    "nearest_city": chain("cities") + "SELECT c_custkey AS key, round(m / 1000, 3) AS km, name AS nearest_city, cc AS country_iso2, admin1 FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY m, name) AS k FROM "
    "(SELECT c_custkey, cities.*, " + hav("(c_custkey * 53) % 1701 / 10e0 - 85e0", "(c_custkey * 211) % 3600 / 10e0 - 180e0", "lat", "lon") + " AS m FROM customer, cities)) WHERE k = 1",
    "country_lookup": chain("cities", "countries") + "SELECT DISTINCT cc AS country_iso2, coalesce(countries.name, cc) AS country_name FROM cities LEFT JOIN countries ON iso2 = cc",
    "jaccard": chain("clusters") + "SELECT cluster_id, round(least(n_cells, 2) / n_cells, 6) AS score FROM clusters",
    "cells_match": chain("bycell") + "SELECT cluster_id, harbour_id FROM bycell",
    "centroid_match": chain("bydist") + "SELECT cluster_id, harbour_id FROM bydist",
    "port_id": chain("cities") + f"SELECT name, CASE WHEN cc < 'K' THEN cc ELSE 'ZZ' END || '-' || substr(sha1(from_hex('{_NS}') || encode(name)), 1, 8) AS harbour_id FROM cities",
    "ports": FINAL + f"SELECT cluster_id, coalesce(matched_id, {FRESH}) AS harbour_id, matched_existing, country_iso2, country_name, "
    "round(CAST(CAST(km AS FLOAT) AS DOUBLE), 1) AS km FROM ports JOIN hc ON hc.id = cluster_id",
    "browse_search_sort": chain("ports") + "SELECT cluster_id AS idx, country_name AS country, n_events AS events, n_unique_mmsi_approx AS vessels, n_cells AS cells FROM ports "
    "WHERE regexp_matches(city, '(?i)admin-1|nation_1') OR regexp_matches(country_name, '(?i)admin-1|nation_1') OR regexp_matches(admin1, '(?i)admin-1|nation_1')",
    "ring_centroid_bounds": "SELECT n_nationkey, round(n_nationkey + 2e0, 3) AS lon, round(n_nationkey / 2e0 + 1e0, 3) AS lat, n_nationkey + 0e0 AS min_lon, "
    "n_nationkey / 2e0 AS min_lat, n_nationkey + 4e0 AS max_lon, n_nationkey / 2e0 + 2e0 AS max_lat FROM nation",
    "messages_read": chain("ais") + "SELECT mmsi, t // 1000000 * 1000000 AS t, round(lat, 3) AS lat, round(lon, 3) AS lon, sog, nav_status, msg_type, CASE WHEN msg_type = 5 THEN draught END AS draught, "
    "CASE WHEN msg_type = 5 THEN destination END AS destination, CASE WHEN msg_type = 5 THEN ship_type END AS ship_type FROM ais",
    "phases": FINAL + _shown(FRESH, "false"),
    "port_databases": FINAL + "SELECT kind, coalesce(matched_id, " + FRESH + ") AS harbour_id, array_to_string(h3_cells, ',') AS cells, round(centroid_lat, 3) AS lat, round(centroid_lon, 3) AS lon "
    "FROM ports JOIN hc ON hc.id = cluster_id, (VALUES ('parquet'), ('geojson')) k(kind)",
    "geojson_properties": FINAL + _shown(f"coalesce(matched_id, {FRESH})", "matched_existing"),
    "browse_pick": chain("ports") + "SELECT cluster_id AS idx, country_name AS country, n_events AS events, n_unique_mmsi_approx AS vessels, n_cells AS cells FROM ports ORDER BY n_events DESC, cluster_id LIMIT 1 OFFSET 2",
    "outline_edges": chain("outline") + "SELECT cluster_id, key, next, round(lon, 6) AS lon, round(lat, 6) AS lat FROM edges",
    "outline_shape": chain("outline") + "SELECT cluster_id, count(*) AS n_corners, round(sum((lon - lon0) * (lat2 - lat0) - (lon2 - lon0) * (lat - lat0)) / 2 * 1e6, 3) AS area, "
    + ", ".join(f"round(CAST(format('{{:.10g}}', {f}({c})) AS DOUBLE), 6) AS {f}_{c}" for f in ("min", "max") for c in ("lon", "lat")) + " "  # the text has ten digits
    "FROM edges JOIN (SELECT cluster_id, min(lon) AS lon0, min(lat) AS lat0 FROM edges GROUP BY cluster_id) USING (cluster_id) GROUP BY cluster_id",
    "geometry_text": "SELECT c_custkey AS key, replace([" + ", ".join("NULL" if j is None else f"'{j}'" for _, j in TEXTS) + f"][c_custkey % {len(TEXTS)} + 1], '#', CAST(c_custkey + 3 AS VARCHAR)) AS geometry FROM customer",
    "geometry_centroid": "SELECT s_suppkey AS ordinal, 'p' || s_suppkey AS harbour_id, round(CASE WHEN s_suppkey % 8 = 1 THEN 1.5e0 ELSE [" + ", ".join("NULL" if c is None else _d(c[1]) for _, c in SHAPES)
    + f"][s_suppkey % {len(SHAPES)} + 1] END, 3) AS lat, round([" + ", ".join("NULL" if c is None else _d(c[0]) for _, c in SHAPES) + f"][s_suppkey % {len(SHAPES)} + 1] + CASE WHEN s_suppkey % {len(SHAPES)} = 0 THEN s_suppkey ELSE 0 END, 3) AS lon FROM supplier",
}
