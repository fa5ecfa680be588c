"""Geometries for the queries on texts and centroids."""

#: Texts of geometries, with ``#`` for a customer's number, and what they are in GeoJSON; None: no geometry.
TEXTS = (
    ("POINT (# 7)", '{"type": "Point", "coordinates": [#, 7]}'),
    ("point z(-#.5 .25 3e-2)", '{"type": "Point", "coordinates": [-#.5, 0.25, 3E-2]}'),
    ("LINESTRING(# 0,\n1 1 , 2 #)", '{"type": "LineString", "coordinates": [[#, 0], [1, 1], [2, #]]}'),
    ("POLYGON ((0 0, # 0, # #, 0 0), (1 1, 2 1, 2 2, 1 1))", '{"type": "Polygon", "coordinates": [[[0, 0], [#, 0], [#, #], [0, 0]], [[1, 1], [2, 1], [2, 2], [1, 1]]]}'),
    ("MULTIPOINT ((# 1), (2 3))", '{"type": "MultiPoint", "coordinates": [[#, 1], [2, 3]]}'),
    ("MULTIPOINT (# 1, 2 3)", '{"type": "MultiPoint", "coordinates": [[#, 1], [2, 3]]}'),
    ("MULTILINESTRING ((0 0, # 1), (2 2, 3 3, 4 #))", '{"type": "MultiLineString", "coordinates": [[[0, 0], [#, 1]], [[2, 2], [3, 3], [4, #]]]}'),
    ("MULTIPOLYGON (((0 0, 1 0, 1 #, 0 0)), ((5 5, 6 5, 6 6, 5 5)))", '{"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, #], [0, 0]]], [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}'),
    (
        "GEOMETRYCOLLECTION (POINT (1 #), GEOMETRYCOLLECTION (LINESTRING (0 0, 1 1), POINT EMPTY), POLYGON EMPTY)",
        '{"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [1, #]}, {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}, '
        '{"type": "Point", "coordinates": []}, {"type": "Polygon", "coordinates": []}]}',
    ),
    ("MULTIPOLYGON EMPTY", '{"type": "MultiPolygon", "coordinates": []}'),
    ("GEOMETRYCOLLECTION EMPTY", '{"type": "GeometryCollection", "geometries": []}'),
    ("POLYGON (oops #", None), ("POLYGON ((0 0, # 0, 1 1, 2 2))", None), ("POLYGON ((0 0, # 0, 0 0))", None), ("POLYGON (0 0, # 0, 1 1, 0 0)", None), ("POINT (#)", None),
    ("POINT (1 2, #  4)", None), ("LINESTRING (# 1)", None), ("MULTIPOINT ((1 2), # 3)", None), ("CIRCLE (1 #)", None), ("POINT (# 2) x", None),
    ("GEOMETRYCOLLECTION (POINT (1 #), POLYGON (oops))", None), ("GEOMETRYCOLLECTION (POINT (1 #)", None), ("", None), (None, None),
)

_SQUARE = lambda x, y, side: "[" + ",".join(f"[{a},{b}]" for a, b in ((x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y))) + "]"
#: GeoJSON geometries of all kinds, with ``#`` for a number n that moves them east, and their centroids for n = 0; None: no centroid.
SHAPES = (
    ('{"type":"Point","coordinates":[#,7]}', (0, 7)),
    (f'{{"type":"Polygon","coordinates":[{_SQUARE(0, 0, 4)},{_SQUARE(0, 0, 2)}]}}', (28 / 12, 28 / 12)),
    (f'{{"type":"MultiPolygon","coordinates":[[{_SQUARE(0, 0, 2)}],[{_SQUARE(10, 4, 1)}]]}}', (14.5 / 5, 8.5 / 5)),
    ('{"type":"LineString","coordinates":[[0,0],[4,0],[4,2]]}', (16 / 6, 2 / 6)),
    ('{"type":"MultiLineString","coordinates":[[[0,0],[2,0]],[[5,5],[5,11]]]}', (32 / 8, 48 / 8)),
    ('{"type":"MultiPoint","coordinates":[[0,0],[1,5],[5,1]]}', (2, 2)),
    (f'{{"type":"GeometryCollection","geometries":[{{"type":"Point","coordinates":[90,9]}},{{"type":"LineString","coordinates":[[0,0],[9,9]]}},{{"type":"Polygon","coordinates":[{_SQUARE(1, 1, 2)}]}}]}}', (2, 2)),
    ('{"type":"GeometryCollection","geometries":[{"type":"MultiPoint","coordinates":[[9,9]]},{"type":"GeometryCollection","geometries":[{"type":"LineString","coordinates":[[0,0],[0,4]]}]}]}', (0, 2)),
    ('{"type":"Polygon","coordinates":[[[0,0],[4,0],[0,0],[0,0]]]}', (2, 0)),
    ('{"type":"LineString","coordinates":[[3,1],[3,1]]}', (3, 1)),
    ('{"type":"MultiPolygon","coordinates":[]}', None),
    ('{"type":"GeometryCollection","geometries":[]}', None),
    ("oops", None),
    (None, None),
)
