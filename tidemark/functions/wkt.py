"""Geometries as text (WKT), checked and rewritten as GeoJSON, as Columns.

A text is read in three steps, none of which depends on how long it is: its kind and its body are told apart;
in the body each point becomes one letter, which leaves a skeleton of brackets, commas and points;
and the skeleton is folded, lists of points to rings, lists of rings to shapes, lists of shapes to sets, until
one letter is left.  A skeleton that does not fold to what its kind asks for is no geometry.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.columns import let

_NUMBER = r"-?[0-9]+(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?"
_POINT = rf"{_NUMBER}(?: {_NUMBER}){{1,3}}"
#: Kind in WKT, its name in GeoJSON, what its skeleton folds to (p: a point in brackets, r: a list of points, s: of lists, t: of those),
#: and the type of its coordinates.
KINDS = (
    ("POINT", "Point", "p", "array<double>"), ("LINESTRING", "LineString", "r", "array<array<double>>"), ("POLYGON", "Polygon", "s", "array<array<array<double>>>"),
    ("MULTIPOINT", "MultiPoint", "[pr]", "array<array<double>>"), ("MULTILINESTRING", "MultiLineString", "s", "array<array<array<double>>>"),
    ("MULTIPOLYGON", "MultiPolygon", "t", "array<array<array<array<double>>>>"),
)
_NAMES = "|".join(k for k, *_ in sorted(KINDS, reverse=True))


def _tidy(wkt: Column) -> Column:
    """Upper case, single blanks, none beside brackets and commas; numbers without a digit before or after the point get one."""
    text = F.regexp_replace(F.regexp_replace(F.upper(F.trim(wkt)), r"\s+", " "), r" ?([(),]) ?", "$1")
    return F.regexp_replace(F.regexp_replace(text, r"(?<![0-9])\.([0-9])", "0.$1"), r"([0-9])\.(?![0-9])", "$1.0")


def _fold(body: Column) -> Column:
    """The skeleton as one letter, or what could not be folded."""
    bare = F.regexp_replace(body, _POINT, "o")
    legal = ~bare.rlike(r"[^o(),]|oo|,,|\(,|,\)|\)o|o\(|\)\(|\(\)")
    rings = F.regexp_replace(F.regexp_replace(bare, r"\(o\)", "p"), r"\([o,]+\)", "r")
    shapes = F.regexp_replace(rings, r"\([rp,]+\)", "s")
    return F.when(legal, F.regexp_replace(shapes, r"\([s,]+\)", "t"))


def _closed(lists: Column) -> Column:
    """Whether each of some lists of points ends where it begins and has four points at least."""
    return F.forall(lists, lambda r: (F.size(r) >= 4) & (F.get(r, F.lit(0)) == F.get(r, F.size(r) - 1)))


def _simple(text: Column) -> Column:
    """One tidy text that is no collection, as GeoJSON; null if it is none."""
    found = lambda i: F.regexp_extract(text, rf"^({_NAMES})(?: ?Z?M?)? ?(EMPTY|\(.*\))$", i)

    def made(q: Column) -> Column:
        # A set of points may have each of them in brackets.
        flat = F.when(q["kind"] == "MULTIPOINT", F.regexp_replace(q["body"], rf"\(({_POINT})\)", "$1")).otherwise(q["body"])
        flat = F.when((q["kind"] == "MULTIPOINT") & ~flat.startswith("("), F.concat(F.lit("("), flat, F.lit(")"))).otherwise(flat)
        listed = F.translate(F.regexp_replace(F.regexp_replace(flat, rf"({_POINT})", "[$1]"), r"(?<=[0-9]) (?=[-0-9])", ", "), "()", "[]")
        listed = F.regexp_replace(listed, r",(?=\[)", ", ")
        out = F.lit(None).cast("string")
        for kind, name, want, depth in KINDS:
            body = F.regexp_replace(listed, r"^\[(.*)\]$", "$1") if kind == "POINT" else listed
            ok = q["fold"].rlike(f"^{want}$")
            if kind == "MULTIPOINT":
                ok = q["fold"].rlike("^[prs]$") & ~flat.rlike(r"\(.*\(")
            if kind == "LINESTRING":
                ok = q["fold"] == "r"
            if kind.endswith("POLYGON"):
                rings = F.from_json(listed, depth)
                ok = ok & F.coalesce(_closed(rings if kind == "POLYGON" else F.flatten(rings)), F.lit(False))
            json = F.concat(F.lit(f'{{"type": "{name}", "coordinates": '), F.when(q["body"] == "EMPTY", "[]").when(ok, body), F.lit("}"))
            out = F.when(q["kind"] == kind, json).otherwise(out)
        return out

    return let(F.struct(found(1).alias("kind"), found(2).alias("body"), _fold(found(2)).alias("fold")), made)


def _collection(text: Column) -> Column:
    """A tidy GEOMETRYCOLLECTION as GeoJSON, with the members of collections in it as its own; null if one of them cannot be read."""
    opens = lambda c: F.length(c) - F.length(F.translate(c, "(", ""))
    closes = lambda c: F.length(c) - F.length(F.translate(c, ")", ""))
    head = r"^(?:GEOMETRYCOLLECTION(?: ?Z?M?)? ?\()+"

    def member(part: Column) -> Column:
        bare = F.regexp_replace(part, head, "")
        more = F.greatest(closes(bare) - opens(bare), F.lit(0))
        return F.struct(F.substring(bare, F.lit(1), F.length(bare) - more).alias("text"), (opens(part) - opens(bare)).alias("up"), more.alias("down"))

    def joined(m: Column) -> Column:
        json = F.transform(m, lambda x: _simple(x["text"]))
        level = lambda k: F.aggregate(m, F.lit(0), lambda s, x: s + x[k])
        ends = F.get(m, F.size(m) - 1)["down"] >= 1
        whole = F.forall(json, lambda j: j.isNotNull()) & (level("up") == level("down")) & ends
        return F.when(whole, F.concat(F.lit('{"type": "GeometryCollection", "geometries": ['), F.array_join(json, ", "), F.lit("]}")))

    empty = text.rlike(r"^GEOMETRYCOLLECTION(?: ?Z?M?)? ?EMPTY$")
    parts = F.split(text, r",(?=[A-Z])")
    return F.when(empty, F.lit('{"type": "GeometryCollection", "geometries": []}')).otherwise(let(F.transform(parts, member), joined))


def geojson(wkt: Column) -> Column:
    """WKT of any of the seven kinds, EMPTY and with Z or M, as GeoJSON text; null for null and for what is no geometry.

    Rings must be closed and have four points.  Numbers keep their digits.  Collections within collections are written
    flat.
    """
    return let(_tidy(wkt), lambda t: F.when(t.startswith("GEOMETRYCOLLECTION"), _collection(t)).otherwise(_simple(t)))
