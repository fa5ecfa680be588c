"""Vessel and port attributes as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Ship-type codes, first and last inclusive.
SHIP_CLASSES = (
    ("fishing", 30, 32),
    ("recreational", 36, 37),
    ("tug_pilot", 50, 52),
    ("passenger", 60, 69),
    ("cargo", 70, 79),
    ("tanker", 80, 89),
)
LOCODE = "[A-Z]{2}[A-Z2-9]{3}"
#: Fixed value: the namespace of port ids.
NAMESPACE = "b8d7e3a2-5f1c-4e8b-9a6d-3c7f2e1b4a5d"


def parse_locode(text: Column) -> Column:
    """The UN/LOCODE in a destination: the whole text, the text without spaces, or else the last word of that form."""
    up = F.upper(F.regexp_replace(text, r"\A\s+|\s+\z", ""))
    close = F.replace(up, F.lit(" "), F.lit(""))
    words = F.regexp_extract_all(up, F.lit(rf"\b({LOCODE})\b"), F.lit(1))
    return (
        F.when(up.rlike(rf"\A{LOCODE}\z"), up)
        .when(close.rlike(rf"\A{LOCODE}\z"), close)
        .otherwise(F.try_element_at(words, F.lit(-1)))
    )


def ship_class(code: Column) -> Column:
    """The class of a ship-type code; what is no whole number is ``unknown``."""
    n = code.try_cast("double").try_cast("int")
    out = F.when(n.isNull(), F.lit("unknown"))
    for name, first, last in SHIP_CLASSES:
        out = out.when(n.between(first, last), F.lit(name))
    return out.otherwise("other")


def detection_method(nav_status: Column, moored) -> Column:
    return F.when(F.coalesce(nav_status.isin(*moored), F.lit(False)), "nav_status").otherwise("sustained_speed")


def positive(x: Column) -> Column:
    return F.when(x > 0, x)


def port_id(cell: Column, country: Column) -> Column:
    """``CC-`` and the first eight hex digits of the cell's version 5 UUID.

    Those digits precede the version bits, so they are the SHA-1 of namespace and name.
    """
    digest = F.sha1(F.concat(F.unhex(F.lit(NAMESPACE.replace("-", ""))), F.encode(cell, "utf-8")))
    prefix = F.upper(F.trim(F.coalesce(country, F.lit(""))))
    return F.concat(F.when(prefix == "", F.lit("ZZ")).otherwise(prefix), F.lit("-"), F.substring(digest, 1, 8))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))
