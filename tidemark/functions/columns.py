"""Small Column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Catalyst may inline a projected expression into a lambda, where it would be
    evaluated for each element.  Binding it as a lambda variable rules that out.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
