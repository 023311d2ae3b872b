"""Naming the value of an expression inside another expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once per row.

    A column from an earlier projection may be merged into the place that mentions it.
    Inside a lambda over an array that place is reached once per element; a value bound
    by an enclosing lambda stays bound.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
