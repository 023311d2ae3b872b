"""How ranges, lists and column names are shown in the data dictionary."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def range_display(minimum: Column, maximum: Column) -> Column:
    """``[min, max]``; a missing bound reads None, two missing bounds read ''."""

    def bound(value: Column) -> Column:
        # Whole numbers are written out; plain text of a double turns to powers of ten.
        whole = F.concat(value.cast("decimal(20,0)").cast("string"), F.lit(".0"))
        text = F.when((F.abs(value) < 1e15) & (value == F.floor(value)), whole)
        return F.coalesce(text, value.cast("string"), F.lit("None"))

    shown = F.concat(F.lit("["), bound(minimum), F.lit(", "), bound(maximum), F.lit("]"))
    return F.when(minimum.isNull() & maximum.isNull(), F.lit("")).otherwise(shown)


def list_display(values: Column) -> Column:
    """Values joined by '; ', missing ones left out; '' for no list."""
    return F.coalesce(F.array_join(values, "; "), F.lit(""))


def heading(column_name: str) -> str:
    return column_name.replace("_", " ").title()
