"""Strict casts from response text, one expression per target type.

The casts raise on bad text whatever ``spark.sql.ansi.enabled`` says, and name the
column and the value that could not be read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wavebook.functions.text import strip

DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DECIMAL_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
NAMED_NUMBER = "^([+-]?inf(inity)?|nan)$"


def _or_raise(
    value: Column, text: Column, wanted: str, column: str, empty_is_null: bool = True
) -> Column:
    """The value, or an error if there is text that gave none; good text is read once."""
    message = F.concat(F.lit(f"column {column}: not a valid {wanted}: '"), text, F.lit("'"))
    bad = text != "" if empty_is_null else text.isNotNull()
    return F.coalesce(value, F.when(bad, F.raise_error(message)))


def to_boolean(text: Column) -> Column:
    """'1' is true, '0' and the empty text are false, anything else is null."""
    return F.when(text == "1", F.lit(True)).when(text.isin("0", ""), F.lit(False))


def to_integer(text: Column, column: str) -> Column:
    """Whole number; blank text is null.

    The plain cast, which is enough for most text, comes first.
    """
    value = F.coalesce(text.try_cast("bigint"), strip(text).try_cast("bigint"))
    return _or_raise(value, strip(text), "integer", column)


def to_double(text: Column, column: str) -> Column:
    """Number; blank text is null."""
    cleaned = strip(text)
    # The cast also reads what Java writes: hexadecimal numbers and type letters at the end.
    readable = cleaned.rlike(DECIMAL_NUMBER) | F.lower(cleaned).rlike(NAMED_NUMBER)
    return _or_raise(F.when(readable, cleaned.try_cast("double")), cleaned, "number", column)


def to_date(text: Column, column: str, layout: str = DATE_FORMAT) -> Column:
    """Date in exactly the given layout; the empty text is not one."""
    return _or_raise(F.try_to_date(text, layout), text, "date", column, empty_is_null=False)


def to_timestamp(text: Column, column: str, layout: str = TIMESTAMP_FORMAT) -> Column:
    """Date and time without a zone, in exactly the given layout.

    The parse that does not raise depends on the session's zone, which lacks the hour
    skipped in spring; it only tells whether the text can be read.
    """
    readable = F.try_to_timestamp(text, F.lit(layout)).isNotNull()
    value = F.when(readable, F.to_timestamp_ntz(text, F.lit(layout)))
    return _or_raise(value, text, "date and time", column, empty_is_null=False)


def decode(text: Column, codes: Sequence[str], labels: Sequence[str]) -> Column:
    """Code to label by exact text; other text stays; the last of equal codes wins."""
    book = dict(zip(codes, labels))
    if not book:
        return text
    pairs = [F.lit(part) for pair in book.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), text), text)


def to_enum(text: Column, labels: Sequence[str]) -> Column:
    """Stripped text if it is one of the labels, else null."""
    cleaned = strip(text)
    return F.when(cleaned.isin([label for label in dict.fromkeys(labels) if label]), cleaned)


def cast_text(
    text: Column,
    type_name: str,
    column: str,
    date_format: str = DATE_FORMAT,
    timestamp_format: str = TIMESTAMP_FORMAT,
) -> Column:
    """Cast by type name; types without a rule keep their text."""
    if type_name == "Boolean":
        return to_boolean(text)
    if type_name in ("Int64", "Int32"):
        return to_integer(text, column)
    if type_name in ("Float64", "Float32"):
        return to_double(text, column)
    if type_name == "Date":
        return to_date(text, column, date_format)
    if type_name == "Datetime":
        return to_timestamp(text, column, timestamp_format)
    return text
