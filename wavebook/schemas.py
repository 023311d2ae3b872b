"""Column layouts, type names and the contract a cleaned response table must meet."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

# ---- fixed values: type names used in the metadata table -> Spark types ----
TYPE_NAMES: dict[str, T.DataType] = {
    "Int64": T.LongType(),
    "Int32": T.IntegerType(),
    "Float64": T.DoubleType(),
    "Float32": T.FloatType(),
    "String": T.StringType(),
    "Boolean": T.BooleanType(),
    "Date": T.DateType(),
    "Datetime": T.TimestampNTZType(),
    "Object": T.StringType(),
}

# ---- fixed values: system columns, raw name -> (final name, type name) ----
SYSTEM_COLUMNS: dict[str, tuple[str, str]] = {
    "vID": ("id", "Int64"),
    "vCOMPLETED": ("completed", "Boolean"),
    "vFINISHED": ("finished", "Boolean"),
    "vDURATION": ("duration", "Float64"),
    "vQUOTE": ("quote", "String"),
    "vSTART": ("start", "Datetime"),
    "vEND": ("end", "Datetime"),
    "vRUNTIME": ("runtime", "String"),
    "vDATE": ("date", "Date"),
}
PAGE_TIME_RAW, PAGE_TIME_FINAL = "vPAGETIME", "pagetime"
UNUSED_COLUMNS = ["vANONYM", "vLANG"]
COMPLETED_COLUMN = "vCOMPLETED"
WAVE_COLUMN = "load_counter"
# ---- end of fixed values ----

_LIST = re.compile(r"List\((.*)\)", re.DOTALL)


def spark_type(name: str) -> T.DataType:
    """Spark type for a type name; lists nest, an enumeration is read as text."""
    as_list = _LIST.fullmatch(name)
    if as_list:
        return T.ArrayType(spark_type(as_list.group(1)))
    if name.startswith("Enum("):
        return T.StringType()
    if name not in TYPE_NAMES:
        raise ValueError(f"unknown type name: {name!r}")
    return TYPE_NAMES[name]


def type_name(data_type: T.DataType) -> str:
    """The inverse of :func:`spark_type` for every type a survey table holds."""
    if isinstance(data_type, T.ArrayType):
        return f"List({type_name(data_type.elementType)})"
    for name, known in TYPE_NAMES.items():
        if known == data_type:
            return name
    raise ValueError(f"no type name for {data_type.simpleString()}")


_TEXTS = T.ArrayType(T.StringType())

#: One row per variable. ``survey_id`` and the two ``variable_*`` columns are ours:
#: they let one job hold many surveys and give rows an order Spark does not keep.
METADATA = T.StructType(
    [
        T.StructField("survey_id", T.StringType(), False),
        T.StructField("question_id", T.LongType(), False),
        T.StructField("group_id", T.LongType(), False),
        T.StructField("id", T.StringType(), False),
        T.StructField("question_position", T.LongType(), False),
        T.StructField("question_type", T.StringType(), False),
        T.StructField("schema_variable_type", T.StringType(), False),
        T.StructField("question_text", T.StringType(), False),
        T.StructField("label", T.StringType()),
        T.StructField("range_min", T.DoubleType()),
        T.StructField("range_max", T.DoubleType()),
        T.StructField("possible_values_codes", _TEXTS),
        T.StructField("possible_values_labels", _TEXTS),
        T.StructField("scale_labels", _TEXTS),
        T.StructField("is_other_boolean", T.BooleanType(), False),
        T.StructField("is_other_text", T.BooleanType(), False),
        T.StructField("variable_position", T.LongType(), False),
        T.StructField("variable_count", T.LongType(), False),
        T.StructField("original_id", T.StringType(), False),
    ]
)


@dataclass(frozen=True)
class SurveyColumn:
    """What one column of the cleaned table must look like."""

    name: str
    raw_name: str
    type_name: str
    nullable: bool = True
    codes: tuple[str, ...] = ()
    labels: tuple[str, ...] = ()
    #: a code book too long for an expression; it stays in the metadata table
    long_code_book: bool = False
    minimum: float | None = None
    maximum: float | None = None

    @property
    def is_enum(self) -> bool:
        return self.long_code_book or bool(self.labels)

    @property
    def data_type(self) -> T.DataType:
        return spark_type(self.type_name)


def system_columns(page_times: int) -> list[SurveyColumn]:
    """The columns every response table carries, none of them nullable."""
    columns = [
        SurveyColumn(final, raw, kind, nullable=False)
        for raw, (final, kind) in SYSTEM_COLUMNS.items()
    ]
    columns += [
        SurveyColumn(f"{PAGE_TIME_FINAL}{n}", f"{PAGE_TIME_RAW}{n}", "Int64", nullable=False)
        for n in range(1, page_times + 1)
    ]
    return columns
