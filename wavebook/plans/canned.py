"""The canned questions by name, asked of a stored survey."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from wavebook.operators import analytics
from wavebook.sources.tables import SurveyTables

OF_RESULTS: dict[str, Callable[..., DataFrame]] = {
    "frequency_distribution": analytics.frequency_distribution,
    "wave_trend": analytics.wave_trend,
    "item_distribution": analytics.item_distribution,
    "frequency_all_variables": analytics.frequency_all_variables,
    "trend_all_variables": analytics.trend_all_variables,
}
OF_METADATA: dict[str, Callable[..., DataFrame]] = {
    "question_metadata": analytics.question_metadata,
    "matrix_metadata": analytics.matrix_metadata,
    "find_variables": analytics.find_variables,
    "count_questions": analytics.count_questions,
}


def ask(tables: SurveyTables, name: str, *args, **kwargs) -> DataFrame:
    """Answer one canned question, for instance ``ask(tables, "wave_trend", "Q8", "MAX")``."""
    if name in OF_RESULTS:
        return OF_RESULTS[name](tables.results(), *args, **kwargs)
    if name in OF_METADATA:
        return OF_METADATA[name](tables.metadata(), *args, **kwargs)
    known = ", ".join(sorted([*OF_RESULTS, *OF_METADATA]))
    raise ValueError(f"no question {name!r}; there are {known}")
