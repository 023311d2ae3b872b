"""Small tables with awkward rows."""

from __future__ import annotations

import pytest
from awkward import CLASHING, awkward_rows


@pytest.fixture(scope="session")
def documents(spark):
    rows = [(*row, *[str(n)] * len(CLASHING)) for n, row in enumerate(awkward_rows())]
    columns = ["doc_id long", "text string", *[f"`{c}` string" for c in CLASHING]]
    return spark.createDataFrame(rows, ", ".join(columns)).repartition(3)


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.limit(0)
