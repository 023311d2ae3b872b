"""Session, and the metadata and contract of the example survey."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from surveys import PAGE_TIMES, QUESTIONS, definition_frame  # noqa: E402

from wavebook.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(cpus=8, shuffle_partitions=2)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def metadata(spark):
    from wavebook.plans.pipeline import survey_metadata

    return survey_metadata(definition_frame(spark, QUESTIONS)).cache()


@pytest.fixture(scope="session")
def contract(metadata):
    from wavebook.operators.contract import compile_contract

    return compile_contract(metadata, "demo", PAGE_TIMES)
