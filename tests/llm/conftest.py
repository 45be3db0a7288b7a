from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_cases import stored_tables  # noqa: E402, F401

from strata.llm.common import prepare  # noqa: E402


@pytest.fixture(autouse=True)
def shipped(spark):
    prepare(spark)
