from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="strata-test-")
    s = build_session(
        app_name="strata-tests",
        master="local[4]",
        shuffle_partitions=4,
        conf={
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
            "spark.driver.memory": "4g",
        },
    )
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="strata-case-")
