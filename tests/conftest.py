from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session
    s = build_session("local[4]", 8, app="strata-tests",
                      extra={"spark.ui.showConsoleProgress": "false"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    from strata.session import work_dir
    return work_dir(spark, "test")
