from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tripmart.session import build_session

    extra = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    s = build_session("local[4]", app="tripmart-tests", shuffle_partitions=4, extra=extra)
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def workdir(spark):
    """A fresh folder under the shared root for one test."""
    from tripmart.session import scratch_dir

    return scratch_dir(spark, "tests")
