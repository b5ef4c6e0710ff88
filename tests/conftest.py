from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from perishables.session import build_session

    s = build_session("local[*]", app="perishables-tests", shuffle_partitions=8)
    if not s.conf.get("spark.checkpoint.dir", None):
        path = tempfile.mkdtemp(prefix="perishables-tests-")
        s.conf.set("spark.checkpoint.dir", path)
        s.sparkContext.setCheckpointDir(path)
    yield s
    s.stop()
