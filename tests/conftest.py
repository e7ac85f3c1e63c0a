from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from unitmart.session import build_session, scratch_path  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session(master="local[4]", shuffle_partitions=8, app_name="unitmart-tests",
                      extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint"))})
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark, request):
    return scratch_path(spark, "tests", request.node.name)


def rows(df, *cols):
    """Sorted list of tuples (optionally of selected columns)."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()), key=repr)
