from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="ledgerlake-test-")
    s = build_session(
        "local[4]",
        "ledgerlake-tests",
        shuffle_partitions=8,
        **{"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")},
    )
    # Tests have no cluster checkpoint folder: use a private one only if unset.
    if s.sparkContext.getCheckpointDir() is None:
        s.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    yield s
    s.stop()


@pytest.fixture
def lake(tmp_path):
    return str(tmp_path)
