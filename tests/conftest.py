"""One local session for all tests."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from spotloom.session import local_session

    s = local_session(4, 4, "4g", **{"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), "spark.sql.autoBroadcastJoinThreshold": "1m"})
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA
