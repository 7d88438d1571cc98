import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import build_session

    shared = tmp_path_factory.mktemp("shared")
    s = build_session(master="local[4]", app_name="tidemark-tests", shuffle_partitions=8, extra={
        "spark.checkpoint.dir": str(shared / "checkpoints"), "spark.sql.warehouse.dir": str(shared / "warehouse")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
