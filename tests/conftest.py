import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURES = os.path.join(ROOT, "tests", "fixtures")
SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from tessera.session import build_session
    warehouse = tempfile.mkdtemp(prefix="tessera-warehouse-")
    s = build_session("local[4]", app="tessera-tests", shuffle_partitions=8,
                      conf={"spark.sql.warehouse.dir": warehouse,
                            "spark.sql.autoBroadcastJoinThreshold": "-1"})
    yield s
    s.stop()


def fixture_path(name: str) -> str:
    return os.path.join(FIXTURES, name)
