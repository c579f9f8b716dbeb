import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from ledgerflow.session import build_session, checkpoint_dir
    s = build_session("local[4]", "ledgerflow-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g",
                             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="lf-wh-")})
    checkpoint_dir(s)
    yield s
    s.stop()


SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
