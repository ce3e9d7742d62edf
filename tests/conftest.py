import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session, checkpoint_root
    s = build_session(master="local[4]", shuffle_partitions=8, app_name="tessera-tests",
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tessera-test-warehouse-")})
    checkpoint_root(s)  # no cluster folder is configured here, so it makes a private one
    yield s
    s.stop()
