import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import checkpoint_dir, local_session
    warehouse = tempfile.mkdtemp(prefix="strata-wh-")
    s = local_session("strata-tests", cores=8, shuffle_partitions=8, warehouse=warehouse)
    checkpoint_dir(s)
    yield s
    s.stop()
