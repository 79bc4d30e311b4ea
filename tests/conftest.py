import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sparkmart.session import get_session
    import tempfile
    s = get_session("local[*]", shuffle_partitions=8,
                    extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="sparkmart-wh-")})
    yield s
    s.stop()
