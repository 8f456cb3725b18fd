import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starmart.session import get_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="starmart-test-ckpt-")
    s = get_session("local[4]", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": ckpt,
                           "spark.sql.warehouse.dir": os.path.join(ckpt, "wh")})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF001
