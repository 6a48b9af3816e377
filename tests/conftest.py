import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gapledger.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="gapledger-test-ckpt-")
    s = get_session(
        "gapledger-tests", master="local[4]", shuffle_partitions=4,
        extra={"spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def base():
    return SF_SMALL
