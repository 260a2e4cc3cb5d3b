import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from certrisk.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(os.environ.get("BENCH_CPUS", "8"), "8g")
    session.sparkContext.setLogLevel("ERROR")
    return session
