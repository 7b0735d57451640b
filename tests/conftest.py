import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickflow.session import build_session, work_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[8]", app_name="tickflow-tests", shuffle_partitions=8)
    work_dir(s)  # tests: no shared folder configured, so one is made locally
    yield s
    s.stop()
