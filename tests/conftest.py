import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakestrata.session import local_session, shared_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("tests", cpus=4, shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    """A fresh folder under the session's shared checkpoint folder."""
    return shared_dir(spark, "tests")
