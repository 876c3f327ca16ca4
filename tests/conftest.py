import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from parcelwise.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # Up to 4 attempts per task, as on a cluster, so task-loss tests can retry.
    s = build_session(master="local[*,4]", shuffle_partitions=8, app_name="parcelwise-tests",
                      checkpoint_dir=str(tmp_path_factory.mktemp("shared")), driver_memory="6g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
