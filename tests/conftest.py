import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakepanel.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        "local[4]",
        shuffle_partitions=4,
        app_name="lakepanel-tests",
        extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="lakepanel-test-ckpt-")},
    )
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    # A fresh folder per test; nothing is deleted (scratch lives under /tmp).
    return tempfile.mkdtemp(prefix="lakepanel-test-")
