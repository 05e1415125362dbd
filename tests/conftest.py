import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fleetlake.session import get_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", 4, app_name="fleetlake-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the session's checkpoint folder, as a local path (Python reads and writes there too)."""
    return shared_dir(spark, "test").removeprefix("file:")
