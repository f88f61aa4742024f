import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lexloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(
        "tests", 8, driver_memory="8g", **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="lexloom-tests-")}
    )
