import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quaymark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, 4, "tests", **{"spark.checkpoint.dir": "file://" + str(tmp_path_factory.mktemp("shared")), "spark.driver.memory": "4g"})
    yield session
    session.stop()
