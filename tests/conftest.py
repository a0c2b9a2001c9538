import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from lodestead.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "tests", shuffle_partitions=4, spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse"))
    )
    yield session
    session.stop()
