import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hiretide.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(partitions=4, memory="4g")
    session.conf.set("spark.sql.maxMetadataStringLength", "4000")  # plans are read as text
    yield session
    session.stop()
