import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import local_session

    session = local_session(cores=8, shuffle_partitions=4, app="tests")
    yield session
    session.stop()
