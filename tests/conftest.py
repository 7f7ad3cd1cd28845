import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])

from keelgraph.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("KEELGRAPH_DRIVER_MEMORY", "4g")
    session = local_session("keelgraph-tests", 4, 4)
    yield session
    session.stop()
