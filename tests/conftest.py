import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from suite.compare import session


@pytest.fixture(scope="session")
def spark():
    return session(8)
