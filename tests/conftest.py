import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidewatch.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build("tests", "local[8]", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
