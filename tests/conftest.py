from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tickloom.session import session, ship


@pytest.fixture(scope="session")
def spark():
    s = session("local[4]", partitions=4, memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()
