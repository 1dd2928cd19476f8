from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from polderbook.session import local_session

    session = local_session(4, shuffle_partitions=4,
                            **{"spark.ui.showConsoleProgress": "false"})
    yield session
    session.stop()
