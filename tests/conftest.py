from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from atlasloom.session import local_session

    session = local_session(4, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def _no_kept_tables(request):
    yield
    if "spark" in request.fixturenames:
        request.getfixturevalue("spark").catalog.clearCache()
