from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from tramloom.session import local_session

    session = local_session("tests", "4", shuffle_partitions="4", driver_memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    return session
