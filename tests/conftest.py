from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from sablefin.session import get_spark

    s = get_spark("tests", "4", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf() -> str:
    return "/root/testdata/sf0.001"
