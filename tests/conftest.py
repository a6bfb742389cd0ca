from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from payerscope.session import local_session

    return local_session("*", shuffle_partitions=8, memory="4g")


@pytest.fixture(scope="session")
def sf_dir():
    folder = Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("test tables are not here")
    return str(folder)
