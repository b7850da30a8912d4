import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tripcraft.session import checkpoint_dir, local_session
    s = local_session(cores="*", shuffle_partitions=8, app="tripcraft-tests")
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def sf01():
    return SF01


@pytest.fixture(scope="session")
def sf001():
    return SF001
