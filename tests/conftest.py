import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))


@pytest.fixture(scope="session")
def spark():
    from stayline.session import local_session

    return local_session(8, shuffle_partitions=4)


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
