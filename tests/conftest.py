import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from doctables.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("8", "doctables-tests")


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
