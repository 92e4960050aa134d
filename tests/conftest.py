import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import local_session

    return local_session(8, spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
