import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for folder in (ROOT, ROOT / "tests"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))

from tripforge.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    session = local_session(4, memory="6g", app="tripforge-tests", settings={"spark.checkpoint.dir": folder})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_tables():
    return "/root/testdata/sf0.001"
