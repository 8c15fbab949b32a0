import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from recall.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.chdir(tmp_path_factory.mktemp("work"))
    session = local_session(4, 4, "4g")
    yield session
    session.stop()
