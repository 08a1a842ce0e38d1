import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from twosided.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__checkpoint__dir=str(folder),
        spark__sql__warehouse__dir=str(folder / "warehouse"),
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
