import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from tidewheel.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folders = {"spark.sql.warehouse.dir": "warehouse", "spark.checkpoint.dir": "checkpoints"}
    extra = {key: str(tmp_path_factory.mktemp(name)) for key, name in folders.items()}
    session = build_session("tests", 8, "8g", extra)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
