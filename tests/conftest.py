from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from faultline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session(
        "faultline-tests",
        "local[8]",
        spark__sql__shuffle__partitions=8,
        spark__sql__warehouse__dir=warehouse,
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
