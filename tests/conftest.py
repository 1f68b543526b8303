from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for folder in (ROOT, ROOT / "tests"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from riskflow.session import build_session

    session = build_session(
        "riskflow-tests",
        "local[8]",
        4,
        {"spark.ui.enabled": "false", "spark.driver.memory": "6g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return SMALL
