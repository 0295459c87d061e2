from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4",
                            spark__ui__enabled="false", spark__driver__memory="4g",
                            spark__sql__streaming__noDataProgressEventInterval="500",
                            spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled="true")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
