import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lexmill.runtime import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("lexmill-tests", "4", **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
