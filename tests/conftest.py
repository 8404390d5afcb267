from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from corvane.session import session, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    s = session("local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.checkpoint.dir": f"file://{shared}", "spark.sql.warehouse.dir": f"{shared}/warehouse", "spark.driver.memory": "3g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()
