from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from vellumine.session import local_session

    s = local_session(4, "tests", **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")), "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), "spark.driver.memory": "4g"})
    yield s
    s.stop()
