from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pagemill.session import session

    folder = tempfile.mkdtemp(prefix="spark-")
    found = session("local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.local.dir": folder,
        "spark.sql.warehouse.dir": f"{folder}/warehouse", "spark.checkpoint.dir": f"{folder}/shared", "spark.sql.sources.parallelPartitionDiscovery.parallelism": "4",
    })
    found.sparkContext.setLogLevel("ERROR")
    yield found
    found.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
