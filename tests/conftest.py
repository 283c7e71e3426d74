import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from fleetlens.session import build

    base = tmp_path_factory.mktemp("spark")
    session = build(
        "tests", **{
            "spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(base / "shared"), "spark.sql.warehouse.dir": str(base / "warehouse"), "spark.local.dir": str(base / "local"),
        }
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
