import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from vanewright.plans.sizing import CONF_PREFIX  # noqa: E402
from vanewright.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", 8, **{
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.sql.streaming.noDataMicroBatches.enabled": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def split_groups(spark):
    """Limits so low that groups of a few dozen rows count as hot and nothing is
    broadcast on its estimated size."""
    limits = {"small_bytes": 0, "hot_rows": 25, "broadcast_bytes": 0}
    for name, value in limits.items():
        spark.conf.set(CONF_PREFIX + name, str(value))
    yield limits
    for name in limits:
        spark.conf.unset(CONF_PREFIX + name)
