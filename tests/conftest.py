import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ["PYTHONPATH"] = os.pathsep.join([str(Path(__file__).resolve().parent.parent), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    from sightline.session import local_session

    # partitions are kept apart, so that keys do cross their edges
    session = local_session(4, **{"spark.sql.shuffle.partitions": "5", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
