import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tamis.plans import tables  # noqa: E402
from tamis.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tamis-tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tamis-"),
        "spark.tamis.inputPartitions": "8", "spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    tables.prepare(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL
