import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewatt.session import session  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.driver.memory": "4g",
    }
    active = session("tests", "local[4]", settings)
    active.sparkContext.setLogLevel("ERROR")
    yield active
    active.stop()


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"
