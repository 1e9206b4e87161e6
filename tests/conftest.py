import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session

    s = build_session(
        "local[8]",
        "tessera-tests",
        {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
         "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tessera-wh-", dir="/tmp")},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="tessera-test-", dir="/tmp")
