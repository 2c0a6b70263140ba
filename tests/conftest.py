import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from reconspark.session import build_session

    folder = str(tmp_path_factory.mktemp("checkpoints"))
    return build_session("tests", 8, **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.checkpoint.dir": folder})


@pytest.fixture(scope="session")
def tiny():
    folder = f"{DATA}/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    return folder
