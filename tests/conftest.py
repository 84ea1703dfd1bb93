import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from riskloom.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return build_session(
        "tests", "local[8]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    )


@pytest.fixture(scope="session")
def small():
    return SMALL
