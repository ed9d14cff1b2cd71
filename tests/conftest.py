import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))

from pelagia import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session.build(
        "pelagia tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.ui.showConsoleProgress": "false"},
    )
    s.sparkContext.setLogLevel("ERROR")
    session.ship(s)
    yield s
    s.stop()
