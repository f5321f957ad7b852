import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidewell.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        {
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
        master="local[8]",
        shuffle_partitions=4,
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines_of(spark):
    """Function: texts to a frame with one ``value`` column."""

    def make(*texts):
        return spark.createDataFrame([(t,) for t in texts], "value string")

    return make


def tuples(frame):
    return [tuple(r) for r in frame.collect()]
